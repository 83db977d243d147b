"""Secret scans (operator 4): candidates by pattern, then corpus-wide ownership frequency.

``scan`` finds candidate spans in each text with Spark's regular expressions; positions come from
the lengths of the pieces between matches (code points). ``ownership`` counts, per candidate
hash, the distinct repositories and owners that hold it; ``classify`` calls a value seen with many
owners, or in many repositories of few owners, ``copied`` (an example everyone pastes), a live-looking
value of few ``live``, and the rest ``weak``. Values leave a task only as SHA-256.

Only DataFrame operations. Per-hash counting groups by (hash, owner, repository) first, so a
value pasted into a third of all rows is folded before the shuffle; the way back is a join on the
hash against one row per hash, split by adaptive skew handling.

Defined results: a null text has no secrets; a null owner or repository counts as one of its
own; repeated rows are reported one by one; input columns named like an output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikeloom.llm.common import ROW_KEYS, cut, named, row_keys, table, text_of, unwrapped, wrapped

# fixed values: kinds in order, pattern, group that holds the value, least length of that group
KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
COUNTS = ("n_live", "n_copied", "max_owners", "max_repos")
SPANS = "array<struct<start:int,kind:int,stop:int,value:string>>"


@dataclass(frozen=True)
class Ownership:
    copied_owners: int = 3      # distinct owners from which a value counts as widely copied
    copied_repos: int = 6       # or distinct repositories, though few owners hold them
    min_distinct: int = 8       # different characters a live-looking value has at least


def _spans(hits: str, parts: str, values: str, kind: int, least: int) -> Column:
    """Spans of one kind from its matches, the pieces between them and the values: one running sum over
    pieces and matches gives the starts."""
    h, p, v = F.col(hits), F.col(parts), F.col(values)
    steps = F.zip_with(F.slice(p, 1, F.size(h)), h, lambda a, b: F.struct(a.alias("gap"), b.alias("hit")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(steps, empty, lambda acc, x: F.struct(
        (acc["at"] + x["gap"] + x["hit"]).alias("at"), F.array_append(acc["starts"], acc["at"] + x["gap"]).alias("starts")), lambda acc: acc["starts"])
    found = F.transform(F.arrays_zip(starts.alias("start"), h.alias("hit"), v.alias("value")), lambda s: F.struct(
        s["start"].alias("start"), F.lit(kind).alias("kind"), (s["start"] + s["hit"]).alias("stop"), s["value"].alias("value")))
    return F.when(F.size(h) > 0, F.filter(found, lambda s: F.length(s["value"]) >= least)) \
        .otherwise(F.array().cast(SPANS))


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``found``: array of (start, kind number, stop, value) by start, then kind. Leftmost
    matches of a kind that don't overlap; start and stop in code points, stop exclusive."""
    docs = docs.drop("found")
    # the whole row aside: no column of the input can clash with those used here
    d = wrapped(docs, text_of(F.col(f"`{text_col}`")).alias("__t"))
    for k, (_, pattern, group, _) in enumerate(KINDS):
        d = d.withColumn(f"__v{k}", F.regexp_extract_all("__t", F.lit(pattern), group))
    for k, (_, pattern, group, _) in enumerate(KINDS):
        some = F.size(f"__v{k}") > 0
        hit = F.regexp_extract_all("__t", F.lit(pattern), 0) if group else F.col(f"__v{k}")
        empty = F.array().cast("array<int>")
        d = d.withColumn(f"__h{k}", F.when(some, F.transform(hit, F.length)).otherwise(empty))
        d = d.withColumn(f"__p{k}", F.when(some, F.transform(F.split("__t", pattern), F.length)).otherwise(empty))
    found = [_spans(f"__h{k}", f"__p{k}", f"__v{k}", k, least) for k, (_, _, _, least) in enumerate(KINDS)]
    d = d.withColumn("found", F.sort_array(F.concat(*found)))
    return d.select(*[F.col("__doc").getField(c).alias(c) for c in docs.columns], "found")


def span_text(found: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def looks_live(value: Column, p: Ownership) -> Column:
    """Letters and digits both, and enough different characters."""
    return (value.rlike("[0-9]") & value.rlike("[A-Za-z]")
            & (F.size(F.array_distinct(F.split(value, ""))) >= p.min_distinct))


def ownership(candidates: DataFrame) -> DataFrame:
    """hash, n_owners, n_repos over the whole corpus; candidates: hash, owner, repo."""
    once = candidates.select("hash", "owner", "repo").distinct()
    owner = F.coalesce(F.col("owner"), F.lit(""))
    return once.groupBy("hash").agg(F.countDistinct(owner).alias("n_owners"), F.count(F.lit(1)).alias("n_repos"))


def classify(rows: DataFrame, owner: Column, repo: Column, p: Ownership = Ownership()) -> DataFrame:
    """From rows with ``found``: one row per span with its row id, hash, n_owners, n_repos and class."""
    spans = rows.select("__row", owner.alias("owner"), repo.alias("repo"), F.explode("found").alias("s"))
    spans = spans.select("__row", "owner", "repo", F.col("s.kind").alias("kind"), F.col("s.start").alias("start"),
                         F.sha2(F.col("s.value"), 256).alias("hash"),
                         looks_live(F.col("s.value"), p).alias("live_looking"))
    counts = ownership(spans)
    out = spans.join(counts, "hash")
    return out.withColumn("class", F.when((F.col("n_owners") >= p.copied_owners) | (F.col("n_repos") >= p.copied_repos), "copied")
                          .when(F.col("live_looking"), "live").otherwise("weak"))


def scan_corpus(docs: DataFrame, text_col: str = "text", owner: str = "source",
                repo: tuple[str, ...] = ("source", "lang"), p: Ownership = Ownership()) -> DataFrame:
    """Input columns but the text, found, n_live, n_copied (spans by class) and max_owners, max_repos (of
    the row's most widely held value) for every row.

    The scan's result (no texts) is checkpointed, so texts are read once; only rows with spans
    take part in the join."""
    repo_key = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in repo])
    rows = scan(docs.drop(*COUNTS, "__row", "__repo"), text_col).drop(text_col).withColumn("__row", F.monotonically_increasing_id())
    rows = cut(rows.withColumn("__repo", repo_key))
    some = rows.where(F.size("found") > 0)
    spans = classify(some, F.col(owner), F.col("__repo"), p)
    per_row = spans.groupBy("__row").agg(F.count_if(F.col("class") == "live").alias("n_live"),
                                         F.count_if(F.col("class") == "copied").alias("n_copied"),
                                         F.max("n_owners").alias("max_owners"), F.max("n_repos").alias("max_repos"))
    none = rows.where(F.size("found") == 0)
    zero = F.lit(0).cast("long")
    out = some.join(per_row, "__row").unionByName(none.withColumns({c: zero for c in COUNTS}))
    return out.drop("__row", "__repo")


def without_live(docs: DataFrame, p: Ownership = Ownership()) -> DataFrame:
    """Documents that hold no live credential, all columns kept."""
    found = scan_corpus(docs.select(*row_keys(), "text", "source", "lang"), p=p).where("n_live > 0")
    keyed = wrapped(docs, *row_keys())
    return unwrapped(keyed.join(found.select(*ROW_KEYS), list(ROW_KEYS), "left_anti"), docs)


def op4(spark, sf_dir):
    out = scan_corpus(table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang"))
    kinds = F.transform("found", lambda s: s["kind"])
    count = [F.size(F.filter(kinds, lambda x: x == F.lit(k))).cast("long").alias(f"n_{name}")
             for k, (name, *_) in enumerate(KINDS)]
    text = span_text(F.col("found"))
    return out.select("doc_id", *count, F.sha2(text, 256).alias("base_sha256"), text.alias("spans"),
                      *COUNTS)


def _sql(p: Ownership = Ownership()) -> str:
    q = [pattern.replace("'", "''") for _, pattern, _, _ in KINDS]
    parts = " UNION ALL ".join(
        f"""SELECT rid, source, repo, {k} AS kind, '{name}' AS name, unnest(range(1, len(h) + 1)) AS i, h, p, v
            FROM (SELECT rid, source, repo, regexp_extract_all(t, '{q[k]}') AS h, string_split_regex(t, '{q[k]}') AS p,
                         regexp_extract_all(t, '{q[k]}', {group}) AS v FROM d) WHERE len(h) > 0"""
        for k, (name, _, group, _) in enumerate(KINDS))
    least = "CASE kind " + " ".join(f"WHEN {k} THEN {x[3]}" for k, x in enumerate(KINDS)) + " END"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, source,
             concat_ws('/', coalesce(source, ''), coalesce(lang, '')) AS repo FROM documents),
m AS ({parts}),
s0 AS (SELECT rid, source, repo, kind, name, v[i] AS value, length(h[i]) AS len,
         list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0) AS a FROM m),
s AS (SELECT rid, source, repo, kind, name, value, a::BIGINT AS a, (a + len)::BIGINT AS e, sha256(value) AS hash FROM s0 WHERE length(value) >= {least}),
f AS (SELECT hash, count(DISTINCT coalesce(source, '')) AS n_owners, count(DISTINCT coalesce(source, '~') || chr(31) || repo) AS n_repos FROM s GROUP BY hash),
c AS (SELECT s.*, n_owners, n_repos, n_owners >= {p.copied_owners} OR n_repos >= {p.copied_repos} AS copied,
        regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND len(list_distinct(string_split(value, ''))) >= {p.min_distinct} AS alive
      FROM s JOIN f USING (hash)),
g AS (SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
        string_agg(name || ':' || a || ':' || e, ',' ORDER BY a, kind) AS spans,
        count(*) FILTER (NOT copied AND alive) AS n_live, count(*) FILTER (copied) AS n_copied,
        max(n_owners) AS max_owners, max(n_repos) AS max_repos FROM c GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_copied, 0)::BIGINT AS n_copied,
       coalesce(max_owners, 0)::BIGINT AS max_owners, coalesce(max_repos, 0)::BIGINT AS max_repos
FROM d LEFT JOIN g USING (rid)"""


OP4_SQL = _sql()
