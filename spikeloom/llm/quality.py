"""Quality rules (operator 6): a threshold table compiled into one Spark projection.

``quality_signals`` adds counts of length, symbols, stop words, lines and repetition;
``apply_rules`` compiles a table of ``Rule`` rows into a boolean per rule plus ``failed`` (names
of the rules that fired) and ``kept``. Everything is built-in expressions over one row: no
shuffle, no join, no user function. All ratios are compared as integers
(``100 * signal > limit * base``), so nothing depends on floating point.

Defined results: a null text counts as empty (no words, not kept); extra columns pass through
(those named like an output are replaced); repeated rows are judged one by one; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikeloom.llm.common import ascii_lower, named, text_of, unwrapped, words, wrapped

SYMBOLS = "#*$%&|<>"
WINDOW = 5
SIGNALS = ("n_words", "word_chars", "n_symbols", "n_exclaims", "n_stop_words", "n_lines", "n_dup_lines",
           "n_bullets", "n_ellipses", "n_repeat_words")
# common function words of the four languages the default table is meant for
STOP_WORDS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "be",
    "de", "la", "le", "et", "les", "des", "en", "un", "que", "est", "du", "une",
    "el", "y", "los", "se", "las", "por", "con", "no",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "ist", "nicht",
)


@dataclass(frozen=True)
class Rule:
    """Fires when ``100 * signal`` is above (or below) ``percent * base``, for texts of at least
    ``min_words`` words."""

    name: str
    signal: str
    base: str
    percent: int
    above: bool = True
    min_words: int = 0


BASE_RULES = (
    Rule("few_words", "n_words", "one", 1000, above=False),
    Rule("repetition", "n_repeat_words", "n_words", 20),
)
METHOD_RULES = (
    Rule("short_words", "word_chars", "n_words", 200, above=False),
    Rule("long_words", "word_chars", "n_words", 1200),
    Rule("symbols", "n_symbols", "n_words", 10),
    Rule("shouting", "n_exclaims", "n_words", 50),
    Rule("no_stop_words", "n_stop_words", "n_words", 1, above=False, min_words=50),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", 40),
    Rule("bullet_lines", "n_bullets", "n_lines", 90),
    Rule("ellipsis_lines", "n_ellipses", "n_lines", 30),
)


def _covered(z: Column) -> Column:
    """Words inside windows whose hash is shared: z is the sorted array of (hash, position)."""
    last = F.size(z) - 1
    shared = F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i:
                      ((i > 0) & (F.get(z, i)["h"] == F.get(z, i - 1)["h"]))
                      | ((i < last) & (F.get(z, i)["h"] == F.get(z, i + 1)["h"])))
    starts = F.sort_array(F.transform(shared, lambda i: F.get(z, i)["p"]))
    folded = F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"),
                                p.alias("last")))
    return folded["n"].cast("long")


def quality_signals(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_exclaims, n_stop_words, n_lines, n_dup_lines,
    n_bullets, n_ellipses and n_repeat_words (all long)."""
    keep = [c for c in docs.columns if c not in (*SIGNALS, "base_failed", "failed", "kept")]
    own = "__q"         # columns made on the way have names that the input has not
    while any(c.startswith(own) for c in docs.columns):
        own += "_"
    t_, w_, lines_, h_, z_ = (f"{own}{x}" for x in ("t", "w", "lines", "h", "z"))
    d = docs.withColumn(t_, text_of(F.col(f"`{text_col}`")))
    d = d.withColumn(w_, words(F.col(t_)))
    d = d.withColumn(lines_, F.filter(F.split(t_, "\n"),
                                         lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", "    ")) != ""))
    n = F.size(w_)
    d = d.withColumn(h_, F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w_, i, WINDOW))))
        .otherwise(F.array().cast("array<bigint>")))
    # most texts repeat no window: only the others sort their windows
    d = d.withColumn(z_, F.when(F.size(F.array_distinct(h_)) < F.size(h_), F.sort_array(
        F.transform(h_, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))))
    n_lines = F.size(lines_)
    return d.select(
        *named(keep),
        n.cast("long").alias("n_words"),
        F.length(F.translate(t_, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(t_) - F.length(F.translate(t_, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(t_) - F.length(F.translate(t_, "!", ""))).cast("long").alias("n_exclaims"),
        F.size(F.filter(w_, lambda w: ascii_lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        n_lines.cast("long").alias("n_lines"),
        (n_lines - F.size(F.array_distinct(lines_))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(lines_, lambda x: F.ltrim(x).substr(1, 1).isin("-", "*", "•"))).cast("long").alias("n_bullets"),
        F.size(F.filter(lines_, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).cast("long").alias("n_ellipses"),
        F.when(F.col(z_).isNull(), F.lit(0).cast("long")).otherwise(_covered(F.col(z_))).alias("n_repeat_words"),
    )


def _fires(r: Rule) -> Column:
    base = F.lit(1) if r.base == "one" else F.col(r.base)
    left, right = F.col(r.signal) * 100, base * r.percent
    hit = (left > right) if r.above else (left < right)
    return hit & (F.col("n_words") >= r.min_words)


def apply_rules(signals: DataFrame, rules: tuple[Rule, ...] = METHOD_RULES,
                base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Adds base_failed, failed (names of all rules that fire, in table order) and kept."""
    base_failed = F.lit(False)
    for r in base:
        base_failed = base_failed | _fires(r)
    names = F.array_compact(F.array(*[F.when(_fires(r), F.lit(r.name)) for r in (*base, *rules)]))
    out = signals.withColumn("base_failed", base_failed).withColumn("failed", names)
    return out.withColumn("kept", F.size("failed") == 0)


def judge(docs: DataFrame, text_col: str = "text") -> DataFrame:
    return apply_rules(quality_signals(docs, text_col))


def passing(docs: DataFrame) -> DataFrame:
    """The texts no rule rejects, all columns kept. The row number (never below 0) keeps the
    optimizer from moving the filter below the projections, where it would expand every signal
    into every place that uses it."""
    verdict = F.col("kept") & (F.monotonically_increasing_id() >= 0)
    judged = judge(wrapped(docs, "text"))
    return unwrapped(judged.withColumn("__passes", verdict).where("__passes"), docs)


def op6(spark, sf_dir):
    from spikeloom.llm.common import table
    out = judge(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "n_stop_words", "base_failed", "kept")


def _sql_rule(r: Rule) -> str:
    base = "1" if r.base == "one" else r.base
    return f"(100 * {r.signal} {'>' if r.above else '<'} {r.percent} * {base} AND n_words >= {r.min_words})"


def _sql() -> str:
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    lower = "translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = r"'[^\x20\x09-\x0D]+'"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, {word}) AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {word})) AS lines FROM d),
win AS (SELECT rid, unnest(list_transform(range(1, len(w) - 3), lambda i: {{'i': i, 'g': array_to_string(w[i:i + 4], ' ')}})) AS x FROM w WHERE len(w) >= 5),
g AS (SELECT rid, x.i AS i, count(*) OVER (PARTITION BY rid, x.g) AS c FROM win),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM g WHERE c > 1) GROUP BY rid),
s AS (SELECT doc_id, len(w)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (length(t) - length(replace(t, '!', '')))::BIGINT AS n_exclaims,
        len(list_filter(w, lambda x: {lower} IN ({stop})))::BIGINT AS n_stop_words,
        len(lines)::BIGINT AS n_lines,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        len(list_filter(lines, lambda x: ltrim(x, ' ')[1] IN ('-', '*', '•')))::BIGINT AS n_bullets,
        len(list_filter(lines, lambda x: rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%…'))::BIGINT AS n_ellipses,
        coalesce(cov.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cov USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words,
       ({' OR '.join(map(_sql_rule, BASE_RULES))}) AS base_failed,
       NOT ({' OR '.join(map(_sql_rule, (*BASE_RULES, *METHOD_RULES)))}) AS kept
FROM s"""


OP6_SQL = _sql()
