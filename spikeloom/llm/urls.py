"""URL filters (operator 7): Empirical-Bayes host reputation.

Labelled page outcomes are counted per host, registered domain and suffix (one aggregate each, the
upper levels from the lower ones). Each level's beta prior takes its mean from the level above
(suffix from the whole corpus, domain from its suffix, host from its domain) and its strength
from a beta-binomial moment estimate over that level's groups. A page is blocked when the lower
posterior bound of its host's bad share passes ``max_bad``; fixed allow/block rules (longest
match) come first.

Defined results: a null url, or one without ``://``, has empty host and path and is judged as
the host ''. Labels without a page, or with null values, count for nothing; several labels of one
id count as one outcome (bad if any is bad). Repeated pages are judged and counted one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikeloom.llm.common import ascii_lower, table, text_of
from spikeloom.session import stored

# fixed values: rules of (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# public suffixes of two labels that the default split knows
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br")


@dataclass(frozen=True)
class Reputation:
    max_bad: float = 0.30       # block above this lower bound of the bad share
    z: float = 1.64             # one-sided 95 % bound
    mean: float = 0.10          # corpus prior mean where nothing is labelled
    weight: float = 2.0         # outcomes that prior counts for
    min_rho: float = 0.01       # least and most overdispersion a level may show
    max_rho: float = 0.90


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without '://'."""
    u = text_of(url)
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else nulls."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in reversed(ordered):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def host_levels(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host (user name and port left out)."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    two = F.substring_index(bare, ".", -2)
    suffix = F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(bare, ".", -1))
    domain = F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(bare, ".", -3)).otherwise(two)
    return domain, suffix


def _strength(groups: DataFrame, p: Reputation) -> float:
    """Prior weight of one level, from groups of (n, k, m = parent's mean):
    E[(k - n m)^2 / (n m (1 - m))] = 1 + (n - 1) rho."""
    chi = F.pow(F.col("k") - F.col("n") * F.col("m"), 2) / (F.col("n") * F.col("m") * (1 - F.col("m")))
    rho = groups.where("n > 0").agg(
        ((F.sum(chi) - F.count(F.lit(1))) / F.sum(F.col("n") - 1)).alias("rho"))
    rho = rho.select(F.least(F.greatest(F.coalesce(F.try_divide(F.col("rho"), F.lit(1.0)), F.lit(p.max_rho)),
                                        F.lit(p.min_rho)), F.lit(p.max_rho)).alias("rho"))
    return rho.select((1 / F.col("rho") - 1).alias("s")).first()[0]


def host_reputation(pages: DataFrame, outcomes: DataFrame, p: Reputation = Reputation()) -> DataFrame:
    """Per host: n labelled pages, k bad ones, post_mean and post_lower of the bad share.

    ``pages``: page_id, host. ``outcomes``: page_id, bad (0/1), one row per page_id. The table of hosts is stored
    once, and the levels above are sums of it; one number per level (its prior's weight) goes through the driver."""
    seen = pages.select("page_id", "host").join(outcomes, "page_id", "left")
    hosts = seen.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
    domain, suffix = host_levels(F.col("host"))
    hosts = stored(hosts.withColumn("domain", domain).withColumn("suffix", suffix))
    sums = (F.sum("n").alias("n"), F.sum("k").alias("k"))
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = hosts.groupBy("suffix").agg(*sums)
    top = hosts.agg(((F.coalesce(F.sum("k"), F.lit(0)) + p.mean * p.weight)
                     / (F.coalesce(F.sum("n"), F.lit(0)) + p.weight)).alias("m")).first()[0]

    def shrink(level: DataFrame) -> DataFrame:
        s = F.lit(float(_strength(level, p)))
        a = F.col("k") + F.col("m") * s
        return level.withColumn("a", a).withColumn("b", F.col("n") + s - F.col("a")) \
            .withColumn("mean", F.col("a") / (F.col("a") + F.col("b")))

    suffixes = stored(shrink(suffixes.withColumn("m", F.lit(float(top)))))
    domains = stored(shrink(stored(domains.join(suffixes.select("suffix", F.col("mean").alias("m")), "suffix"))))
    hosts = shrink(stored(hosts.join(domains.select("domain", "suffix", F.col("mean").alias("m")), ["domain", "suffix"])))
    total = F.col("a") + F.col("b")
    sd = F.sqrt(F.col("a") * F.col("b") / (total * total * (total + 1)))
    return hosts.select("host", "n", "k", F.col("mean").alias("post_mean"),
                        (F.col("mean") - p.z * sd).alias("post_lower"))


def label_outcomes(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One outcome per labelled id: bad when of low quality or toxic."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(
        F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    return (labels.select(F.col(id_col).alias("page_id"), bad.alias("bad"))
            .where("page_id IS NOT NULL AND bad IS NOT NULL")
            .groupBy("page_id").agg(F.max("bad").cast("long").alias("bad")))


def filter_urls(pages: DataFrame, outcomes: DataFrame, p: Reputation = Reputation(), rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, n_labelled, n_bad for every page."""
    host, path = url_parts(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rep = host_reputation(parsed, outcomes, p).withColumnRenamed("host", "__host")
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("post_lower") > p.max_bad, "block").otherwise("allow")
    # hosts far outnumber any bound, so a shuffle join; a host with a third of the pages is split
    # by adaptive skew handling (its reputation is one row)
    out = parsed.join(rep, parsed["host"] == rep["__host"], "left")
    return out.select("page_id", "host", "path", name.alias("rule"),
                      F.coalesce(verdict, method).alias("verdict"),
                      F.col("n").alias("n_labelled"), F.col("k").cast("long").alias("n_bad"))


def op7(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages", "page_id", "url"),
                       label_outcomes(table(spark, sf_dir, "labels")))


def _sql(p: Reputation = Reputation()) -> str:
    two = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
    ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{s}')", h + s, v) for v, h, s in ordered]
    name = "CASE " + " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits) + " END"

    def strength(t: str) -> str:
        return (f"(SELECT 1 / least(greatest(coalesce((sum(pow(k - n * m, 2) / (n * m * (1 - m))) - count(*)) "
                f"/ nullif(sum(n - 1), 0), {p.max_rho}), {p.min_rho}), {p.max_rho}) - 1 FROM {t} WHERE n > 0)")
    return rf"""
WITH u AS (SELECT page_id, coalesce(url, '') AS u, strpos(coalesce(url, ''), '://') AS pos FROM pages),
r AS (SELECT page_id, CASE WHEN pos > 0 THEN u[pos + 3:] ELSE '' END AS rest FROM u),
pg AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
o AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels
      WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY 1),
h0 AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS k, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare
       FROM pg LEFT JOIN o USING (page_id) GROUP BY host),
h1 AS (SELECT host, n, k, string_split(bare, '.') AS l, array_to_string(list_slice(string_split(bare, '.'), -2, -1), '.') AS two FROM h0),
h2 AS (SELECT host, n, k, CASE WHEN two IN ({two}) THEN array_to_string(list_slice(l, -3, -1), '.') ELSE two END AS domain,
         CASE WHEN two IN ({two}) THEN two ELSE l[len(l)] END AS suffix FROM h1),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h2 GROUP BY ALL),
s0 AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d0 GROUP BY ALL),
s1 AS (SELECT *, (SELECT (sum(k) + {p.mean * p.weight}) / (sum(n) + {p.weight}) FROM s0) AS m FROM s0),
s2 AS (SELECT suffix, (k + m * st) / (n + st) AS mean FROM s1, (SELECT {strength('s1')} AS st)),
d1 AS (SELECT d0.*, mean AS m FROM d0 JOIN s2 USING (suffix)),
d2 AS (SELECT domain, suffix, (k + m * st) / (n + st) AS mean FROM d1, (SELECT {strength('d1')} AS st)),
h3 AS (SELECT h2.*, mean AS m FROM h2 JOIN d2 USING (domain, suffix)),
h4 AS (SELECT host, n, k, k + m * st AS a, n + st - (k + m * st) AS b FROM h3, (SELECT {strength('h3')} AS st)),
rep AS (SELECT host, n, k, a / (a + b) - {p.z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS low FROM h4)
SELECT page_id, host, path, {name} AS rule,
       coalesce({verdict}, CASE WHEN low > {p.max_bad} THEN 'block' ELSE 'allow' END) AS verdict,
       n::BIGINT AS n_labelled, k::BIGINT AS n_bad
FROM pg LEFT JOIN rep USING (host)"""


OP7_SQL = _sql()
