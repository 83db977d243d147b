"""WARC (operator 2): not-modified revisit records resolved to the response they stand for.

A revisit record says "as before" and holds no payload. ``resolve_revisits`` finds, by canonical URL,
the latest earlier full response (an as-of join), checks the revisit's validators against it (ETag by weak
comparison, else Last-Modified, else the payload digest) and merges the headers that a 304 may update into
the stored ones. Verdicts: ``not_modified``, ``changed`` (a validator differs), ``unchecked`` (no validator
on both sides), ``missing`` (no earlier response).

The as-of join has two levels, so a URL with a third of all captures is no single task: captures are cut
into time buckets of about equal rows; inside a (URL, bucket) a window carries the last response forward, and the last
response of earlier buckets comes from a window over one row per (URL, bucket). Payloads are not
shuffled; the result names the response record.

Defined results: a null URL has the canonical form '' ; a null time sorts first and has no earlier response;
of responses at one time the largest id counts; a response at the very time of the revisit is not
earlier; repeated records are resolved one by one; other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spikeloom.llm.common import ascii_lower, table, text_of

# fixed values: header fields that a not-modified answer may update
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
N_BUCKETS = 256
RECRAWL = 1_000         # seconds after which the query's derived revisits come


def canonical_url(url: Column) -> Column:
    """Host without 'www.' and default port, A-Z lower-cased; path without a trailing '/'; query
    parameters sorted, tracking ones left out; no scheme, no fragment."""
    u = F.regexp_replace(F.regexp_replace(text_of(url), "^[A-Za-z][A-Za-z0-9+.-]*://", ""), "#.*$", "")
    host = F.regexp_replace(F.regexp_replace(ascii_lower(F.regexp_extract(u, "^[^/?]*", 0)), "^www[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(u, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.filter(F.split(F.regexp_extract(u, r"^[^?]*\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    joined = F.array_join(F.array_sort(query), "&")
    return F.concat(host, path, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise(""))


def _same(a: Column, b: Column) -> Column:
    """Whether two validators agree; null if either is missing."""
    return F.when(a.isNotNull() & b.isNotNull(), a == b)


def _strong(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def resolve_revisits(records: DataFrame, n_buckets: int = N_BUCKETS) -> DataFrame:
    """Records: record_id, url, ts (seconds), kind ('response' or 'revisit'), etag, last_modified, digest,
    headers (map). Returns per revisit: record_id, canonical_url, ts, response_id, verdict, headers."""
    r = records.select("record_id", canonical_url(F.col("url")).alias("canonical_url"), F.col("ts").cast("double").alias("ts"),
                       (F.col("kind") == "response").alias("full"), "etag", "last_modified", "digest", "headers")
    # buckets of about equal rows: a burst of captures is cut as finely as it is dense
    cuts = [i / n_buckets for i in range(1, n_buckets)]
    ends = sorted(set((r.agg(F.percentile_approx("ts", cuts or [0.5], 10_000)).first()[0] or []))) if cuts else []
    at = F.size(F.filter(F.array(*[F.lit(float(x)) for x in ends]), lambda x: x < F.col("ts"))) if ends else F.lit(0)
    r = r.withColumn("bucket", F.when(F.col("ts").isNull(), F.lit(-1)).otherwise(at))
    response = F.struct("ts", "record_id", "etag", "last_modified", "digest", "headers")
    r = r.withColumn("response", F.when(F.col("full") & F.col("ts").isNotNull(), response))
    # the last response of each bucket (map keys can't be compared, so by time and id), then of all before it
    newest = F.max_by("response", F.when(F.col("response").isNotNull(), F.struct("ts", "record_id")))
    buckets = r.groupBy("canonical_url", "bucket").agg(newest.alias("newest"))
    before = W.partitionBy("canonical_url").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    carried = buckets.select("canonical_url", "bucket", F.last("newest", ignorenulls=True).over(before).alias("carried"))
    # revisits sort before responses of the same time: only what is earlier is seen
    inside = W.partitionBy("canonical_url", "bucket").orderBy("ts", F.col("full"), "record_id").rowsBetween(W.unboundedPreceding, -1)
    seen = r.withColumn("here", F.last("response", ignorenulls=True).over(inside)).where(~F.col("full")).drop("response")
    out = seen.join(carried, ["canonical_url", "bucket"], "left")
    found = F.when(F.col("ts").isNotNull(), F.coalesce("here", "carried"))
    out = out.withColumn("found", found)
    agree = F.coalesce(_same(_strong(F.col("etag")), _strong(F.col("found.etag"))),
                       _same(F.col("last_modified"), F.col("found.last_modified")), _same(F.col("digest"), F.col("found.digest")))
    verdict = (F.when(F.col("found").isNull(), "missing").when(agree.isNull(), "unchecked")
               .when(agree, "not_modified").otherwise("changed"))
    own = F.coalesce("headers", F.create_map().cast("map<string,string>"))
    # header names are the same in any letter case
    update = F.map_filter(own, lambda k, v: ascii_lower(k).isin(*PERMITTED))
    names = F.transform(F.map_keys(update), ascii_lower)
    old = F.coalesce("found.headers", F.create_map().cast("map<string,string>"))
    kept = F.map_filter(old, lambda k, v: ~F.array_contains(names, ascii_lower(k)))
    merged = F.when(F.col("verdict").isin("not_modified", "unchecked"), F.map_concat(kept, update))
    return out.withColumn("verdict", verdict).select(
        "record_id", "canonical_url", "ts", F.col("found.record_id").alias("response_id"), "verdict", merged.alias("headers"))


def page_records(pages: DataFrame) -> DataFrame:
    """WARC records of a page table: each page as a response at second page_id, and a revisit of its URL
    ``RECRAWL`` seconds later that repeats the page's own validators."""
    html = text_of("html")
    etag = F.concat(F.lit('"'), F.substring(F.md5(html), 1, 16), F.lit('"'))
    size = F.octet_length(html).cast("string")
    base = pages.select("page_id", "url", etag.alias("etag"), F.sha1(html).alias("digest"), size.alias("size"))
    full = F.struct(F.lit("response").alias("kind"), F.col("page_id").alias("ts"), F.col("etag"),
                    F.create_map(F.lit("content-length"), F.col("size"), F.lit("content-type"), F.lit("text/html"), F.lit("date"),
                                 F.col("page_id").cast("string"), F.lit("etag"), F.col("etag")).alias("headers"))
    again = F.struct(F.lit("revisit").alias("kind"), (F.col("page_id") + RECRAWL).alias("ts"), F.concat(F.lit("W/"), F.col("etag")).alias("etag"),
                     F.create_map(F.lit("date"), (F.col("page_id") + RECRAWL).cast("string"), F.lit("server"), F.lit("edge"),
                                  F.lit("etag"), F.concat(F.lit("W/"), F.col("etag"))).alias("headers"))
    rows = base.withColumn("r", F.explode(F.array(full, again)))
    return rows.select(F.col("page_id").alias("record_id"), "url", "r.ts", "r.kind", "r.etag",
                       F.lit(None).cast("string").alias("last_modified"), "digest", "r.headers")


def header_text(headers: Column) -> Column:
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat_ws(": ", e["key"], e["value"]))), "\n")


def op2(spark, sf_dir):
    out = resolve_revisits(page_records(table(spark, sf_dir, "pages", "page_id", "url", "html")))
    return out.select(F.col("record_id").alias("page_id"), "canonical_url", F.col("response_id"), "verdict",
                      header_text(F.col("headers")).alias("headers"))


OP2_SQL = rf"""
WITH p AS (SELECT page_id, regexp_replace(regexp_replace(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '') AS u,
        '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS etag, CAST(strlen(coalesce(html, '')) AS VARCHAR) AS size FROM pages),
q AS (SELECT *, regexp_replace(regexp_replace(translate(regexp_extract(u, '^[^/?]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^www[.]', ''), ':(80|443)$', '')
        || regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') AS base,
        array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '^[^?]*\?(.*)$', 1), '&'),
            lambda x: x <> '' AND NOT regexp_matches(x, '{TRACKING}'))), '&') AS query FROM p),
c AS (SELECT page_id, base || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canonical_url, etag, size FROM q),
j AS (SELECT v.page_id, v.canonical_url, v.etag, r.page_id AS response_id, r.etag AS old, r.size,
        row_number() OVER (PARTITION BY v.page_id ORDER BY r.page_id DESC NULLS LAST) AS n
      FROM c v LEFT JOIN c r ON r.canonical_url = v.canonical_url AND r.page_id < v.page_id + {RECRAWL})
SELECT page_id, canonical_url, response_id, CASE WHEN response_id IS NULL THEN 'missing' WHEN old = etag THEN 'not_modified' ELSE 'changed' END AS verdict,
       CASE WHEN old = etag THEN 'content-length: ' || size || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || (page_id + {RECRAWL})
            || chr(10) || 'etag: W/' || etag END AS headers
FROM j WHERE n = 1"""
