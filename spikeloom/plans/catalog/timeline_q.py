"""Queries for the timeline operators (A3, D1-D5) over driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spikeloom.functions.draws import draw_uniform_sql
from spikeloom.operators import timeline as T
from spikeloom.params import GrowthParams, Timeline
from spikeloom.plans.catalog.common import ORDERS_PEAK_END, ORDERS_PRE_END, SEED as S, count_of, count_sql
from spikeloom.plans.registry import register
from spikeloom.sources.tables import USERS_STANDIN_SQL, read_table, users_standin

# the events window as a timeline: days 1-10 baseline, 11-15 peak, 16-30 after
EVENTS_TL = Timeline(pre_days=10, peak_days=5, post_days=15, base_per_day=100.0)


@register("rate_curve", f"""
SELECT day, day_date, {T.rate_curve_sql('day', EVENTS_TL)} AS expected FROM (
  SELECT range AS day, CAST(CAST(lo AS DATE) + CAST(range AS INTEGER) AS TIMESTAMP) AS day_date
  FROM (SELECT min(ts) AS lo, max(ts) AS hi FROM events) b,
       range(0, (SELECT date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) + 1 FROM events)))""")
def q_rate_curve(spark, sf):
    """The days of the events, as many as there are from the first to the last."""
    ends = read_table(spark, sf, "events").agg(F.to_date(F.min("ts")).alias("lo"), F.to_date(F.max("ts")).alias("hi")).first()
    n = (ends["hi"] - ends["lo"]).days + 1 if ends["lo"] else 0
    return T.rate_curve(T.day_source(spark, ends["lo"] or "1970-01-01", n), EVENTS_TL)


_ORDERS_DAILY_SQL = "(SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)"


def _orders_daily(spark, sf):
    return (read_table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("d"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("expand_counts", """
SELECT CAST(d AS TIMESTAMP) AS day, k_off AS offset FROM (
  SELECT d, unnest(range(0, n)) AS k_off FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n
  FROM orders GROUP BY 1))""")
def q_expand_counts(spark, sf):
    daily = _orders_daily(spark, sf)
    # chunks of 4 rows: every busy day is generated by several tasks (the skew path)
    rows = T.expand_counts(daily, "n", chunk_rows=4, offset="offset")
    return rows.select(F.col("d").cast("timestamp_ntz").alias("day"), "offset")


@register("scale_to_total", f"""
SELECT CAST(d AS TIMESTAMP) AS day, n, n_rows FROM
{T.scale_to_total_sql(f"(SELECT d, n, CAST(n AS DOUBLE) AS w FROM {_ORDERS_DAILY_SQL})", 'w', count_sql('customer'), 'd', 'n_rows')}""")
def q_scale_to_total(spark, sf):
    daily = _orders_daily(spark, sf).withColumn("w", F.col("n").cast("double"))
    out = T.scale_to_total(daily, "w", count_of(spark, sf, "customer"), "d", "n_rows")
    return out.select(F.col("d").cast("timestamp_ntz").alias("day"), "n", "n_rows")


@register("dense_ids", f"""
SELECT start + k_off AS id, CAST(d AS TIMESTAMP) AS day FROM (
  SELECT *, unnest(range(0, n)) AS k_off FROM (
    SELECT d, n, 1 + CAST(coalesce(sum(n) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
    FROM (SELECT CAST(created_at AS DATE) AS d, count(*) AS n FROM {USERS_STANDIN_SQL} GROUP BY 1)))""")
def q_dense_ids(spark, sf):
    daily = users_standin(spark, sf).groupBy(F.to_date("created_at").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    plan = T.dense_ids(daily, "n", "d", base=1, out="start")
    rows = T.expand_counts(plan, "n", chunk_rows=1_000_000)
    return rows.select((F.col("start") + F.col("offset")).alias("id"), F.col("d").cast("timestamp_ntz").alias("day"))


PARAMS = GrowthParams(seed=S)
_RATE_SQL = T.posts_rate_sql("created_at", ORDERS_PRE_END, ORDERS_PEAK_END, PARAMS)


@register("posts_per_user", f"""
SELECT user_id, k_off AS k, post_date FROM (
  SELECT id AS user_id, created_at, unnest(range(0, CAST(floor({_RATE_SQL}) AS BIGINT))) AS k_off,
         CAST(CAST(created_at AS DATE) + CAST(floor({draw_uniform_sql(S, 'ppu', 'id')} * {PARAMS.post_shift_days}) AS INTEGER) AS TIMESTAMP) AS post_date
  FROM {USERS_STANDIN_SQL} WHERE {_RATE_SQL} >= 1)""")
def q_posts_per_user(spark, sf):
    """D3 + C18: posts of each user by join period, 0 to 29 days after joining."""
    rows = T.posts_per_user(users_standin(spark, sf), "id", "created_at", ORDERS_PRE_END, ORDERS_PEAK_END, PARAMS)
    return rows.withColumnRenamed("id", "user_id")
