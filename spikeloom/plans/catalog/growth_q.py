"""Queries for checks (J1-J6), growth analytics (K2, K6-K9, K12), F6 and A14 on driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spikeloom.operators import checks as J
from spikeloom.operators import growth as K
from spikeloom.plans.catalog.common import ORDERS_PEAK_END, ORDERS_PRE_END
from spikeloom.plans.registry import register
from spikeloom.sources.tables import USERS_STANDIN_SQL, read_table, users_standin

SEGMENTS = (("AUTOMOBILE", 1.0), ("BUILDING", 1.0), ("FURNITURE", 1.0), ("HOUSEHOLD", 1.0), ("MACHINERY", 1.0))


@register("check_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def q_check_unique(spark, sf):
    return J.check_unique(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("check_foreign_key", """
SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)""")
def q_check_foreign_key(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return J.check_foreign_key(li, "l_suppkey", read_table(spark, sf, "supplier"), "s_suppkey")


@register("check_no_self", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM lineitem WHERE l_suppkey = l_partkey""")
def q_check_no_self(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    return J.check_no_self(li, "l_suppkey", "l_partkey")


@register("check_shares", """
WITH g AS (SELECT c_mktsegment, count(*) AS n_rows FROM customer GROUP BY 1),
 t AS (SELECT sum(n_rows) AS total FROM g)
SELECT c_mktsegment, n_rows, 0.2::DOUBLE AS target, round(n_rows / total, 6) AS share,
       abs(n_rows / total - 0.2) <= 4.0 * sqrt(0.2 * 0.8 / total) + 1e-12 AS ok FROM g, t""")
def q_check_shares(spark, sf):
    return J.check_shares(read_table(spark, sf, "customer"), "c_mktsegment", SEGMENTS).select(
        "c_mktsegment", "n_rows", "target", "share", "ok")


@register("check_not_null", """
SELECT column_name, null_count FROM (
  SELECT 'o_orderkey' AS column_name, count(*) - count(o_orderkey) AS null_count FROM orders
  UNION ALL SELECT 'o_custkey', count(*) - count(o_custkey) FROM orders
  UNION ALL SELECT 'o_orderstatus', count(*) - count(o_orderstatus) FROM orders
  UNION ALL SELECT 'o_orderdate', count(*) - count(o_orderdate) FROM orders)""")
def q_check_not_null(spark, sf):
    o = read_table(spark, sf, "orders")
    return J.check_not_null(o, ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])


@register("monthly_volume", f"""
SELECT CAST(year(created_at) AS BIGINT) AS year, CAST(month(created_at) AS BIGINT) AS month, count(*) AS n_rows,
       'users' AS table_name FROM {USERS_STANDIN_SQL} GROUP BY 1, 2
UNION ALL SELECT CAST(year(o_orderdate) AS BIGINT), CAST(month(o_orderdate) AS BIGINT), count(*), 'posts' FROM orders GROUP BY 1, 2
UNION ALL SELECT CAST(year(ts) AS BIGINT), CAST(month(ts) AS BIGINT), count(*), 'events' FROM events GROUP BY 1, 2""")
def q_monthly_volume(spark, sf):
    return K.monthly_volume({
        "users": users_standin(spark, sf),
        "posts": read_table(spark, sf, "orders").withColumnRenamed("o_orderdate", "created_at"),
        "events": read_table(spark, sf, "events").withColumnRenamed("ts", "created_at")})


_VOLUME = f"""(SELECT CAST(year(created_at) AS BIGINT) AS year, CAST(month(created_at) AS BIGINT) AS month, count(*) AS n_rows,
       'users' AS table_name FROM {USERS_STANDIN_SQL} GROUP BY 1, 2
UNION ALL SELECT CAST(year(o_orderdate) AS BIGINT), CAST(month(o_orderdate) AS BIGINT), count(*), 'posts' FROM orders GROUP BY 1, 2)"""


@register("first_months", f"""
SELECT year, month, n_rows, table_name FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY year, month) AS r FROM {_VOLUME}) WHERE r <= 6
ORDER BY table_name, year, month""")
def q_first_months(spark, sf):
    volume = K.monthly_volume({"users": users_standin(spark, sf),
                               "posts": read_table(spark, sf, "orders").withColumnRenamed("o_orderdate", "created_at")})
    return K.first_months(volume, 6)


def _cohort_sql(unit, since):
    return f"""
WITH u AS (SELECT id, created_at AS j, CAST(date_trunc('{unit}', created_at) AS TIMESTAMP) AS cohort FROM {USERS_STANDIN_SQL}),
 a AS (SELECT DISTINCT u.cohort, CAST({since} AS BIGINT) AS period_n, u.id
       FROM orders o JOIN u ON u.id = o.o_custkey WHERE o.o_orderdate >= u.j),
 act AS (SELECT cohort, period_n, count(*) AS active_users FROM a GROUP BY 1, 2),
 sz AS (SELECT cohort, count(*) AS cohort_users FROM u GROUP BY 1)
SELECT act.cohort, period_n, active_users, cohort_users, round(active_users / cohort_users, 6) AS retention
FROM act JOIN sz USING (cohort)"""


def _cohort(spark, sf, unit):
    return K.cohort_retention(users_standin(spark, sf), "id", "created_at", read_table(spark, sf, "orders"),
                              "o_custkey", "o_orderdate", unit)


@register("cohort_retention", _cohort_sql(
    "month", "(year(o.o_orderdate) - year(u.cohort)) * 12 + month(o.o_orderdate) - month(u.cohort)"))
def q_cohort_retention(spark, sf):
    return _cohort(spark, sf, "month")


@register("cohort_retention_weeks", _cohort_sql(
    "week", "floor(date_diff('day', CAST(u.cohort AS DATE), CAST(o.o_orderdate AS DATE)) / 7)"))
def q_cohort_retention_weeks(spark, sf):
    return _cohort(spark, sf, "week")


@register("churn_after_spike", f"""
WITH s AS (SELECT id, created_at FROM {USERS_STANDIN_SQL}
           WHERE created_at >= TIMESTAMP '{ORDERS_PRE_END}' AND created_at < TIMESTAMP '{ORDERS_PEAK_END}'),
 late AS (SELECT DISTINCT s.id FROM s JOIN orders o ON o.o_custkey = s.id
          WHERE o.o_orderdate >= s.created_at + INTERVAL 30 DAY)
SELECT count(*) AS spike_users, (SELECT count(*) FROM s WHERE id NOT IN (SELECT id FROM late)) AS churned_users,
       round((SELECT count(*) FROM s WHERE id NOT IN (SELECT id FROM late)) / count(*), 6) AS churn_rate FROM s""")
def q_churn_after_spike(spark, sf):
    return K.churn_after_spike(users_standin(spark, sf), "id", "created_at", read_table(spark, sf, "orders"),
                               "o_custkey", "o_orderdate", ORDERS_PRE_END, ORDERS_PEAK_END, 30)


_PER = (f"CASE WHEN o_orderdate < TIMESTAMP '{ORDERS_PRE_END}' THEN 'pre' "
        f"WHEN o_orderdate < TIMESTAMP '{ORDERS_PEAK_END}' THEN 'peak' ELSE 'post' END")


@register("content_virality", f"""
WITH g AS (SELECT {_PER} AS period, count(*) AS posts, count(DISTINCT o_custkey) AS authors FROM orders GROUP BY 1)
SELECT period, posts, authors, round(posts / authors, 6) AS posts_per_author,
       round((posts / authors) / (SELECT posts / authors FROM g WHERE period = 'pre'), 6) AS virality FROM g""")
def q_content_virality(spark, sf):
    return K.content_virality(read_table(spark, sf, "orders"), "o_custkey", "o_orderdate",
                              ORDERS_PRE_END, ORDERS_PEAK_END)


@register("network_effect", f"""
WITH du AS (SELECT CAST(CAST(created_at AS DATE) AS TIMESTAMP) AS day, count(*) AS new_users FROM {USERS_STANDIN_SQL} GROUP BY 1),
 df AS (SELECT CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS day, count(*) AS new_follows FROM lineitem GROUP BY 1),
 days AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS TIMESTAMP) AS day FROM (SELECT day FROM du UNION ALL SELECT day FROM df)),
 d AS (SELECT days.day, coalesce(new_users, 0) AS new_users, coalesce(new_follows, 0) AS new_follows
       FROM days LEFT JOIN du ON du.day = days.day LEFT JOIN df ON df.day = days.day)
SELECT day, new_users, new_follows, round(new_follows / nullif(new_users, 0), 6) AS follows_per_user,
       round(new_users / nullif(lag(new_users) OVER (ORDER BY day), 0), 6) AS user_growth,
       round(new_follows / nullif(lag(new_follows) OVER (ORDER BY day), 0), 6) AS follow_growth FROM d""")
def q_network_effect(spark, sf):
    return K.network_effect(users_standin(spark, sf), "created_at", read_table(spark, sf, "lineitem"), "l_shipdate")


@register("spike_days", """
WITH c AS (SELECT CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day, count(*) AS n FROM orders GROUP BY 1),
 d AS (SELECT s.day, coalesce(c.n, 0) AS n FROM (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS TIMESTAMP) AS day FROM c) s
       LEFT JOIN c ON c.day = s.day),
 w AS (SELECT day, n, avg(n) OVER x AS m, stddev_samp(n) OVER x AS s FROM d
       WINDOW x AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT day, n, round(m, 6) AS trailing_mean, round(s, 6) AS trailing_sd, coalesce(n > m + 3.0 * s, false) AS is_spike FROM w""")
def q_spike_days(spark, sf):
    daily = K.daily_counts(read_table(spark, sf, "orders"), "o_orderdate", "n")
    return K.spike_days(daily, "day", "n", 7, 3.0)


@register("posts_per_user_ratio", f"""
SELECT round(CAST((SELECT count(*) FROM orders) AS DOUBLE) / (SELECT count(*) FROM {USERS_STANDIN_SQL}), 6) AS posts_per_user""")
def q_posts_per_user_ratio(spark, sf):
    users = users_standin(spark, sf).agg(F.count(F.lit(1))).scalar()
    return read_table(spark, sf, "orders").agg(F.round(F.count(F.lit(1)) / users, 6).alias("posts_per_user"))


@register("table_samples", """
SELECT * FROM (SELECT 'users sample' AS info, c_custkey AS id, c_name AS name FROM customer ORDER BY c_custkey LIMIT 3)
UNION ALL SELECT * FROM (SELECT 'posts sample', o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 3)
UNION ALL SELECT * FROM (SELECT 'events sample', event_id, event_type FROM events ORDER BY event_id LIMIT 3)""")
def q_table_samples(spark, sf):
    """The first rows by key of three tables (ordered limits: no full sort)."""
    parts = [read_table(spark, sf, t).orderBy(key).limit(3).select(F.lit(info).alias("info"), F.col(key).alias("id"), F.col(name).alias("name"))
             for info, t, key, name in (("users sample", "customer", "c_custkey", "c_name"), ("posts sample", "orders", "o_orderkey", "o_orderstatus"),
                                        ("events sample", "events", "event_id", "event_type"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
