"""Queries for joins (E2-E8) and edges (L1-L3) over driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spikeloom.functions.draws import draw_int_sql, draw_uniform, draw_uniform_sql, power_law_id, power_law_id_sql
from spikeloom.operators import joins as E
from spikeloom.operators.checks import check_foreign_key
from spikeloom.operators.edges import activated_follows, add_reciprocal, degree_edges, feistel_walk_sql, uniform_edges, unique_edges
from spikeloom.params import POWER_LAW_80_20, GrowthParams
from spikeloom.plans.catalog.common import (
    EVENTS_PEAK_END, EVENTS_PEAK_START, ORDERS_PEAK_END, ORDERS_PRE_END, SEED as S, count_sql)
from spikeloom.plans.registry import register
from spikeloom.session import stored
from spikeloom.sources.tables import USERS_STANDIN_SQL, read_table, users_standin


@register("range_join_30d", f"""
SELECT u.id AS user_id, o.o_orderkey AS order_key FROM {USERS_STANDIN_SQL} u JOIN orders o
  ON o.o_custkey = u.id AND date_diff('day', CAST(u.created_at AS DATE), CAST(o.o_orderdate AS DATE)) BETWEEN 0 AND 30""")
def q_range_join_30d(spark, sf):
    u = users_standin(spark, sf).select(F.col("id").alias("user_id"), "created_at")
    o = read_table(spark, sf, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("order_key"), "o_orderdate")
    return E.range_join_days(u, "created_at", o, "o_orderdate", 0, 30, on=["user_id"]).select("user_id", "order_key")


def _pick_sql(rows_sql: str, row_key: str, row_date: str, lead: int, tag: str, self_key: str | None) -> str:
    """DuckDB twin of pick_eligible over the users stand-in as the pool ."""
    u = draw_uniform_sql(S, tag, f"r.{row_key}")
    if self_key:
        own = f"(SELECT pos FROM pool WHERE pool.pk = r.{self_key})"
        inside = f"({own} IS NOT NULL AND {own} <= r.big_n)"
        m = f"(CASE WHEN {inside} THEN r.big_n - 1 ELSE r.big_n END)"
        raw = f"(CAST(floor({u} * {m}) AS BIGINT) + 1)"
        want = f"(CASE WHEN {m} > 0 THEN (CASE WHEN {inside} AND {raw} >= {own} THEN {raw} + 1 ELSE {raw} END) END)"
    else:
        want = f"(CASE WHEN r.big_n > 0 THEN CAST(floor({u} * r.big_n) AS BIGINT) + 1 END)"
    return f"""WITH pool AS (SELECT id AS pk, CAST(created_at AS DATE) AS pday,
                     row_number() OVER (ORDER BY CAST(created_at AS DATE), {draw_uniform_sql(S, 'sub', 'id')}, id) AS pos FROM {USERS_STANDIN_SQL}),
  rr AS (SELECT *, CAST({row_date} AS DATE) + {lead} AS lim FROM {rows_sql}),
  r AS (SELECT rr.*, (SELECT count(*) FROM pool WHERE pool.pday <= rr.lim) AS big_n FROM rr),
  w AS (SELECT r.*, {want} AS want FROM r)
SELECT w.* EXCLUDE (want, lim, big_n), pool.pk AS picked FROM w LEFT JOIN pool ON pool.pos = w.want"""


@register("pick_eligible", _pick_sql("(SELECT o_orderkey AS id, o_orderdate AS d FROM orders)", "id", "d", 0, "author", None))
def q_pick_eligible(spark, sf):
    rows = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("d"))
    pool = users_standin(spark, sf)
    return E.pick_eligible(rows, "id", "d", pool, "id", "created_at", S, "author")


_P_SQL = f"""(CASE WHEN created_at < TIMESTAMP '{ORDERS_PRE_END}' THEN 0.02
  WHEN created_at < TIMESTAMP '{ORDERS_PEAK_END}' THEN 0.20
  ELSE 0.05 * exp(-0.01 * date_diff('day', TIMESTAMP '{ORDERS_PEAK_END}', created_at)) END)"""
_FOLLOWERS_SQL = (f"(SELECT id, created_at FROM {USERS_STANDIN_SQL} "
                  f"WHERE {draw_uniform_sql(S, 'follow_p', 'id')} < {_P_SQL})")


@register("activated_follows", f"""
SELECT following_user_id, followed_user_id, created_at FROM (
  SELECT id AS following_user_id, picked AS followed_user_id,
         CAST(CAST(created_at AS DATE) + CAST({draw_int_sql(draw_uniform_sql(S, 'follow_day', 'id'), 0, 20)} AS INTEGER) AS TIMESTAMP) AS created_at
  FROM ({_pick_sql(_FOLLOWERS_SQL, 'id', 'created_at', 10, 'followee', 'id')}))
WHERE followed_user_id IS NOT NULL AND followed_user_id <> following_user_id""")
def q_activated_follows(spark, sf):
    return activated_follows(users_standin(spark, sf), ORDERS_PRE_END, ORDERS_PEAK_END, GrowthParams(seed=S))


@register("fk_orphans", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT s_suppkey FROM supplier)""")
def q_fk_orphans(spark, sf):
    """E6 / J2 with hits: part keys looked up among supplier keys, most of which don't exist there."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return check_foreign_key(li, "l_partkey", read_table(spark, sf, "supplier"), "s_suppkey")


@register("active_users", f"""
SELECT id, created_at FROM {USERS_STANDIN_SQL} u WHERE EXISTS (SELECT 1 FROM events e WHERE e.user_id = u.id
  AND e.ts >= TIMESTAMP '{EVENTS_PEAK_START}' AND e.ts < TIMESTAMP '{EVENTS_PEAK_END}')""")
def q_active_users(spark, sf):
    ev = read_table(spark, sf, "events")
    cond = (F.col("ts") >= F.lit(EVENTS_PEAK_START).cast("timestamp_ntz")) & \
           (F.col("ts") < F.lit(EVENTS_PEAK_END).cast("timestamp_ntz"))
    return E.active_in(users_standin(spark, sf).select("id", "created_at"), "id", ev, "user_id", cond)


@register("inactive_users", """
SELECT c_custkey AS id FROM customer c WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)""")
def q_inactive_users(spark, sf):
    c = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    return E.inactive_in(c, "id", read_table(spark, sf, "events"), "user_id")


@register("lookup_author", """
SELECT o_orderkey AS id, c_name AS author, c_mktsegment AS role FROM orders JOIN customer ON c_custkey = o_custkey""")
def q_lookup_author(spark, sf):
    o = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    c = read_table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("author"),
                                                  F.col("c_mktsegment").alias("role"))
    return E.lookup(o, "o_custkey", c, "c_custkey", ["author", "role"]).select("id", "author", "role")


@register("reversed_edges", """
SELECT DISTINCT l_suppkey AS a, l_partkey AS b FROM lineitem x
WHERE EXISTS (SELECT 1 FROM lineitem y WHERE y.l_suppkey = x.l_partkey AND y.l_partkey = x.l_suppkey)""")
def q_reversed_edges(spark, sf):
    e = read_table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b"))
    return E.reversed_edges(e, "a", "b")


_N = count_sql("customer")
_UE = f"""ue AS (SELECT a, b, min(cid) AS cid FROM (
   SELECT o_orderkey AS cid, o_custkey AS a, {power_law_id_sql(draw_uniform_sql(S, 'edges', 'o_orderkey'), _N, POWER_LAW_80_20, 0)} AS b FROM orders)
 WHERE a <> b GROUP BY a, b ORDER BY cid LIMIT {_N})"""


def _edges(spark, sf):
    """The first n distinct pairs (n: customers) of each order's customer with a popular one."""
    n = read_table(spark, sf, "customer").count()
    cands = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("cid"), F.col("o_custkey").alias("a"),
        power_law_id(draw_uniform(S, "edges", "o_orderkey"), n, POWER_LAW_80_20, 0).alias("b"))
    return unique_edges(cands, n)


@register("unique_edges", f"WITH {_UE}\nSELECT a, b, cid FROM ue")
def q_unique_edges(spark, sf):
    return _edges(spark, sf)


@register("add_reciprocal", f"""WITH {_UE},
 one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY least(a, b), greatest(a, b) ORDER BY cid) AS r
         FROM ue) WHERE r = 1)
SELECT a, b, cid, cid * 2 AS ekey FROM one
UNION ALL SELECT b, a, cid, cid * 2 + 1 FROM one WHERE {draw_uniform_sql(S, 'reverse', 'cid')} < {0.3 / 1.7!r}""")
def q_add_reciprocal(spark, sf):
    return add_reciprocal(_edges(spark, sf), 0.3 / 1.7, S).select("a", "b", "cid", "ekey")


_NODES = """nodes AS (SELECT id, CAST(row_number() OVER (ORDER BY CAST(created_at AS DATE), {draw}, id) - 1 AS BIGINT) AS place FROM {users})"""
_PLACES = _NODES.format(draw=draw_uniform_sql(S, "sub", "id"), users=USERS_STANDIN_SQL)
_M = "(SELECT count(*) FROM nodes)"


def _places(spark, sf):
    """Users with their place 0..n-1, and n."""
    users = users_standin(spark, sf).select(F.col("id"), F.to_date("created_at").alias("day"))
    pos, groups = E.dense_positions(users, "day", "id", 1_000_000, S, "place")
    return stored(pos.select("id", (F.col("place") - 1).alias("place"))), groups.agg(F.coalesce(F.sum("g_rows"), F.lit(0))).first()[0]


@register("uniform_edges", f"""WITH RECURSIVE {_PLACES},
 src AS (SELECT CAST(row_number() OVER () - 1 AS BIGINT) AS eid, CAST(row_number() OVER () - 1 AS BIGINT) AS x FROM orders),
 {feistel_walk_sql('src', f'({_M} * ({_M} - 1))', S, 'pairs', "''")},
 p AS (SELECT eid, x // ({_M} - 1) AS a, x % ({_M} - 1) AS r FROM walk WHERE done),
 e AS (SELECT eid, a, CASE WHEN r >= a THEN r + 1 ELSE r END AS b FROM p)
SELECT eid, x.id AS a, y.id AS b FROM e JOIN nodes x ON x.place = e.a JOIN nodes y ON y.place = e.b""")
def q_uniform_edges(spark, sf):
    """L1: as many distinct pairs of users as there are orders, uniform, none drawn twice."""
    nodes, n = _places(spark, sf)
    e = uniform_edges(spark, read_table(spark, sf, "orders").count(), n, S)
    for end in ("a", "b"):
        e = e.withColumnRenamed(end, "place").join(nodes.withColumnRenamed("id", end), "place").drop("place")
    return e.select("eid", "a", "b")


@register("degree_edges", f"""WITH RECURSIVE {_PLACES},
 deg AS (SELECT nodes.id, place, least(count(*), {_M} - 1) AS d FROM orders JOIN nodes ON nodes.id = o_custkey GROUP BY 1, 2),
 src AS (SELECT id, place, k, k AS x FROM (SELECT id, place, unnest(range(0, d)) AS k FROM deg)),
 {feistel_walk_sql('src', f'({_M} - 1)', S, 'out', 'place')},
 e AS (SELECT id, k, CASE WHEN x >= place THEN x + 1 ELSE x END AS b FROM walk WHERE done)
SELECT e.id AS a, k, y.id AS b FROM e JOIN nodes y ON y.place = e.b""")
def q_degree_edges(spark, sf):
    """L1 with skew from the data: every user points at as many different users as they have orders."""
    nodes, n = _places(spark, sf)
    deg = read_table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).alias("d"))
    e = degree_edges(nodes.join(deg, "id"), "id", "place", "d", n, S)
    target = nodes.select(F.col("place").alias("b"), F.col("id").alias("__b"))
    return e.join(target, "b").select(F.col("id").alias("a"), "k", F.col("__b").alias("b"))
