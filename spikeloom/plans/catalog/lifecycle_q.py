"""Queries over tables that are written and read back: buckets, versions, deletes, checked writes, stored
cohorts (A5-A11, E5-E7, J1-J6, K6), and churn in the data (K7). All write below the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from spikeloom.operators import checks as J
from spikeloom.operators import cohorts as C
from spikeloom.operators import growth as K
from spikeloom.functions.draws import draw_categorical_by_sql, draw_uniform_sql
from spikeloom.operators.lifetimes import cut_activity, spike_lifetimes, spike_lifetimes_sql
from spikeloom.operators.numbering import exact_shares, numbered, weighted_pick
from spikeloom.operators.segments import change_points
from spikeloom.params import ROLES_BY_PERIOD_E
from spikeloom.plans import sql_reports
from spikeloom.plans.catalog.build_q import ALL, HI, LO, STORY, TL, _ROWS, _USERS, build_users, follows_of, follows_stored, people, rows_of
from spikeloom.plans.catalog.growth_q import _cohort_sql
from spikeloom.plans.registry import ORACLES, register
from spikeloom.session import scratch_path, stored
from spikeloom.sources import bucketed as B
from spikeloom.sources import rewrite as R
from spikeloom.sources import versions as V
from spikeloom.sources.tables import USERS_SCHEMA, USERS_STANDIN_SQL, read_table, users_standin

BUCKETS = 16


def _name(what: str) -> str:
    return f"spikeloom_{what}_{uuid.uuid4().hex}"


def _bucketed(spark, df, what, key, sort=()):
    return B.write_bucketed(df, _name(what), scratch_path(spark, what), key, BUCKETS, sort)


_FOLDED = """posts AS (SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1, 2),
 acts AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2)"""


def bucketed_tables(spark, sf):
    """Users, posts and activity, the last two folded to one row per user and day, all bucketed by user."""
    users = users_standin(spark, sf).select(F.col("id").alias("user_id"), "username", "role")
    posts = B.fold_activity(read_table(spark, sf, "orders"), "o_custkey", "o_orderdate")
    acts = B.fold_activity(read_table(spark, sf, "events"), "user_id", "ts")
    return (_bucketed(spark, users, "users", "user_id"), _bucketed(spark, posts, "posts", "user_id", ["day"]),
            _bucketed(spark, acts, "acts", "user_id", ["day"]))


@register("bucketed_join", f"""WITH {_FOLDED},
 p AS (SELECT user_id, CAST(sum(n) AS BIGINT) AS n_posts, count(*) AS post_days FROM posts GROUP BY 1),
 a AS (SELECT user_id, CAST(sum(n) AS BIGINT) AS n_events, count(*) AS event_days FROM acts GROUP BY 1)
SELECT u.id AS user_id, role, n_posts, post_days, coalesce(n_events, 0) AS n_events, coalesce(event_days, 0) AS event_days FROM {USERS_STANDIN_SQL} u JOIN p ON p.user_id = u.id LEFT JOIN a ON a.user_id = u.id""")
def q_bucketed_join(spark, sf):
    """E5: activity of each user from two bucketed tables, joined and summed without a shuffle."""
    users, posts, acts = bucketed_tables(spark, sf)
    p = posts.groupBy("user_id").agg(F.sum("n").alias("n_posts"), F.count(F.lit(1)).alias("post_days"))
    a = acts.groupBy("user_id").agg(F.sum("n").alias("n_events"), F.count(F.lit(1)).alias("event_days"))
    return B.co_located(B.co_located(users.drop("username"), p, "user_id"), a, "user_id", "left").fillna(0, ["n_events", "event_days"])


@register("bucketed_semi_anti", f"""WITH {_FOLDED}
SELECT id AS user_id, username, id IN (SELECT user_id FROM acts) AS active FROM {USERS_STANDIN_SQL} u""")
def q_bucketed_semi_anti(spark, sf):
    """Users with and without activity, by semi and anti join of matching buckets."""
    users, _, acts = bucketed_tables(spark, sf)
    users = users.select("user_id", "username")
    active = B.co_located(users, acts, "user_id", "left_semi").withColumn("active", F.lit(True))
    return active.unionByName(B.co_located(users, acts, "user_id", "left_anti").withColumn("active", F.lit(False)))


_ENDS = spike_lifetimes_sql(USERS_STANDIN_SQL, LO, HI, STORY.growth)
_LEFT = f"""(SELECT o_orderkey AS id, o_custkey AS user_id, o_orderdate AS created_at FROM orders LEFT JOIN {_ENDS} e ON e.id = o_custkey
   WHERE e.ends_at IS NULL OR o_orderdate < e.ends_at)"""


def churned(spark, sf):
    ends = spike_lifetimes(people(spark, sf), "id", "created_at", LO, HI, STORY.growth)
    return cut_activity(rows_of(spark, sf), "user_id", "created_at", ends, "id")


@register("churned_activity", f"SELECT * FROM {_LEFT}")
def q_churned_activity(spark, sf):
    """K7: the posts that are left when a share of the spike users falls silent."""
    return churned(spark, sf)


@register("churn_in_data", f"""
WITH s AS (SELECT id, created_at FROM {USERS_STANDIN_SQL} WHERE created_at >= TIMESTAMP '{LO}' AND created_at < TIMESTAMP '{HI}'),
 late AS (SELECT DISTINCT s.id FROM s JOIN {_LEFT} o ON o.user_id = s.id WHERE o.created_at >= s.created_at + INTERVAL 30 DAY)
SELECT count(*) AS spike_users, count(*) - (SELECT count(*) FROM late) AS churned_users,
       round((count(*) - (SELECT count(*) FROM late)) / count(*), 6) AS churn_rate FROM s""")
def q_churn_in_data(spark, sf):
    """K7: the churn measured on that activity."""
    return K.churn_after_spike(people(spark, sf), "id", "created_at", churned(spark, sf), "user_id", "created_at", LO, HI, STORY.growth.churn_days)


@register("cohort_bitmaps", _cohort_sql("month", "(year(o.o_orderdate) - year(u.cohort)) * 12 + month(o.o_orderdate) - month(u.cohort)"))
def q_cohort_bitmaps(spark, sf):
    """K6: retention from bitmaps stored by year of activity, the last two years added by a later run."""
    users, acts = users_standin(spark, sf), read_table(spark, sf, "orders")
    path = scratch_path(spark, "cohorts")
    late = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    for part in (acts.where(~late), acts.where(late)):
        C.store_slices(C.activity_bitmaps(users, "id", "created_at", part, "o_custkey", "o_orderdate", slice_format="yyyy"), path)
    return C.retention(spark, path, C.cohort_sizes(users, "created_at"))


_FLAGS = ("A", "N", "R")
_MET = {"row_count": "count(*)", **{f"null:{c}": f"count(*) - count({c})" for c in ("l_orderkey", "l_partkey", "l_shipdate")},
        "rule:no_self": "count(*) FILTER (l_suppkey = l_partkey)", "rule:positive_price": "count(*) FILTER (l_extendedprice <= 0)",
        **{f"share:l_returnflag={v}": f"count(*) FILTER (l_returnflag = '{v}')" for v in _FLAGS}}


@register("checked_write", "\nUNION ALL ".join(f"SELECT '{k}' AS metric, CAST({v} AS BIGINT) AS value FROM lineitem" for k, v in _MET.items()) + """
UNION ALL SELECT 'duplicate_keys', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def q_checked_write(spark, sf):
    """J1, J3-J6 in the pass that writes the table; the self edges are those of `check_no_self`."""
    li = read_table(spark, sf, "lineitem")
    checked = J.CheckedWrite(li, ["l_orderkey", "l_partkey", "l_shipdate"],
                             {"no_self": F.col("l_suppkey") == F.col("l_partkey"), "positive_price": F.col("l_extendedprice") <= 0},
                             {"l_returnflag": _FLAGS})
    return checked.write(scratch_path(spark, "lines"), ["l_orderkey", "l_linenumber"])


@register("created_as_select", f"WITH {_USERS}\nSELECT * FROM users")
def q_created_as_select(spark, sf):
    """The users' table created as a query's result in a namespace, then replaced by the full result."""
    space = _name("social")
    V.create_namespace(spark, space, scratch_path(spark, "space"))
    users = build_users(people(spark, sf), STORY)
    V.create_as_select(users.where("role = 'influencer'"), f"{space}.users", scratch_path(spark, "users"))
    return V.create_as_select(users, f"{space}.users", scratch_path(spark, "users"), replace=True)


@register("declared_and_inserted", f"""WITH {_USERS}
SELECT id, username, role, created_at FROM users""")
def q_declared_and_inserted(spark, sf):
    """Declared columns, rows inserted by a cast to them; a repeated insert replaces, it does not double."""
    name = _name("declared")
    V.declare_table(spark, name, USERS_SCHEMA, scratch_path(spark, "declared"))
    users = build_users(people(spark, sf), STORY).withColumn("id", F.col("id").cast("string"))
    for _ in range(2):
        V.insert_select(users, name, USERS_SCHEMA, replace=True)
    return spark.table(name)


@register("published_version", f"SELECT id, user_id, created_at FROM {_ROWS} WHERE created_at < TIMESTAMP '{HI}'")
def q_published_version(spark, sf):
    """A5: two versions are published, a third is staged by a run that fails: readers see the second."""
    root, posts = scratch_path(spark, "versions"), rows_of(spark, sf)
    V.publish_version(posts.where(F.col("created_at") < F.lit(LO).cast("timestamp_ntz")), root, 1)
    V.publish_version(posts.where(F.col("created_at") < F.lit(HI).cast("timestamp_ntz")), root, 2)
    V.stage(posts, root, 3)
    return V.read_published(spark, root)


@register("deleted_on_stored", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders
WHERE NOT (o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-06-01' AND o_orderstatus = 'F')""")
def q_deleted_on_stored(spark, sf):
    """A11 on files: orders by year; a delete that hits one year rewrites that year only."""
    path = scratch_path(spark, "orders")
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", F.year("o_orderdate").alias("y"))
    R.write_partitioned(o, path, "y")
    day = F.col("o_orderdate")
    R.delete_where(spark, path, "y", (day >= F.lit("1997-03-01").cast("timestamp_ntz")) & (day < F.lit("1997-06-01").cast("timestamp_ntz"))
                   & (F.col("o_orderstatus") == "F"))
    return spark.read.parquet(path)


@register("numbered_rows", """
SELECT event_id, event_type, row_number() OVER (ORDER BY event_type, event_id) AS n,
       CAST(coalesce(sum(user_id) OVER (ORDER BY event_type, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM events""")
def q_numbered_rows(spark, sf):
    """G2, G3 over given rows in an order of few different values: a fifth of all rows is one key."""
    ev = read_table(spark, sf, "events").select("event_id", "event_type", "user_id")
    return numbered(ev, ["event_type", "event_id"], weight="user_id").drop("user_id")


_WEIGHTS = """w AS (SELECT user_id AS k, count(*) AS w FROM events GROUP BY 1),
 line AS (SELECT k, CAST(sum(w) OVER (ORDER BY k) - w AS BIGINT) AS lo, CAST(sum(w) OVER (ORDER BY k) AS BIGINT) AS hi FROM w)"""


@register("weighted_pick", f"""WITH {_WEIGHTS},
 r AS (SELECT o_orderkey AS id, CAST(floor({draw_uniform_sql(STORY.growth.seed, 'weighted', 'o_orderkey')} * CAST((SELECT sum(w) FROM w) AS DOUBLE)) AS BIGINT) AS pt FROM orders)
SELECT id, k AS picked FROM r JOIN line ON pt >= lo AND pt < hi""")
def q_weighted_pick(spark, sf):
    """Each order gets a user, drawn by how active users are in the events."""
    rows = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    weights = read_table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("w"))
    return weighted_pick(rows, "id", weights, "user_id", "w", STORY.growth.seed, "weighted")


@register("change_points", f"""{ALL},
 c AS (SELECT CAST(created_at AS DATE) AS d, count(*) AS n FROM follows GROUP BY 1),
 days AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM c),
 v AS (SELECT row_number() OVER (ORDER BY days.d) AS i, days.d, CAST(coalesce(n, 0) AS DOUBLE) AS n FROM days LEFT JOIN c USING (d)),
 p AS (SELECT [0.0::DOUBLE] || list(s1 ORDER BY i) AS s1, [0.0::DOUBLE] || list(s2 ORDER BY i) AS s2, max(i) AS len, 3.0 * 1000 * 1000 * ln(greatest(2, max(i))) AS pen
       FROM (SELECT i, sum(x) OVER (ORDER BY i) AS s1, sum(x * x) OVER (ORDER BY i) AS s2 FROM (SELECT i, floor(1000 * 2 * sqrt(n + 0.375) + 0.5) AS x FROM v))),
 f AS (SELECT 0 AS j, [0.0::DOUBLE] AS best, [0::BIGINT] AS last FROM p
   UNION ALL SELECT j + 1, list_append(best, least_cost + pen), list_append(last, list_position(costs, least_cost) - 1) FROM (
     SELECT *, list_min(costs) AS least_cost FROM (
       SELECT f.j, best, last, pen, list_transform(range(0, f.j + 1), lambda i: best[i + 1] + (s2[f.j + 2] - s2[i + 1] - (s1[f.j + 2] - s1[i + 1]) * (s1[f.j + 2] - s1[i + 1]) / (f.j + 1 - i))) AS costs
       FROM f, p WHERE f.j < p.len))),
 done AS (SELECT last FROM f WHERE j = (SELECT len FROM p)),
 back AS (SELECT last[-1] AS a, (SELECT len FROM p) AS e, last FROM done UNION ALL SELECT last[a + 1], a, last FROM back WHERE a > 0)
SELECT 'follows' AS table_name, CAST(min(d) AS TIMESTAMP) AS first_day, CAST(max(d) AS TIMESTAMP) AS last_day, count(*) AS days, round(avg(n), 6) AS mean
FROM back JOIN v ON v.i > back.a AND v.i <= back.e GROUP BY back.a""".replace("WITH ", "WITH RECURSIVE ", 1))
def q_change_points(spark, sf):
    """The levels of the follows per day; the burst shows as a segment of its own."""
    daily = K.daily_counts(follows_of(spark, sf), "created_at", "n").withColumn("table_name", F.lit("follows"))
    return change_points(stored(daily), "day", "n", "table_name")


@register("period_report_in_sql", ORACLES["period_report"])
def q_period_report_in_sql(spark, sf):
    """The period report as SQL with named parameters."""
    return sql_reports.period_report(people(spark, sf), rows_of(spark, sf), follows_stored(spark, sf), TL)


@register("shares_in_sql", """
SELECT o_orderpriority AS value, count(*) AS n_rows, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS percentage FROM orders GROUP BY 1 HAVING count(*) >= 5""")
def q_shares_in_sql(spark, sf):
    """Shares as SQL with a parameter."""
    return sql_reports.shares(read_table(spark, sf, "orders"), "o_orderpriority", 5)


_PLACE = f"(row_number() OVER (PARTITION BY period ORDER BY {draw_uniform_sql(STORY.growth.seed, 'sub', 'id')}, id) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY period)"


@register("exact_shares", f"""
SELECT id, period, {draw_categorical_by_sql('place', 'period', ROLES_BY_PERIOD_E)} AS value FROM (
  SELECT id, period, {_PLACE} AS place FROM (SELECT id, {STORY.period_sql('created_at')} AS period FROM {USERS_STANDIN_SQL}))""")
def q_exact_shares(spark, sf):
    """Roles whose shares in every period are exact, not drawn."""
    users = people(spark, sf).select("id", STORY.period("created_at").alias("period"))
    return exact_shares(users, "id", "period", ROLES_BY_PERIOD_E, STORY.growth.seed)
