"""Queries over tables built from given rows (`plans/enrich.py`), reports K3-K5, K10-K11, checks J1-J4.

users are the customers with an order (joined at the first one), posts are the orders, follows are
activated by orders. Each query builds only what it reads.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from spikeloom.operators import checks as J
from spikeloom.operators import growth as K
from spikeloom.operators.joins import edge_pairs, inactive_in
from spikeloom.operators.timeline import row_source, with_prefix
from spikeloom.params import Timeline
from spikeloom.plans.enrich import (
    Story, build_follows, build_follows_sql, build_posts, build_posts_sql, build_users, build_users_sql)
from spikeloom.plans.registry import register
from spikeloom.functions.text import TEXT_CTE_SQL
from spikeloom.session import checkpoint_dir, stored
from spikeloom.sources.tables import USERS_STANDIN_SQL, read_table, register_views, users_standin, write_parquet

STORY = Story(peak_start=date(1996, 1, 1), peak_end=date(1996, 3, 1))
TL = Timeline(viral_start=STORY.peak_start, peak_days=(STORY.peak_end - STORY.peak_start).days)
LO, HI = str(STORY.peak_start), str(STORY.peak_end)
_ROWS = "(SELECT o_orderkey AS id, o_custkey AS user_id, o_orderdate AS created_at FROM orders)"
_USERS = f"users AS {build_users_sql(f'(SELECT id, created_at FROM {USERS_STANDIN_SQL})', STORY)}"
_POSTS = f"{TEXT_CTE_SQL}, posts AS {build_posts_sql(_ROWS, STORY)}"
_FOLLOWS = ", ".join(build_follows_sql(_ROWS, USERS_STANDIN_SQL, STORY))
ALL = f"WITH {_USERS}, posts AS {_ROWS}, {_FOLLOWS}"


def rows_of(spark, sf):
    return read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("created_at"))


def people(spark, sf):
    return users_standin(spark, sf).select("id", "created_at")


def follows_of(spark, sf):
    return build_follows(rows_of(spark, sf), people(spark, sf), STORY)


def follows_stored(spark, sf):
    """The follows as a written table: reports that use them several times read files, not the plan that built them."""
    return stored(follows_of(spark, sf))


@register("timeline_plan", f"""
WITH u AS (SELECT CAST(created_at AS DATE) AS d, count(*) AS n_users FROM {USERS_STANDIN_SQL} GROUP BY 1),
 p AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n_posts FROM orders GROUP BY 1),
 days AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT d FROM u UNION ALL SELECT d FROM p)),
 x AS (SELECT CAST(d AS TIMESTAMP) AS day, coalesce(n_users, 0) AS n_users, coalesce(n_posts, 0) AS n_posts
       FROM days LEFT JOIN u USING (d) LEFT JOIN p USING (d))
SELECT day, {STORY.period_sql('day')} AS period, n_users, n_posts,
       CAST(sum(n_users) OVER w - n_users AS BIGINT) AS u_start, CAST(sum(n_posts) OVER w - n_posts AS BIGINT) AS p_start FROM x
WINDOW w AS (ORDER BY day)""")
def q_timeline_plan(spark, sf):
    u = K.daily_counts(people(spark, sf), "created_at", "n_users")
    p = K.daily_counts(rows_of(spark, sf), "created_at", "n_posts")
    d = K.day_spine(u.join(p, "day", "full_outer").fillna(0, ["n_users", "n_posts"]), "day", ["n_users", "n_posts"])
    d = with_prefix(with_prefix(d, "n_users", "day", "u_start"), "n_posts", "day", "p_start")
    return d.select("day", STORY.period("day").alias("period"), "n_users", "n_posts", "u_start", "p_start")


@register("build_users", f"WITH {_USERS}\nSELECT * FROM users")
def q_build_users(spark, sf):
    return build_users(people(spark, sf), STORY)


@register("users_written_and_read", f"""WITH {_USERS}
SELECT id, role, created_at, strftime(created_at, '%Y-%m') AS month FROM users""")
def q_users_written_and_read(spark, sf):
    """Users as parquet by month in the shared folder, read back through a view."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/users-{uuid.uuid4().hex}"
    users = build_users(people(spark, sf), STORY)
    write_parquet(users.withColumn("month", F.date_format("created_at", "yyyy-MM")), path, partition_by=["month"])
    register_views(spark, {"written_users": spark.read.parquet(path)})
    return spark.sql("SELECT id, role, created_at, month FROM written_users")


@register("build_posts", f"WITH {_POSTS}\nSELECT * FROM posts")
def q_build_posts(spark, sf):
    return build_posts(rows_of(spark, sf), STORY)


@register("build_follows", f"{ALL}\nSELECT * FROM follows")
def q_build_follows(spark, sf):
    return follows_of(spark, sf)


def _between(lo, hi):
    return " AND ".join(c for c in (f"created_at >= TIMESTAMP '{lo}'" if lo else "",
                                    f"created_at < TIMESTAMP '{hi}'" if hi else "") if c)


def _mean_sql(lo, hi, name):
    return (f"SELECT '{name}' AS metric, round(avg(n), 6) AS value FROM (SELECT CAST(created_at AS DATE) AS d, "
            f"count(*) AS n FROM users WHERE {_between(lo, hi)} GROUP BY 1)")


@register("period_report", f"""{ALL}
{_mean_sql(None, LO, 'DAILY_REGISTRATIONS_PRE_VIRAL')}
UNION ALL {_mean_sql(LO, HI, 'DAILY_REGISTRATIONS_VIRAL_PEAK')}
UNION ALL {_mean_sql(HI, None, 'DAILY_REGISTRATIONS_POST_VIRAL')}
UNION ALL SELECT 'TOTAL_USERS', CAST(count(*) AS DOUBLE) FROM users
UNION ALL SELECT 'TOTAL_POSTS', CAST(count(*) AS DOUBLE) FROM posts
UNION ALL SELECT 'TOTAL_FOLLOWS', CAST(count(*) AS DOUBLE) FROM follows
UNION ALL SELECT 'POSTS_PER_USER_RATIO', round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM users), 6) FROM posts""")
def q_period_report(spark, sf):
    return K.period_report(people(spark, sf), rows_of(spark, sf), follows_stored(spark, sf), TL)


def _samples_sql(label, lo, hi):
    return (f"SELECT * FROM (SELECT '{label}' AS period, strftime(CAST(created_at AS DATE), '%Y-%m-%d') AS date, "
            f"count(*) AS n_rows FROM users WHERE {_between(lo, hi)} GROUP BY 2 ORDER BY 2 LIMIT 5)")


@register("period_samples", f"""WITH {_USERS}
{_samples_sql('PRE_VIRAL_SAMPLE', None, LO)}
UNION ALL {_samples_sql('VIRAL_PEAK_SAMPLE', LO, HI)}
UNION ALL {_samples_sql('POST_VIRAL_SAMPLE', HI, None)}""")
def q_period_samples(spark, sf):
    return K.period_samples(people(spark, sf), "created_at", LO, HI, 5)


@register("spike_ratio", f"""{ALL},
 daily AS (SELECT 'users' AS table_name, CAST(created_at AS DATE) AS d, count(*) AS n FROM users GROUP BY 2
   UNION ALL SELECT 'posts', CAST(created_at AS DATE), count(*) FROM posts GROUP BY 2
   UNION ALL SELECT 'follows', CAST(created_at AS DATE), count(*) FROM follows GROUP BY 2),
 days AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS TIMESTAMP) AS day FROM daily),
 spans AS (SELECT {STORY.period_sql('day')} AS period, count(*) AS days FROM days GROUP BY 1),
 rates AS (SELECT t.table_name, s.period, coalesce(sum(n), 0) / any_value(s.days) AS v
   FROM (SELECT DISTINCT table_name FROM daily) t CROSS JOIN spans s
   LEFT JOIN daily x ON x.table_name = t.table_name AND {STORY.period_sql('CAST(x.d AS TIMESTAMP)')} = s.period GROUP BY 1, 2)
SELECT table_name, round(max(v) FILTER (period = 'pre'), 6) AS pre_per_day, round(max(v) FILTER (period = 'peak'), 6) AS peak_per_day,
       round(max(v) FILTER (period = 'post'), 6) AS post_per_day,
       round(max(v) FILTER (period = 'peak') / nullif(max(v) FILTER (period = 'pre'), 0), 6) AS spike_ratio FROM rates GROUP BY 1""")
def q_spike_ratio(spark, sf):
    return K.spike_ratio({"users": people(spark, sf), "posts": rows_of(spark, sf), "follows": follows_of(spark, sf)},
                         "created_at", LO, HI)


@register("table_counts", f"""{ALL}
SELECT 'users' AS table_name, count(*) AS row_count FROM users
UNION ALL SELECT 'posts', count(*) FROM posts UNION ALL SELECT 'follows', count(*) FROM follows""")
def q_table_counts(spark, sf):
    return J.table_counts({"users": people(spark, sf), "posts": rows_of(spark, sf), "follows": follows_stored(spark, sf)})


@register("check_row_counts", f"""
SELECT table_name, row_count, expected, row_count = expected AS ok FROM (
  SELECT 'users' AS table_name, (SELECT count(*) FROM {USERS_STANDIN_SQL}) AS row_count,
         (SELECT count(DISTINCT o_custkey) FROM orders) AS expected
  UNION ALL SELECT 'line_keys', (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)),
         (SELECT count(*) FROM lineitem))""")
def q_check_row_counts(spark, sf):
    """Users against the distinct buyers of the orders (equal), distinct line keys against lines (not)."""
    lines = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    buyers = read_table(spark, sf, "orders").agg(F.countDistinct("o_custkey")).first()[0]
    return J.check_row_counts({"users": people(spark, sf), "line_keys": lines.distinct()},
                              {"users": buyers, "line_keys": lines.count()})


@register("built_keys_check", f"""{ALL}
SELECT 'users_pk' AS rule, count(*) AS violations FROM (SELECT id FROM users GROUP BY id HAVING count(*) > 1)
UNION ALL SELECT 'posts_pk', count(*) FROM (SELECT id FROM posts GROUP BY id HAVING count(*) > 1)
UNION ALL SELECT 'follows_pk', count(*) FROM (SELECT following_user_id, followed_user_id FROM follows
                                               GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL SELECT 'posts_fk', count(*) FROM posts WHERE user_id NOT IN (SELECT id FROM users)
UNION ALL SELECT 'follows_fk', count(*) FROM follows WHERE following_user_id NOT IN (SELECT id FROM users)
                                                        OR followed_user_id NOT IN (SELECT id FROM users)
UNION ALL SELECT 'follows_self', count(*) FROM follows WHERE following_user_id = followed_user_id
UNION ALL SELECT 'follow_before_user', count(*) FROM follows f JOIN users u ON u.id = f.followed_user_id
                                                 WHERE CAST(f.created_at AS DATE) < CAST(u.created_at AS DATE)""")
def q_built_keys_check(spark, sf):
    u, p, f = people(spark, sf), rows_of(spark, sf), follows_stored(spark, sf)

    def n(df, rule):
        return df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(rule).alias("rule"), "violations")

    ends = J.check_foreign_key(f, "following_user_id", u, "id").unionByName(
        J.check_foreign_key(f, "followed_user_id", u, "id")).distinct()
    early = f.join(u.select(F.col("id").alias("followed_user_id"), F.col("created_at").alias("__u")), "followed_user_id") \
        .where(F.to_date("created_at") < F.to_date("__u"))
    parts = [n(J.check_unique(u, ["id"]), "users_pk"), n(J.check_unique(p, ["id"]), "posts_pk"),
             n(J.check_unique(f, ["following_user_id", "followed_user_id"]), "follows_pk"),
             n(J.check_foreign_key(p, "user_id", u, "id"), "posts_fk"), n(ends, "follows_fk"),
             n(J.check_no_self(f, "following_user_id", "followed_user_id"), "follows_self"),
             n(early, "follow_before_user")]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@register("influence_share", f"""{ALL},
 deg AS (SELECT followed_user_id, count(*) AS d FROM follows GROUP BY 1),
 k AS (SELECT count(*) AS nodes, CAST(ceil(0.2 * count(*)) AS BIGINT) AS top FROM users),
 best AS (SELECT d FROM deg ORDER BY d DESC LIMIT (SELECT top FROM k))
SELECT nodes, (SELECT count(*) FROM follows) AS edges, top AS top_nodes, (SELECT CAST(sum(d) AS BIGINT) FROM best) AS top_edges,
       round((SELECT sum(d) FROM best) / (SELECT count(*) FROM follows), 6) AS top_share FROM k""")
def q_influence_share(spark, sf):
    nodes = people(spark, sf).count()
    return K.influence_share(follows_of(spark, sf), "followed_user_id", 0.2, nodes)


@register("reciprocity", f"""{ALL},
 e AS (SELECT DISTINCT following_user_id AS a, followed_user_id AS b FROM follows WHERE following_user_id <> followed_user_id)
SELECT count(*) AS edges, (SELECT count(*) FROM e x JOIN e y ON x.a = y.b AND x.b = y.a) AS mutual_edges,
       round((SELECT count(*) FROM e x JOIN e y ON x.a = y.b AND x.b = y.a) / count(*), 6) AS mutual_share FROM e""")
def q_reciprocity(spark, sf):
    return K.reciprocity(follows_stored(spark, sf), "following_user_id", "followed_user_id")


@register("edge_pairs", """
SELECT least(l_suppkey, l_partkey) AS lo, greatest(l_suppkey, l_partkey) AS hi,
       bool_or(l_suppkey <= l_partkey) AS up, bool_or(l_suppkey >= l_partkey) AS down FROM lineitem
WHERE l_suppkey IS NOT NULL AND l_partkey IS NOT NULL GROUP BY 1, 2""")
def q_edge_pairs(spark, sf):
    return edge_pairs(read_table(spark, sf, "lineitem"), "l_suppkey", "l_partkey")


@register("row_source", """
SELECT id FROM (SELECT unnest(range(1, (SELECT max(o_orderkey) FROM orders) + 1)) AS id)
WHERE id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)""")
def q_row_source(spark, sf):
    """A1: the ids up to the largest order key that no line item refers to."""
    top = read_table(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0] or 0
    return inactive_in(row_source(spark, top), "id", read_table(spark, sf, "lineitem"), "l_orderkey")


def flagship(spark, sf):
    """The period report (K3) over users, posts and follows built from the rows of ``sf``."""
    return q_period_report(spark, sf)
