"""Builders over given rows: users, posts and follows of a viral-growth story from real keys and dates.

Nothing is generated from counts: a user is a given (id, join time), a post a given (id, author, time),
a follow starts from a given activity row. The builders add what the story needs.

  users    username, and a role drawn with the weights of the join period
  posts    title, body, and a status drawn with the weights of the post period
  follows  an activity row activates a follow with its period's probability, at its own time (so the
           burst follows the activity and no date leaves the window); the followed user is drawn by
           an 80/20 power law over a seeded permutation of the users, among those joined by that day;
           a pair keeps its first follow, and a share of one-way pairs is reversed

Shuffles: the numbering of users, the day and position lookups, one aggregate over pairs.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikeloom.functions import draws as D
from spikeloom.functions import text as X
from spikeloom.operators.edges import add_reciprocal
from spikeloom.operators.joins import dense_positions, joined_through, take_position
from spikeloom.params import PERIODS, ROLES_BY_PERIOD_E, GrowthParams
from spikeloom.session import spread
from spikeloom.sources.tables import FOLLOWS_SCHEMA, POSTS_SCHEMA, USERS_SCHEMA, conform

STEP = 1_000_003        # a prime: rank * STEP mod n runs over all users
TRIES = 3               # popular picks before one among the joined users


@dataclass(frozen=True)
class Story:
    peak_start: date
    peak_end: date
    growth: GrowthParams = field(default_factory=GrowthParams)

    def period(self, ts: str) -> Column:
        t = F.col(ts)
        return (F.when(t < F.lit(str(self.peak_start)).cast("timestamp_ntz"), PERIODS[0])
                .when(t < F.lit(str(self.peak_end)).cast("timestamp_ntz"), PERIODS[1])
                .when(t.isNotNull(), PERIODS[2]))

    def period_sql(self, ts: str) -> str:
        return (f"(CASE WHEN {ts} < TIMESTAMP '{self.peak_start}' THEN 'pre' "
                f"WHEN {ts} < TIMESTAMP '{self.peak_end}' THEN 'peak' WHEN {ts} IS NOT NULL THEN 'post' END)")

    def follow_p(self, ts: str) -> Column:
        p, per = self.growth, self.period(ts)
        after = F.datediff(F.to_date(ts), F.lit(str(self.peak_end)).cast("date"))
        return (F.when(per == "pre", F.lit(p.follow_p_pre)).when(per == "peak", F.lit(p.follow_p_peak))
                .when(per == "post", F.lit(p.follow_p_post) * F.exp(F.lit(-p.follow_decay) * after)))

    def follow_p_sql(self, ts: str) -> str:
        p, per = self.growth, self.period_sql(ts)
        return (f"(CASE {per} WHEN 'pre' THEN {p.follow_p_pre!r} WHEN 'peak' THEN {p.follow_p_peak!r} WHEN 'post' THEN "
                f"{p.follow_p_post!r} * exp({-p.follow_decay!r} * date_diff('day', TIMESTAMP '{self.peak_end}', {ts})) END)")


def build_users(people: DataFrame, s: Story) -> DataFrame:
    """users from (id, created_at)."""
    seed = s.growth.seed
    role = D.draw_categorical_by(D.draw_uniform(seed, "role", "id"), s.period("created_at"), ROLES_BY_PERIOD_E)
    return conform(people.select("id", X.make_username(seed, "id").alias("username"), role.alias("role"), "created_at"),
                   USERS_SCHEMA)


def build_users_sql(people: str, s: Story) -> str:
    seed = s.growth.seed
    role = D.draw_categorical_by_sql(D.draw_uniform_sql(seed, "role", "id"), s.period_sql("created_at"), ROLES_BY_PERIOD_E)
    return f"(SELECT id, {X.make_username_sql(seed, 'id')} AS username, {role} AS role, created_at FROM {people})"


def build_posts(rows: DataFrame, s: Story) -> DataFrame:
    """posts from (id, user_id, created_at)."""
    seed = s.growth.seed
    status = D.draw_categorical_by(D.draw_uniform(seed, "status", "id"), s.period("created_at"), s.growth.statuses_by_period)
    out = X.add_body(X.add_title(spread(rows).withColumn("status", status), seed, "id"), seed, "id")
    return conform(out, POSTS_SCHEMA)


def build_posts_sql(rows: str, s: Story) -> str:
    seed = s.growth.seed
    status = D.draw_categorical_by_sql(D.draw_uniform_sql(seed, "status", "id"), s.period_sql("created_at"), s.growth.statuses_by_period)
    return (f"(SELECT id, {X.make_title_sql(seed, 'id')} AS title, {X.make_body_sql(seed, 'id')} AS body, user_id, "
            f"{status} AS status, created_at FROM {rows} {X.TEXT_JOIN_SQL})")


def build_follows(activity: DataFrame, users: DataFrame, s: Story, chunk_rows: int = 1_000_000) -> DataFrame:
    """follows from activity (id, user_id, created_at) and users (id, created_at)."""
    p = s.growth
    pool = users.select(F.col("id").alias("__pk"), F.to_date("created_at").alias("__day")).where("__day IS NOT NULL")
    pos, groups = dense_positions(pool, "__day", "__pk", chunk_rows, p.seed, "__pos")
    n = F.col("__all")
    rows = activity.where(D.draw_uniform(p.seed, "follow_p", "id") < s.follow_p("created_at"))
    rows = rows.select("id", "user_id", "created_at", F.to_date("created_at").alias("__lim"),
                       D.digest(p.seed, "popular", "id").alias("__d0"), D.digest(p.seed, "popular2", "id").alias("__d1"))
    rows = rows.join(joined_through(groups, "__day", rows.select("__lim").distinct(), "__lim", "__N", "__all"), "__lim")
    us = [D.slice_uniform(F.col(f"__d{i // 2}"), i % 2) for i in range(TRIES + 1)]
    want = F.lit(None).cast("bigint")
    for u in us[:TRIES]:
        rank = F.least(F.floor(F.pow(u, F.lit(p.followed_k)) * n), n - 1).cast("bigint")
        popular = F.pmod(rank * F.lit(STEP), n) + 1
        want = F.coalesce(want, F.when(popular <= F.col("__N"), popular))
    any_joined = F.when(F.col("__N") > 0, F.floor(us[TRIES] * F.col("__N")).cast("bigint") + 1)
    rows = rows.withColumn("__want", F.coalesce(want, any_joined))
    rows = take_position(rows, "__want", "id", pos, "__pos", "__pk", "b")
    first = rows.where("b <> user_id").groupBy(F.col("user_id").alias("a"), "b").agg(
        F.min(F.struct("created_at", "id")).alias("f")).select("a", "b", F.col("f.id").alias("cid"), F.col("f.created_at").alias("created_at"))
    both = add_reciprocal(first, p.reverse_fraction(), p.seed)
    return conform(both.select(F.col("a").alias("following_user_id"), F.col("b").alias("followed_user_id"), "created_at"), FOLLOWS_SCHEMA)


def build_follows_sql(activity: str, users: str, s: Story) -> list[str]:
    """DuckDB twin as WITH-list items; the last is named follows."""
    p, seed = s.growth, s.growth.seed
    d = [D.digest_sql(seed, t, "id") for t in ("popular", "popular2")]
    us = [D.slice_uniform_sql(d[i // 2], i % 2) for i in range(TRIES + 1)]
    n = "(SELECT count(*) FROM f_pool)"
    ranks = [f"((CAST(least(floor(pow({u}, {p.followed_k!r}) * {n}), {n} - 1) AS BIGINT) * {STEP}) % {n} + 1)" for u in us[:TRIES]]
    picks = ", ".join(f"CASE WHEN {r} <= big_n THEN {r} END" for r in ranks)
    return [
        f"""f_pool AS (SELECT id AS pk, row_number() OVER (ORDER BY CAST(created_at AS DATE), {D.draw_uniform_sql(seed, 'sub', 'id')}, id) AS pos,
             CAST(created_at AS DATE) AS pday FROM {users})""",
        f"""f_rows AS (SELECT id, user_id, created_at, (SELECT count(*) FROM f_pool WHERE pday <= CAST(r.created_at AS DATE)) AS big_n
             FROM {activity} r WHERE {D.draw_uniform_sql(seed, 'follow_p', 'id')} < {s.follow_p_sql('created_at')})""",
        f"""f_want AS (SELECT id, user_id, created_at, coalesce({picks}, CASE WHEN big_n > 0 THEN CAST(floor({us[TRIES]} * big_n) AS BIGINT) + 1 END) AS want FROM f_rows)""",
        """f_first AS (SELECT a, b, arg_min(id, (created_at, id)) AS cid, min(created_at) AS created_at FROM (
             SELECT w.user_id AS a, f_pool.pk AS b, w.id, w.created_at FROM f_want w JOIN f_pool ON f_pool.pos = w.want WHERE f_pool.pk <> w.user_id) GROUP BY a, b)""",
        """f_one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY least(a, b), greatest(a, b) ORDER BY cid) AS r FROM f_first) WHERE r = 1)""",
        f"""follows AS (SELECT a AS following_user_id, b AS followed_user_id, created_at FROM f_one
             UNION ALL SELECT b, a, created_at FROM f_one WHERE {D.draw_uniform_sql(seed, 'reverse', 'cid')} < {p.reverse_fraction()!r})""",
    ]
