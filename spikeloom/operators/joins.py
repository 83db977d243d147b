"""Joins (E2-E8): binned range join, eligible-partner pick, lookups, semi/anti joins.

No theta join touches a big table: range conditions are turned into equi-joins on bins, and
"a random member of an eligible prefix" into an equi-join on a drawn position.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spikeloom.functions.draws import draw_uniform


def range_join_days(left: DataFrame, left_ts: str, right: DataFrame, right_ts: str,
                    lo_days: int, hi_days: int, on: Sequence[str] = ()) -> DataFrame:
    """Pairs with ``lo <= days(right) - days(left) <= hi`` and equal ``on`` columns, as an
    equi-join on those and a day bin.

    Bins are ``hi - lo + 1`` days wide, so a left row meets right rows only in its own shifted
    bin or the next one: the left side is doubled, never multiplied by the band width. Without
    ``on`` the output is every pair of the band; give the key that both sides share.
    """
    width = hi_days - lo_days + 1
    lday = F.datediff(F.to_date(F.col(left_ts)), F.lit("1970-01-01").cast("date")) + F.lit(lo_days)
    rday = F.datediff(F.to_date(F.col(right_ts)), F.lit("1970-01-01").cast("date"))
    l = (left.withColumn("__lday", lday)
         .withColumn("__bin", F.explode(F.array(F.floor(F.col("__lday") / width),
                                                F.floor(F.col("__lday") / width) + 1))))
    r = right.withColumn("__rday", rday).withColumn("__bin", F.floor(F.col("__rday") / width))
    j = l.join(r, [*on, "__bin"])
    gap = F.col("__rday") - F.col("__lday")
    return j.where((gap >= 0) & (gap <= F.lit(hi_days - lo_days))).drop("__bin", "__lday", "__rday")


def dense_positions(pool: DataFrame, group: str, key: str, chunk_rows: int, seed: int,
                    out: str = "pos") -> tuple[DataFrame, DataFrame]:
    """Positions 1..N over ``pool`` in the order (group, seeded draw on the key, key).

    Each group is cut into ceil(n / chunk_rows) ranges of the draw, so the numbering window never
    holds more than about ``chunk_rows`` rows even when one group holds a third of the pool. The
    order doesn't depend on the cut: any ``chunk_rows`` gives the same positions. Returns
    (positions, per-group table with ``g_start``, ``g_rows``).
    """
    groups = pool.groupBy(group).agg(F.count(F.lit(1)).alias("g_rows"))
    gw = Window.partitionBy(F.lit(0)).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    # one row per group (a day): the only window over all of them
    groups = groups.withColumn("g_start", F.coalesce(F.sum("g_rows").over(gw), F.lit(0)).cast("bigint"))
    p = pool.join(groups.select(group, "g_rows"), group).withColumn("__u", draw_uniform(seed, "sub", key))
    p = p.withColumn("__sub", F.floor(F.col("__u") * F.ceil(F.col("g_rows") / F.lit(chunk_rows))).cast("bigint")).drop("g_rows")
    subs = p.groupBy(group, "__sub").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(group).orderBy("__sub").rowsBetween(Window.unboundedPreceding, -1)
    subs = subs.withColumn("__start", F.coalesce(F.sum("__n").over(w), F.lit(0))).join(groups.select(group, "g_start"), group)
    p = p.join(subs.select(group, "__sub", (F.col("__start") + F.col("g_start")).alias("__start")), [group, "__sub"])
    rn = F.row_number().over(Window.partitionBy(group, "__sub").orderBy("__u", key))
    return p.withColumn(out, (F.col("__start") + rn).cast("bigint")).drop("__sub", "__start", "__u"), groups


def joined_through(groups: DataFrame, group: str, days: DataFrame, day: str, out: str, total: str | None = None) -> DataFrame:
    """For each distinct ``day`` of ``days`` the rows of ``groups`` (day, g_rows) up to it: both day
    lists in one running sum, instead of a join on <=. One row per day on either side. ``total``: also
    the rows of all days, so that who needs both joins once and no subquery is repeated."""
    own = days.select(F.col(day).alias("__d"), F.lit(0).cast("bigint").alias("__n"), F.lit(1).alias("__own"))
    both = own.unionByName(groups.select(F.col(group).alias("__d"), F.col("g_rows").alias("__n"), F.lit(0).alias("__own")))
    both = both.groupBy("__d").agg(F.sum("__n").alias("__n"), F.max("__own").alias("__own"))
    w = Window.partitionBy(F.lit(0)).orderBy("__d").rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.sum("__n").over(w).alias(out)]
    if total:
        sums.append(F.sum("__n").over(Window.partitionBy(F.lit(0))).alias(total))
    return both.select("__d", "__own", *sums).where("__own = 1").drop("__own").withColumnRenamed("__d", day)


def take_position(rows: DataFrame, want: str, spread_by: str, positions: DataFrame, pos: str, key: str, out: str) -> DataFrame:
    """The key at position ``want`` (null: none). Rows without one get negative stand-ins spread by a
    hash, so they don't meet in one task."""
    nowhere = -F.pmod(F.xxhash64(spread_by), F.lit(1 << 20)) - 1
    target = positions.select(F.col(pos).alias("__at"), F.col(key).alias(out))
    return rows.withColumn("__at", F.coalesce(F.col(want), nowhere)).join(target, "__at", "left").drop("__at", want)


def pick_eligible(rows: DataFrame, row_key: str, row_date: str, pool: DataFrame, pool_key: str,
                  pool_date: str, seed: int, tag: str, lead_days: int = 0,
                  self_key: str | None = None, chunk_rows: int = 1_000_000,
                  out: str = "picked") -> DataFrame:
    """For each row one uniformly drawn pool member with ``pool_date <= row_date + lead``
    (days), other than ``self_key`` when given. Rows with no candidate or a null date get null.

    Recipe: pool positions ordered by date (`dense_positions`); per distinct row date the count
    of eligible members N (`joined_through`); ``pos = floor(u * N) + 1``, stepping over the row's
    own position when it is inside the prefix; equi-join on ``pos``.
    """
    pool_d = pool.select(F.col(pool_key).alias("__pk"), F.to_date(F.col(pool_date)).alias("__pday")).where("__pday IS NOT NULL")
    pos, groups = dense_positions(pool_d, "__pday", "__pk", chunk_rows, seed, "__pos")
    r = rows.withColumn("__lim", F.date_add(F.to_date(F.col(row_date)), lead_days))
    lims = r.select("__lim").where("__lim IS NOT NULL").distinct()
    r = r.join(joined_through(groups, "__pday", lims, "__lim", "__N"), "__lim", "left")
    u = draw_uniform(seed, tag, row_key)
    if self_key is not None:
        own = pos.select(F.col("__pk").alias("__self"), F.col("__pos").alias("__own"))
        r = r.join(own, F.col(self_key) == F.col("__self"), "left").drop("__self")
        inside = F.col("__own").isNotNull() & (F.col("__own") <= F.col("__N"))
        m = F.when(inside, F.col("__N") - 1).otherwise(F.col("__N"))
        raw = F.floor(u * m).cast("bigint") + F.lit(1)
        pick = F.when(inside & (raw >= F.col("__own")), raw + 1).otherwise(raw)
        r = r.withColumn("__want", F.when(m > 0, pick)).drop("__own")
    else:
        r = r.withColumn("__want", F.when(F.col("__N") > 0, F.floor(u * F.col("__N")).cast("bigint") + 1))
    return take_position(r, "__want", row_key, pos, "__pos", "__pk", out).drop("__lim", "__N")


def lookup(child: DataFrame, fk: str, parent: DataFrame, pk: str, cols: list[str]) -> DataFrame:
    """E5: parent columns for each child row (inner join). Spark broadcasts the parent when it
    measures it small enough; otherwise both sides shuffle."""
    p = parent.select(F.col(pk).alias("__pk"), *cols)
    return child.join(p, F.col(fk) == F.col("__pk")).drop("__pk")


def active_in(users: DataFrame, key: str, activity: DataFrame, act_key: str,
              cond: Column | None = None) -> DataFrame:
    """Users with at least one activity row (left semi join), optionally filtered."""
    a = activity if cond is None else activity.where(cond)
    return users.join(a.select(F.col(act_key).alias("__ak")), F.col(key) == F.col("__ak"), "left_semi")


def inactive_in(users: DataFrame, key: str, activity: DataFrame, act_key: str,
                cond: Column | None = None) -> DataFrame:
    """Users without activity (left anti join)."""
    a = activity if cond is None else activity.where(cond)
    return users.join(a.select(F.col(act_key).alias("__ak")), F.col(key) == F.col("__ak"), "left_anti")


def edge_pairs(edges: DataFrame, a: str, b: str) -> DataFrame:
    """One row per unordered pair: lo, hi and whether lo->hi and hi->lo are present. A single
    aggregate answers every question about reversed edges."""
    lo, hi = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    return edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(lo.alias("lo"), hi.alias("hi")).agg(
        F.max(F.col(a) <= F.col(b)).alias("up"), F.max(F.col(a) >= F.col(b)).alias("down"))


def reversed_edges(edges: DataFrame, a: str, b: str) -> DataFrame:
    """The distinct edges whose reverse is also present (a self edge is its own reverse)."""
    both = edge_pairs(edges, a, b).where("up AND down")
    ways = F.when(F.col("lo") == F.col("hi"), F.array(F.struct(F.col("lo").alias(a), F.col("hi").alias(b)))).otherwise(
        F.array(F.struct(F.col("lo").alias(a), F.col("hi").alias(b)), F.struct(F.col("hi").alias(a), F.col("lo").alias(b))))
    return both.select(F.inline(ways))
