"""Numbering given rows by any key (G2, G3, D5), and drawing keys by real weights (C8, C11) on top of it.

No window ever holds all rows: rows are dealt into ranges of the order once, counts and sums per range
(one row per range) give the offsets, and only a range is numbered at a time. Rows of one key are
dealt apart too, by a hash of their own number, so a key with a third of all rows is many ranges.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spikeloom.functions.draws import draw_categorical_by, draw_uniform
from spikeloom.operators.joins import dense_positions
from spikeloom.operators.timeline import expand_counts
from spikeloom.session import stored


def numbered(df: DataFrame, order: Sequence[str], out: str = "n", weight: str | None = None, start: str = "start",
             parts: int | None = None) -> DataFrame:
    """Adds ``out``, the number 1..N of each row in ascending ``order`` (nulls first; rows equal in it in some fixed order), and
    with ``weight`` also ``start``, the sum of the weights of all rows before it (null counts as 0)."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # stored, so that row numbers made here are the same in every later step
    d = stored(df.withColumn("__id", F.monotonically_increasing_id()).withColumn("__tie", F.xxhash64(F.monotonically_increasing_id())))
    place = [*order, "__tie", "__id"]
    d = stored(d.repartitionByRange(parts, *place).withColumn("__part", F.spark_partition_id()))
    w = F.coalesce(F.col(weight), F.lit(0)) if weight else F.lit(0)
    sums = d.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"), F.sum(w).alias("__weight"))
    # one row per range
    earlier = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("__part", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__rows"),
                       F.coalesce(F.sum("__weight").over(earlier), F.lit(0)).alias("__weight"))
    inside = Window.partitionBy("__part").orderBy(*place)
    d = d.join(F.broadcast(sums), "__part").withColumn(out, (F.col("__rows") + F.row_number().over(inside)).cast("bigint"))
    if weight:
        before = F.coalesce(F.sum(w).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        d = d.withColumn(start, F.col("__weight") + before)
    return d.drop("__part", "__rows", "__weight", "__tie", "__id")


def weighted_pick(rows: DataFrame, row_key: str, weights: DataFrame, key: str, weight: str, seed: int, tag: str,
                  out: str = "picked", chunk_rows: int = 250_000) -> DataFrame:
    """For each row one key drawn with a chance proportional to its whole-number weight (below 2^48 in sum; null, 0 and
    negative ones are never drawn; no key at all: null).

    Keys lie end to end on a line, a row's draw is a point on it. The line is cut into as many bins as there are keys; a key
    is entered under every bin it touches (a heavy key is expanded by many tasks), so a point is looked up by an
    equi-join on its bin and one comparison."""
    w = weights.where(F.col(weight) > 0).select(F.col(key).alias("__k"), F.col(weight).cast("bigint").alias("__w"))
    line = stored(numbered(w, ["__k"], "__n", "__w", "__lo"))
    total, n = line.agg(F.coalesce(F.sum("__w"), F.lit(0)), F.count(F.lit(1))).first()
    if not total:
        return rows.withColumn(out, F.lit(None).cast(weights.schema[key].dataType))
    width = -(-int(total) // int(n))
    ends = line.select("__k", F.col("__lo").cast("bigint").alias("__lo"), (F.col("__lo") + F.col("__w")).cast("bigint").alias("__hi"))
    first, last = F.floor(F.col("__lo") / width).cast("bigint"), F.floor((F.col("__hi") - 1) / width).cast("bigint")
    bins = expand_counts(ends.withColumn("__first", first).withColumn("__count", last - first + 1), "__count", chunk_rows, "__o")
    bins = bins.select("__k", "__lo", "__hi", (F.col("__first") + F.col("__o")).alias("__bin"))
    point = F.floor(draw_uniform(seed, tag, row_key) * F.lit(float(total))).cast("bigint")
    r = rows.withColumn("__at", point).withColumn("__bin", F.floor(F.col("__at") / width).cast("bigint"))
    hit = r.join(bins, "__bin").where((F.col("__at") >= F.col("__lo")) & (F.col("__at") < F.col("__hi")))
    return hit.withColumnRenamed("__k", out).drop("__bin", "__at", "__lo", "__hi")


def exact_shares(df: DataFrame, key: str, group: str, shares: dict, seed: int, out: str = "value", chunk_rows: int = 1_000_000) -> DataFrame:
    """Adds a value to each row so that every group has each of its values as often as its share says, to less than one
    row (C4, J5): rows are ranked inside their group in a seeded order, and ranks are cut where shares end. ``shares``: value
    weights by group. Rows of a null group, or of one without shares, get no value.

    A group with a third of all rows is ranked in chunks (`dense_positions`)."""
    some = df.where(F.col(group).isNotNull())
    pos, groups = dense_positions(some, group, key, chunk_rows, seed, "__pos")
    pos = pos.join(groups, group)
    place = (F.col("__pos") - F.col("g_start") - F.lit(0.5)) / F.col("g_rows")
    ranked = pos.withColumn(out, draw_categorical_by(place, group, shares)).drop("__pos", "g_start", "g_rows")
    rest = df.where(F.col(group).isNull()).withColumn(out, F.lit(None).cast("string"))
    return ranked.select(*df.columns, out).unionByName(rest)
