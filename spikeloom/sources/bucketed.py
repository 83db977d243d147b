"""Bucketed, sorted tables (A4, A5) for joins without a shuffle.

Tables that are joined on the same key again and again are written once by its hash: every bucket is one
sorted file, and joins, semi and anti joins and aggregates on the key read matching buckets in one task.
A bucket cannot be split at read time, so a key with a large share of the rows would make one slow task:
`fold_activity` reduces activity to one row per key and day before it is bucketed, which bounds a key by
the days of the data.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spikeloom.sources.tables import drop_table_if_exists


def fold_activity(activity: DataFrame, key: str, ts: str) -> DataFrame:
    """One row per key and calendar day: (key, day, n, last). Partial sums are made before the shuffle.
    Rows without a key or a time are left out."""
    a = activity.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    return a.groupBy(F.col(key).alias("user_id"), F.to_date(F.col(ts)).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.max(ts).alias("last"))


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, sort: Sequence[str] = ()) -> DataFrame:
    """The frame as table ``name`` at ``path``: ``buckets`` files, dealt by the hash of ``key`` and sorted by it and ``sort``.
    A table of that name is replaced; so is what a failed run left at the path."""
    drop_table_if_exists(df.sparkSession, name)
    # dealt by the same hash as the buckets first: one file each, however many tasks write
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key, *sort)
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def co_located(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join of two tables bucketed alike by ``on`` (same type, same number of buckets): a merge join of
    matching buckets, nothing is shuffled or broadcast."""
    return left.join(right.hint("merge"), on, how)


def shuffles(df: DataFrame) -> int:
    """Exchanges in the physical plan, broadcasts included."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")
