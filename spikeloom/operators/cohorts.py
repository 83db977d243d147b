"""Mergeable cohorts (K6): who was active in which period of a cohort, as exact bitmaps stored by slice of time.

A cell (slice, cohort, period, bucket) holds a bitmap of the users active there; bitmaps of the same cell
of other slices are OR-ed, so a user counts once however many slices show them. A new day of activity adds
its slice and reads nothing else: retention is computed from bitmaps alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def cohort_of(joined: str, unit: str):
    return F.date_trunc(unit, F.col(joined)).cast("timestamp_ntz")


def cohort_sizes(users: DataFrame, joined: str, unit: str = "month") -> DataFrame:
    return users.groupBy(cohort_of(joined, unit).alias("cohort")).agg(F.count(F.lit(1)).alias("cohort_users"))


def activity_bitmaps(users: DataFrame, key: str, joined: str, activity: DataFrame, act_key: str, act_ts: str,
                     unit: str = "month", slice_format: str = "yyyy-MM-dd") -> DataFrame:
    """(cohort, period_n, bucket, bits, slice) of some activity. Activity before joining does not count; rows without a key
    or a time are left out. A hot user folds to one row per day before the join."""
    u = users.select(F.col(key).cast("long").alias("__u"), F.col(joined).alias("__j"), cohort_of(joined, unit).alias("cohort"))
    a = activity.groupBy(F.col(act_key).cast("long").alias("__u"), F.to_date(F.col(act_ts)).alias("__day")).agg(F.max(act_ts).alias("__t"))
    j = a.join(u, "__u").where(F.col("__t") >= F.col("__j"))
    if unit == "week":
        since = F.floor(F.datediff(F.col("__day"), F.to_date("cohort")) / 7)
    else:
        since = (F.year("__t") - F.year("cohort")) * 12 + F.month("__t") - F.month("cohort")
    cell = [F.col("cohort"), since.cast("bigint").alias("period_n"), F.bitmap_bucket_number("__u").alias("bucket")]
    bits = j.groupBy(*cell, F.date_format("__day", slice_format).alias("slice")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__u")).alias("bits"))
    return bits.select("cohort", "period_n", "bucket", "bits", "slice")


def store_slices(bits: DataFrame, path: str) -> None:
    """Adds slices to the stored bitmaps; a slice that is there already is replaced, so a run can be repeated."""
    bits.repartition("slice").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slice").parquet(path)


def retention(spark: SparkSession, path: str, sizes: DataFrame) -> DataFrame:
    """cohort, period_n, active_users, cohort_users, retention from the stored bitmaps of all slices."""
    cells = spark.read.parquet(path).groupBy("cohort", "period_n", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    act = cells.groupBy("cohort", "period_n").agg(F.sum(F.bitmap_count("bits")).alias("active_users"))
    return act.join(sizes, "cohort").withColumn("retention", F.round(F.col("active_users") / F.col("cohort_users"), 6)).select(
        "cohort", "period_n", "active_users", "cohort_users", "retention")
