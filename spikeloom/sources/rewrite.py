"""Deleting rows of a stored, partitioned table (A11) by rewriting only the partitions that hold some."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spikeloom.session import stored

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def write_partitioned(df: DataFrame, path: str, by: str) -> DataFrame:
    """The frame at a path, one folder per value of ``by``."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)
    return df.sparkSession.read.parquet(path)


def delete_where(spark: SparkSession, path: str, by: str, gone: Column) -> list:
    """Deletes the rows for which ``gone`` is true (not those for which it is null) from the table at ``path``, partitioned by
    ``by``; returns the values of the partitions that were rewritten. Files of all others stay.

    One scan finds the partitions with hits (their values are metadata of the table, as Spark's own listing is);
    the rows they keep are stored aside, then replace them by dynamic partition overwrite. A run that fails
    in between can be repeated: rows already deleted are no hits, and the rest is as before."""
    table = spark.read.parquet(path)
    hit = F.coalesce(gone, F.lit(False))
    values = [r[0] for r in table.where(hit).select(by).distinct().collect()]
    if not values:
        return []
    some = [v for v in values if v is not None]
    here = F.col(by).isin(some) if some else F.lit(False)
    if None in values:
        here = here | F.col(by).isNull()
    kept = stored(table.where(here).where(~hit))
    left = {r[0] for r in kept.select(by).distinct().collect()}
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    # dynamic overwrite leaves partitions alone that get no row: these become one file without rows
    none = spark.createDataFrame([], table.drop(by).schema)
    for v in values:
        if v not in left:
            none.coalesce(1).write.mode("overwrite").parquet(f"{path}/{by}={folder(v)}")
    return sorted(values, key=lambda v: (v is None, v))


def folder(value) -> str:
    """The folder name of a partition value; those that Spark would escape are refused."""
    name = NULL_FOLDER if value is None else str(value)
    if not re.fullmatch(r"[\w. +-]+", name):
        raise ValueError(f"partition value {name!r} needs escaping")
    return name
