"""Shared pieces for registered queries: seed, stand-in periods, table sizes."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from spikeloom.sources.tables import read_table

SEED = 42

# Stand-in periods over the driver's `orders` dates (1995-01-01 .. 2001-08-01)
ORDERS_PRE_END = "1996-01-01"
ORDERS_PEAK_END = "1996-03-01"
# Stand-in windows over `events` (2024-01-01 .. 2024-01-30): days 1-10, 11-15, 16-30
EVENTS_PEAK_START = "2024-01-11"
EVENTS_PEAK_END = "2024-01-16"


def count_of(spark: SparkSession, sf: str, table: str) -> Column:
    """Row count of a table as a scalar subquery (E4), evaluated once per query."""
    return read_table(spark, sf, table).agg(F.count(F.lit(1))).scalar()


def count_sql(table: str) -> str:
    return f"(SELECT count(*) FROM {table})"


def period_of(ts, pre_end: str, peak_end: str) -> Column:
    """pre / peak / post by two literal bounds."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return (F.when(t < F.lit(pre_end).cast("timestamp_ntz"), F.lit("pre"))
            .when(t < F.lit(peak_end).cast("timestamp_ntz"), F.lit("peak"))
            .otherwise(F.lit("post")))


def period_of_sql(ts: str, pre_end: str, peak_end: str) -> str:
    return (f"(CASE WHEN {ts} < TIMESTAMP '{pre_end}' THEN 'pre' "
            f"WHEN {ts} < TIMESTAMP '{peak_end}' THEN 'peak' ELSE 'post' END)")
