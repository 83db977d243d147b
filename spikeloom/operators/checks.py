"""Table checks (J1-J6): declared keys and stated rules as queries.

Each check is one aggregation pass (partial aggregation before the shuffle), returning the
offending rows or a small summary, never the whole table.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values seen more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def check_foreign_key(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose reference has no parent (left anti join); a null reference
    refers to nothing and is no orphan.

    The parent side is projected to its key first; Spark broadcasts it when small and
    otherwise shuffles both sides on the key.
    """
    parent_keys = parent.select(F.col(pk).alias("__pk"))
    return child.where(F.col(fk).isNotNull()).join(parent_keys, F.col(fk) == F.col("__pk"), "left_anti")


def check_no_self(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Edges from a node to itself."""
    return edges.where(F.col(a) == F.col(b))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """F1 + H5: one row per table with its row count."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def check_row_counts(tables: dict[str, DataFrame], expected: dict[str, int]) -> DataFrame:
    """Observed against expected size per table (`ok` false on a miss)."""
    counts = table_counts(tables)
    spark = counts.sparkSession
    exp = spark.createDataFrame([(k, int(v)) for k, v in expected.items()],
                                "table_name string, expected long")
    return (counts.join(F.broadcast(exp), "table_name", "left")
            .withColumn("ok", F.col("row_count") == F.col("expected")))


def share_by(df: DataFrame, col: str, count_name: str = "n_rows",
             pct_name: str = "percentage") -> DataFrame:
    """Count and percent of total per category, rounded to 2 places.

    The total is a scalar subquery over the grouped result (E4), run once.
    """
    grouped = df.groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
    total = grouped.agg(F.sum(count_name)).scalar()
    return grouped.withColumn(
        pct_name, F.round(F.lit(100.0) * F.col(count_name) / total, 2).cast("double"))


def check_shares(df: DataFrame, col: str, targets: Sequence[tuple[str, float]],
                 tol_sigmas: float = 4.0) -> DataFrame:
    """Observed share against target; ``ok`` when within ``tol_sigmas`` binomial sd.

    Categories present only on one side show up with a zero share on the other.
    """
    spark = df.sparkSession
    total_w = float(sum(w for _, w in targets))
    tgt = spark.createDataFrame([(v, float(w) / total_w) for v, w in targets],
                                f"{col} string, target double")
    grouped = df.groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
    joined = grouped.join(F.broadcast(tgt), col, "full_outer").fillna({"n_rows": 0, "target": 0.0})
    total = grouped.agg(F.sum("n_rows")).scalar()
    share = F.col("n_rows") / total
    sd = F.sqrt(F.col("target") * (F.lit(1.0) - F.col("target")) / total)
    return (joined.withColumn("share", F.round(share, 6))
            .withColumn("ok", F.abs(share - F.col("target")) <= F.lit(tol_sigmas) * sd
                        + F.lit(1e-12)))


def check_not_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count per column in one pass; one row per column."""
    cols = list(cols or df.columns)
    agg = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', coalesce(`{c}`, 0L)" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, null_count)")


class CheckedWrite:
    """J1 and J3-J6 while a table is written: one pass computes row count, nulls, rows that break a rule and the
    rows of given categories as observed metrics of the write; a key's duplicates come from one aggregate
    over the written key columns.

    Metrics are collected where the write's own tasks end, so a task that is run again counts once.
    """

    def __init__(self, df: DataFrame, not_null: Sequence[str] = (), never: dict[str, Column] | None = None,
                 shares: dict[str, Sequence] | None = None):
        self.df, self.not_null, self.never, self.shares = df, list(not_null), dict(never or {}), dict(shares or {})

    def metrics(self) -> list[Column]:
        out = [F.count(F.lit(1)).alias("row_count")]
        out += [F.count_if(F.col(c).isNull()).alias(f"null:{c}") for c in self.not_null]
        # a rule that is null for a row is not broken by it
        out += [F.count_if(F.coalesce(rule, F.lit(False))).alias(f"rule:{name}") for name, rule in self.never.items()]
        out += [F.count_if(F.col(c) == F.lit(v)).alias(f"share:{c}={v}") for c, vs in self.shares.items() for v in vs]
        return out

    def write(self, path: str, keys: Sequence[str] = (), partition_by: Sequence[str] = ()) -> DataFrame:
        """Writes the table and returns (metric, value)."""
        spark = self.df.sparkSession
        seen = Observation()
        w = self.df.observe(seen, *self.metrics()).write.mode("overwrite")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
        found = {k: int(v or 0) for k, v in seen.get.items()}
        if keys:
            twice = spark.read.parquet(path).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            found["duplicate_keys"] = twice.agg(F.count_if(F.col("n") > 1)).first()[0]
        return spark.createDataFrame(sorted(found.items()), "metric string, value long")
