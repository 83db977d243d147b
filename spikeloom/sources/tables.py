"""Reading the input tables, the canonical schemas, and writing results (A4-A10).

The library never writes to a machine-local folder on its own: every sink takes the path or
table name from the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

USERS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("username", T.StringType(), True),
    T.StructField("role", T.StringType(), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
])
POSTS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("body", T.StringType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
])
FOLLOWS_SCHEMA = T.StructType([
    T.StructField("following_user_id", T.LongType(), False),
    T.StructField("followed_user_id", T.LongType(), False),
    T.StructField("created_at", T.TimestampNTZType(), True),
])
SCHEMAS = {"users": USERS_SCHEMA, "posts": POSTS_SCHEMA, "follows": FOLLOWS_SCHEMA}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A4: one driver table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def users_standin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """users from the driver tables: customer keys, segment as role, first order as created_at.

    Customers without an order have no join time and are left out.
    """
    first = (read_table(spark, sf_dir, "orders")
             .groupBy(F.col("o_custkey").alias("id"))
             .agg(F.min("o_orderdate").alias("created_at")))
    cust = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("username"),
        F.col("c_mktsegment").alias("role"))
    return cust.join(first, "id").select(*USERS_SCHEMA.fieldNames())


USERS_STANDIN_SQL = """(SELECT c.c_custkey AS id, c.c_name AS username, c.c_mktsegment AS role,
        f.created_at
   FROM customer c
   JOIN (SELECT o_custkey, min(o_orderdate) AS created_at FROM orders GROUP BY o_custkey) f
     ON f.o_custkey = c.c_custkey)"""


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to a declared schema, column order included."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """A5/A10: parquet files under a path (overwrite replaces the table: A8's clean slate)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_as_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Create-as-select into the session catalog (schema inferred from the query)."""
    df.write.mode(mode).format("parquet").saveAsTable(name)


def create_declared_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """A7 first half: an empty table with the declared schema (keys become checks, J1-J2)."""
    spark.createDataFrame([], schema).write.mode("overwrite").format("parquet").saveAsTable(name)


def insert_into(df: DataFrame, name: str, schema: T.StructType) -> None:
    """A7 second half: insert-select cast to the declared schema."""
    conform(df, schema).write.insertInto(name)


def drop_table_if_exists(spark: SparkSession, name: str) -> None:
    """A8."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def use_namespace(spark: SparkSession, name: str) -> None:
    """Create the database if missing and make it current."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    spark.sql(f"USE {name}")


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Name intermediates for SQL users."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
