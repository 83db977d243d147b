"""Sinks and table lifecycle (A4-A12) round trips."""

import tempfile

from pyspark.sql import functions as F

from spikeloom.plans.catalog import build_q as Q
from spikeloom.sources import tables as S
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_parquet_round_trip_and_partitioning(spark):
    users = Q.q_build_users(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="spikeloom-out-", dir="/tmp")
    S.write_parquet(users, f"{out}/users")
    back = spark.read.parquet(f"{out}/users")
    assert back.schema == S.USERS_SCHEMA or [f.name for f in back.schema] == S.USERS_SCHEMA.fieldNames()
    assert _rows(back) == _rows(users)
    S.write_parquet(users.withColumn("month", F.date_format("created_at", "yyyy-MM")), f"{out}/by_month",
                    partition_by=["month"])
    pruned = spark.read.parquet(f"{out}/by_month").where(F.col("month") == "1995-03")
    assert "PartitionFilters: [isnotnull(month" in pruned._jdf.queryExecution().executedPlan().toString()


def test_declared_table_insert_drop_namespace_views(spark):
    S.use_namespace(spark, "social_sample")
    S.drop_table_if_exists(spark, "follows_t")
    S.create_declared_table(spark, "follows_t", S.FOLLOWS_SCHEMA)
    edges = spark.createDataFrame([(1, 2, None)], "following_user_id int, followed_user_id int, created_at string")
    S.insert_into(edges, "follows_t", S.FOLLOWS_SCHEMA)
    got = spark.table("follows_t")
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "bigint", "timestamp_ntz"]
    assert got.count() == 1
    S.save_as_table(got, "follows_copy")
    assert spark.table("follows_copy").count() == 1
    S.register_views(spark, {"v_follows": got})
    assert spark.sql("SELECT count(*) AS n FROM v_follows").first()["n"] == 1
    S.drop_table_if_exists(spark, "follows_t")
    S.drop_table_if_exists(spark, "follows_copy")
    spark.sql("USE default")
