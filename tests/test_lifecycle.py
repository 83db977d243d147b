"""Tables that are written, versioned, deleted from and joined by buckets; churn and cohorts as stored data."""

import datetime as dt
import glob
import math
import os

import pytest
from pyspark.sql import functions as F

from spikeloom.operators import checks as J
from spikeloom.operators import cohorts as C
from spikeloom.operators import growth as K
from spikeloom.operators.lifetimes import cut_activity, spike_lifetimes
from spikeloom.params import GrowthParams
from spikeloom.plans.catalog import lifecycle_q as Q
from spikeloom.plans.registry import QUERIES
from spikeloom.sources import bucketed as B
from spikeloom.sources import rewrite as R
from spikeloom.sources import versions as V
from spikeloom.sources.tables import FOLLOWS_SCHEMA
from tests.conftest import SF_CHECK, SF_SMALL


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


@pytest.mark.parametrize("name", ["bucketed_join", "bucketed_semi_anti"])
def test_bucketed_joins_do_not_shuffle(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert B.shuffles(df) == 0
    assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()


def test_one_file_per_bucket_and_rewriting(spark, tmp_path):
    df = spark.range(1000).withColumn("v", F.col("id") % 7).repartition(9)
    for _ in range(2):      # a second run replaces the first
        B.write_bucketed(df, "bucketed_once", str(tmp_path / "b"), "id", 4)
    assert len(files(tmp_path / "b")) == 4 and spark.table("bucketed_once").count() == 1000


def test_fold_activity_bounds_a_hot_key(spark):
    ts = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, ts)] * 500 + [(1, ts + dt.timedelta(days=1)), (2, ts), (None, ts), (3, None)], "k long, ts timestamp_ntz")
    assert [(r[0], r[2]) for r in sorted(B.fold_activity(df, "k", "ts").collect())] == [(1, 500), (1, 1), (2, 1)]


def orders(spark):
    data = [(i, None if i % 5 == 0 else f"p{i % 4}", i if i % 3 else None) for i in range(40)]
    return spark.createDataFrame(data, "id long, part string, v long"), data


def test_delete_rewrites_partitions_with_hits_only(spark, tmp_path):
    df, data = orders(spark)
    path = str(tmp_path / "t")
    R.write_partitioned(df, path, "part")
    before = files(path)
    assert R.delete_where(spark, path, "part", F.col("id").isin(1, 9)) == ["p1"]
    after = files(path)
    assert {f: t for f, t in before.items() if "part=p1" not in f} == {f: t for f, t in after.items() if "part=p1" not in f}
    left = [r for r in data if r[0] not in (1, 9)]
    assert rows(spark.read.parquet(path).select("id", "part", "v")) == sorted(left, key=repr)
    # a null condition deletes nothing; a whole partition, and the one of null, can go
    assert R.delete_where(spark, path, "part", F.col("v") > 1000) == []
    assert R.delete_where(spark, path, "part", (F.col("part") == "p2") | F.col("part").isNull()) == ["p2", None]
    left = [r for r in left if r[1] not in ("p2", None)]
    assert rows(spark.read.parquet(path).select("id", "part", "v")) == sorted(left, key=repr)
    # repeated after success: nothing is left to delete
    assert R.delete_where(spark, path, "part", F.col("part") == "p2") == []


def test_odd_partition_values_are_refused():
    with pytest.raises(ValueError):
        R.folder("a/b")


def test_versions_survive_failed_and_repeated_runs(spark, tmp_path):
    root = str(tmp_path / "v")
    with pytest.raises(ValueError):
        V.read_published(spark, root)
    assert V.publish_version(spark.range(3), root, 1).count() == 3
    V.stage(spark.range(9), root, 2)                # a run fails before it publishes
    assert V.read_published(spark, root).count() == 3
    for _ in range(2):                              # and is repeated, twice
        assert V.publish_version(spark.range(5), root, 2).count() == 5
    assert [(r["version"], r["n_rows"]) for r in V.open_versions(spark, root).collect()] == [(2, 5), (1, 3)]
    assert V.read_published(spark, root, 1).count() == 3
    with pytest.raises(ValueError):
        V.publish_version(spark.range(1), root, 1)


def test_create_and_replace(spark, tmp_path):
    V.create_namespace(spark, "lifecycle_ns", str(tmp_path / "ns"))
    V.create_as_select(spark.range(4), "lifecycle_ns.t", str(tmp_path / "a"))
    got = V.create_as_select(spark.range(6).withColumn("x", F.lit("y")), "lifecycle_ns.t", str(tmp_path / "b"), replace=True)
    assert got.columns == ["id", "x"] and got.count() == 6
    assert spark.read.parquet(str(tmp_path / "a")).count() == 4      # a reader of the old files is not disturbed
    assert spark.catalog.currentDatabase() == "default"


def test_declared_tables_cast_and_replace(spark, tmp_path):
    edges = spark.createDataFrame([("1", "2", None), ("3", "4", "2024-01-02 03:04:05")], "following_user_id string, followed_user_id string, created_at string")
    V.declare_table(spark, "declared_follows", FOLLOWS_SCHEMA, str(tmp_path / "d"))
    assert spark.table("declared_follows").count() == 0
    for replace, n in ((False, 2), (False, 4), (True, 2), (True, 2)):
        assert V.insert_select(edges, "declared_follows", FOLLOWS_SCHEMA, replace).count() == n
    assert [f.dataType.simpleString() for f in spark.table("declared_follows").schema] == ["bigint", "bigint", "timestamp_ntz"]


def test_checked_write_reads_its_input_once(spark, tmp_path):
    df, data = orders(spark)
    path = str(tmp_path / "in")
    df.write.parquet(path)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    source = spark.read.parquet(path).mapInArrow(counted, df.schema)
    check = J.CheckedWrite(source, ["part", "v"], {"odd": F.col("v") % 2 == 1}, {"part": ["p1", "zz"]})
    got = dict(map(tuple, check.write(str(tmp_path / "out"), ["part"]).collect()))
    assert seen.value == 40
    assert got == {"row_count": 40, "null:part": 8, "null:v": 14, "rule:odd": sum(1 for r in data if r[2] and r[2] % 2),
                   "share:part=p1": sum(r[1] == "p1" for r in data), "share:part=zz": 0, "duplicate_keys": 5}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 40
    empty = J.CheckedWrite(df.where("false"), ["v"]).write(str(tmp_path / "none"), ["id"])
    assert rows(empty) == [("duplicate_keys", 0), ("null:v", 0), ("row_count", 0)]


def test_bitmaps_merge_and_can_be_stored_again(spark, tmp_path):
    j = dt.datetime(2024, 1, 10)
    users = spark.createDataFrame([(1, j), (40_000, j), (2, dt.datetime(2024, 2, 1)), (None, j)], "id long, created_at timestamp_ntz")
    acts = [(1, j, 1), (1, j + dt.timedelta(days=1), 2), (40_000, j + dt.timedelta(days=1), 3), (2, j, 4), (None, j, 5), (9, j, 6),
            (1, j + dt.timedelta(days=40), 7), (1, None, 8)]
    acts = spark.createDataFrame(acts, "u long, ts timestamp_ntz, n long")
    for unit in ("month", "week"):
        path = str(tmp_path / unit)
        for part in (acts.where("n <= 2"), acts.where("n > 2"), acts.where("n = 1 or n = 2")):      # the last slices come twice
            days = part.select(F.to_date("ts").alias("d")).distinct()
            whole = acts.join(days, F.to_date("ts") == F.col("d"), "left_semi")
            C.store_slices(C.activity_bitmaps(users, "id", "created_at", whole, "u", "ts", unit), path)
        got = C.retention(spark, path, C.cohort_sizes(users, "created_at", unit))
        want = K.cohort_retention(users, "id", "created_at", acts, "u", "ts", unit)
        assert rows(got) == rows(want.select(*got.columns)) and len(rows(got)) > 1


def test_churn_share_and_untouched_others(spark):
    got = QUERIES["churn_in_data"](spark, SF_CHECK).first()
    before = QUERIES["churn_after_spike"](spark, SF_CHECK)
    p = GrowthParams().churn_share
    n = 5000
    j = dt.datetime(2024, 1, 5)
    users = spark.range(n).select("id", F.lit(j).alias("created_at").cast("timestamp_ntz"))
    acts = users.select(F.col("id").alias("user_id"), F.explode(F.sequence(F.lit(0), F.lit(60), F.lit(3))).alias("d")).select(
        "user_id", F.timestamp_add("DAY", F.col("d"), F.lit(j).cast("timestamp_ntz")).cast("timestamp_ntz").alias("ts"))
    ends = spike_lifetimes(users, "id", "created_at", "2024-01-01", "2024-01-08", GrowthParams())
    left = cut_activity(acts, "user_id", "ts", ends, "id")
    rate = K.churn_after_spike(users, "id", "created_at", left, "user_id", "ts", "2024-01-01", "2024-01-08").first()["churn_rate"]
    assert abs(rate - p) < 4 * math.sqrt(p * (1 - p) / n)
    # every user keeps what is before the end, those who stay keep all
    assert left.select("user_id").distinct().count() == n
    assert left.join(ends.withColumnRenamed("id", "user_id"), "user_id", "left_anti").count() == 21 * (n - ends.count())
    base = before.first()["churn_rate"] if "churn_rate" in before.columns else 0
    assert got["churn_rate"] >= base
    others = spike_lifetimes(users, "id", "created_at", "2025-01-01", "2025-01-08", GrowthParams())
    assert others.count() == 0


def test_delete_on_stored_touches_one_year(spark):
    assert QUERIES["deleted_on_stored"](spark, SF_SMALL).where("y = 1997").count() > 0
    assert Q.BUCKETS == 16
