"""Spark session helpers.

`get_session` is for local runs and tests. On a cluster the session is made by the platform;
the library only reads settings from it (`checkpoint_dir`).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints of frames that are gone are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # small dimension tables (per-day counts, periods) are broadcast; anything bigger shuffles
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "spikeloom", extra_conf: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
    builder = builder.config("spark.driver.memory", os.environ.get("SPIKELOOM_DRIVER_MEM", "16g"))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    On a cluster this is set by whoever runs the job (a shared file system path). Only when it
    is unset and the master is local (tests) do we pick a fresh local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="spikeloom-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, what: str = "table") -> str:
    """A new path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/spikeloom-{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the shared checkpoint folder: lineage is cut, later steps read
    files (compressed, unlike checkpoint()), and a lost executor costs one task's work."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


SPLIT = 128 << 20


def spread(df: DataFrame) -> DataFrame:
    """Rows that get costly columns next: a small input is a few splits, and as many busy tasks. Below one split per
    core, by Spark's own estimate of its size, the rows are dealt out to all cores; larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * SPLIT else df
