"""Table lifecycle (A5-A9): create as select, declared tables, and versions that are published whole.

A version is staged under its own folder and becomes visible by one marker row written after it. A run that
fails leaves staged files that nobody reads, and the next run of the same version overwrites them; a
run repeated after success writes the same again. Everything goes through Spark's readers and writers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spikeloom.sources.tables import conform, drop_table_if_exists

MARKERS = "n_rows long, folder string, version int"


def stage(df: DataFrame, root: str, version: int) -> str:
    """The frame as the (not yet visible) files of a version."""
    folder = f"data-{version:06d}"
    df.write.mode("overwrite").parquet(f"{root}/{folder}")
    return folder


def publish(spark: SparkSession, root: str, version: int, folder: str) -> None:
    """Makes a staged version the one readers see. The marker holds the number of rows that were staged."""
    n = spark.read.parquet(f"{root}/{folder}").count()
    mark = spark.createDataFrame([(n, folder, version)], MARKERS)
    # one folder per version: a repeated run replaces its own marker only
    mark.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(f"{root}/published")


def open_versions(spark: SparkSession, root: str) -> DataFrame:
    """The markers of a table's published versions, newest first; makes the folder where it is missing."""
    spark.createDataFrame([], MARKERS).write.mode("ignore").parquet(f"{root}/published")
    return spark.read.schema(MARKERS).parquet(f"{root}/published").orderBy(F.desc("version"))


def publish_version(df: DataFrame, root: str, version: int) -> DataFrame:
    """Stage, then publish. Versions are published in order; an older one than the newest is refused."""
    spark = df.sparkSession
    newest = open_versions(spark, root).first()
    if newest is not None and version < newest["version"]:
        raise ValueError(f"version {version} is older than the published {newest['version']}")
    publish(spark, root, version, stage(df, root, version))
    return read_published(spark, root)


def read_published(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest published version, or a given one."""
    marks = open_versions(spark, root)
    mark = (marks if version is None else marks.where(F.col("version") == version)).first()
    if mark is None:
        raise ValueError(f"no published version of {root}" + ("" if version is None else f" numbered {version}"))
    return spark.read.parquet(f"{root}/{mark['folder']}")


def create_as_select(df: DataFrame, name: str, path: str, replace: bool = False) -> DataFrame:
    """Table ``name`` at ``path`` with the rows and the schema of a query. With ``replace`` a table of that name is
    exchanged after the new files are complete, so readers see the old rows or the new ones; ``path`` is then a new one."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(path)
    if replace:
        drop_table_if_exists(spark, name)
    spark.catalog.createTable(name, path=path, source="parquet")
    return spark.table(name)


def declare_table(spark: SparkSession, name: str, schema: T.StructType, path: str) -> None:
    """A7, first half: an empty table with declared columns at a path; an older definition is dropped."""
    drop_table_if_exists(spark, name)
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)


def insert_select(df: DataFrame, name: str, schema: T.StructType, replace: bool = False) -> DataFrame:
    """A7, second half: rows cast to the declared columns, in place of the old ones with ``replace`` (which makes a
    repeated run give the same table)."""
    conform(df, schema).write.insertInto(name, overwrite=replace)
    return df.sparkSession.table(name)


def create_namespace(spark: SparkSession, name: str, path: str) -> None:
    """A database at a path, without making it current."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{path}'")
