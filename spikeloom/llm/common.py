"""Shared pieces: table access, word splitting, row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spikeloom.session import checkpoint_dir

# words are runs of anything but space and the control characters 9 to 13
SPACES = "\t\n\x0b\x0c\r"
WORD_SQL = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORDS = "array<string>"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def text_of(col: Column | str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def squeeze(text: Column) -> Column:
    """The words of a text with one space between them."""
    flat = F.trim(F.translate(text, SPACES, " " * len(SPACES)))
    return F.regexp_replace(flat, " {2,}", " ")


def words(text: Column) -> Column:
    """Array of words; empty for a text without words."""
    flat = F.trim(F.translate(text, SPACES, " " * len(SPACES)))
    return F.when(flat == "", F.array().cast(NO_WORDS)).otherwise(F.split(flat, " +"))


def cut(df: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def named(names) -> list[Column]:
    """Columns by their exact names, dots included."""
    return [F.col(f"`{c}`") for c in names]


def wrapped(docs: DataFrame, *cols: Column | str) -> DataFrame:
    """The whole row as ``__doc`` beside the given columns: no name of the input can clash."""
    return docs.select(F.struct(*named(docs.columns)).alias("__doc"), *cols)


def unwrapped(df: DataFrame, docs: DataFrame) -> DataFrame:
    """Back to the columns of ``docs``."""
    return df.select(*[F.col("__doc").getField(c).alias(c) for c in docs.columns])


ROW_KEYS = ("__row_key_1", "__row_key_2")


def row_keys() -> tuple[Column, Column]:
    """Two hashes over id and text: 128 bits that tell rows apart, never null."""
    return (F.xxhash64("doc_id", "text").alias(ROW_KEYS[0]),
            F.xxhash64(F.lit(1), "text", "doc_id").alias(ROW_KEYS[1]))
