"""Best-fit packing (operator 8): conflict-constrained best fit of documents into sequences.

Documents are cut into pieces of at most ``capacity``; a full piece is a bin. The rest are dealt by a
hash into units of about ``unit_rows`` pieces (their number follows the row count), and each unit is
packed by one task: pieces by size, largest first, go to the tightest bin that has room and holds
neither their source nor their duplicate cluster. Bins are ordered by residual room; a bin carries a
bitmap of its sources and one of its clusters. The search starts at the smallest residual that fits
and goes on to the next until a compatible bin is found, else a new one opens.

A text's size is its real token count (operator 3) and one closing token, so no bin holds more tokens
than ``capacity``; counts are stored before they are dealt, so every text is counted once.

Defined results: a document's size counts one closing token, so null and empty texts are pieces
of size 1; a null source or cluster conflicts with other nulls only; repeated rows are packed one by
one; ties go by id (nulls first), then piece; extra columns are dropped.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikeloom.llm import tokens
from spikeloom.llm.common import table, text_of
from spikeloom.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 2048
# runs of white space that are not one space
WIDE_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
UNIT_ROWS = 20_000


def best_fit(sizes, sources, clusters, capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item, items taken in the given order. Sources are small integers,
    clusters are -1 (no conflict) or small integers."""
    # levels[r]: bins with residual r, grouped by source bitmap; open_levels: bit r set if any
    levels: list[dict[int, list[int]]] = [{} for _ in range(capacity + 1)]
    open_levels, bins, places = 0, [], []
    used: list[int] = []        # room taken, by bin
    held: list[int] = []        # cluster bitmap, by bin
    for size, source, cluster in zip(sizes, sources, clusters):
        sbit, cbit = 1 << source, (1 << cluster if cluster >= 0 else 0)
        chosen, at = -1, 0
        rest = open_levels >> size
        r = size - 1
        while rest:
            step = (rest & -rest).bit_length()
            r += step
            rest >>= step
            for bitmap, group in levels[r].items():
                if bitmap & sbit:
                    continue
                for i in range(len(group) - 1, -1, -1):
                    if not held[group[i]] & cbit:
                        chosen, at = group.pop(i), bitmap
                        break
                if chosen >= 0:
                    break
            if chosen >= 0:
                if not levels[r][at]:
                    del levels[r][at]
                if not levels[r]:
                    open_levels &= ~(1 << r)
                break
        if chosen < 0:
            chosen, at = len(used), 0
            used.append(0)
            held.append(0)
        bins.append(chosen)
        places.append(used[chosen])
        used[chosen] += size
        held[chosen] |= cbit
        left = capacity - used[chosen]
        if left:
            levels[left].setdefault(at | sbit, []).append(chosen)
            open_levels |= 1 << left
    return bins, places


def _pack_task(capacity: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("cluster", "ascending")])
        sizes = t.column("n_tokens").to_numpy()
        sources = np.unique(t.column("source").fill_null("\0").to_numpy(zero_copy_only=False), return_inverse=True)[1]
        _, back, many = np.unique(t.column("cluster").to_numpy(), return_inverse=True, return_counts=True)
        number = np.where(many > 1, np.cumsum(many > 1) - 1, -1)
        bins, places = best_fit(sizes.tolist(), sources.tolist(), number[back].tolist(), capacity)
        pack = pa.array((t.column("unit").to_numpy().astype(np.int64) << 32) + np.array(bins, np.int64))
        return t.select(["doc_id", "source", "piece", "n_tokens"]).append_column("pack_id", pack) \
            .append_column("pack_offset", pa.array(places, pa.int64()))
    return run


def pack(docs: DataFrame, size: Column, cluster: Column, id_col: str = "doc_id", source_col: str = "source",
         capacity: int = CAPACITY, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """doc_id, source, piece, n_tokens, pack_id, pack_offset for every piece of every document."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                    size.cast("long").alias("size"), cluster.cast("long").alias("cluster"))
    last = F.floor((F.col("size") - 1) / capacity).cast("int")
    d = d.select("doc_id", "source", "cluster", "size", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    d = d.withColumn("n_tokens", F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("piece").cast("long") * capacity))
    units = max(1, -(-docs.count() // unit_rows))
    d = d.withColumn("unit", F.pmod(F.xxhash64("doc_id", "cluster", "piece"), F.lit(units)).cast("int")).drop("size")
    id_type = d.schema["doc_id"].dataType.simpleString()
    return d.groupBy("unit").applyInArrow(
        _pack_task(capacity), f"doc_id {id_type}, source string, piece int, n_tokens long, pack_id long, pack_offset long")


def text_size(text: Column) -> Column:
    """A rough size, a quarter of the UTF-8 bytes and one: below the real tokens of most texts, so
    ``pack_texts`` does not use it."""
    return F.ceil(F.octet_length(text_of(text)) / 4) + 1


def text_cluster(text: Column) -> Column:
    """Equal word sequences, letter case aside, are one duplicate cluster."""
    one_space = F.regexp_replace(F.lower(text_of(text)), WIDE_SPACE, " ")
    return F.xxhash64(F.trim(one_space))


def pack_texts(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", capacity: int = CAPACITY, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """``pack`` by real size: the tokens of the tokenizer file at ``path`` and one to close the text."""
    import public_tokenizers
    text = F.col(text_col)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), text_cluster(text).alias("cluster"),
                    text.alias("text"))
    counted = stored(tokens.count_tokens(d, path or public_tokenizers.path(tokens.TOKENIZER)))
    return pack(counted, F.col("n_tokens") + 1, F.col("cluster"), capacity=capacity, unit_rows=unit_rows)


def op8(spark, sf_dir):
    return pack_texts(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
