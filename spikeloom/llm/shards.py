"""Sharding (operator 10): fixed virtual slots and a versioned slot-to-shard map.

Records are hashed into ``n_slots`` virtual slots (thousands, fixed for the life of the corpus),
bytes and rows are summed per slot, and a small map says which shard owns a slot. Version 1 of the
map is by rule (slot modulo shards). ``rebalance`` edits it: a shard keeps its slots, largest
first, while they fit the mean, and only the rest moves, each to the shard least loaded so far.
``write_map`` / ``read_map`` store versions as Parquet, so a reader can follow every move; the query writes
both versions and places by what it reads back.

Only DataFrame operations: the map has ``n_slots`` rows (a parameter), so it is broadcast and
folded in one row; records are only hashed, joined to it and numbered inside their slot.

Defined results: a null text has size 1 and checksum 0, a null id is hashed as such. Rows are
numbered by id, checksum and size inside a slot; ties are equal in all three. An empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spikeloom.llm.common import table, text_of
from spikeloom.session import scratch_path, stored

N_SLOTS = 4096
N_SHARDS = 16
CHUNK = 65_536              # copies of a row dealt out at a time
MOVES = "array<struct<vslot:bigint,shard:int>>"


def record_slot(key: Column, n_slots: int = N_SLOTS) -> Column:
    """Virtual slot of a record key (string), from 32 bits of its md5."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % F.lit(n_slots)


def slot_records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32, vslot; texts are read here and nowhere else."""
    t = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       (F.octet_length(t) + F.lit(1)).cast("bigint").alias("size"),
                       F.crc32(t.cast("binary")).cast("bigint").alias("text_crc32"))
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                      F.col("text_crc32").cast("string"))
    return rows.withColumn("vslot", record_slot(key, n_slots))


def slot_bytes(records: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """vslot, bytes, n_rows of every slot, also of those that hold nothing yet: a stored map has a place for
    records that come later."""
    sums = records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"))
    every = records.sparkSession.range(n_slots).select(F.col("id").alias("vslot"))
    return every.join(sums, "vslot", "left").fillna(0, ["bytes", "n_rows"])


def initial_map(slots: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """Version 1: slot modulo shards. Columns vslot, bytes, n_rows, shard, version."""
    return slots.withColumn("shard", (F.col("vslot") % n_shards).cast("int")).withColumn("version", F.lit(1))


def rebalance(slot_map: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """The next version: shards of nearly equal bytes, moving only slots beyond a shard's mean.
    ``n_shards`` may be more than the map has; the new shards start empty."""
    mean = F.ceil(F.sum("bytes").over(W.partitionBy()) / n_shards)
    run = F.sum("bytes").over(W.partitionBy("shard").orderBy(F.desc("bytes"), "vslot")
                              .rowsBetween(W.unboundedPreceding, 0))
    m = slot_map.withColumn("__stay", (run <= mean) & (F.col("shard") < n_shards))
    per_shard = [F.coalesce(F.sum(F.when(F.col("__stay") & (F.col("shard") == s), F.col("bytes"))), F.lit(0))
                 .cast("bigint") for s in range(n_shards)]
    moving = F.collect_list(F.when(~F.col("__stay"), F.struct((-F.col("bytes")).alias("neg"), F.col("vslot"))))
    state = m.agg(F.array(*per_shard).alias("loads"), F.sort_array(moving).alias("moving"))

    def place(acc: Column, x: Column) -> Column:
        to = F.array_position(acc["loads"], F.array_min(acc["loads"]))
        loads = F.transform(acc["loads"], lambda b, i: F.when(i + 1 == to, b - x["neg"]).otherwise(b))
        move = F.array(F.struct(x["vslot"].alias("vslot"), (to - 1).cast("int").alias("shard")))
        return F.struct(loads.alias("loads"), F.concat(acc["moves"], move).alias("moves"))

    folded = F.aggregate("moving", F.struct(F.col("loads"), F.array().cast(MOVES).alias("moves")), place)
    moves = state.select(F.inline(folded["moves"])).select("vslot", F.col("shard").alias("__to"))
    out = m.join(F.broadcast(moves), "vslot", "left")
    return out.select("vslot", "bytes", "n_rows", F.coalesce("__to", "shard").alias("shard"),
                      (F.col("version") + 1).alias("version"))


def write_map(slot_map: DataFrame, path: str) -> None:
    """Adds this version of the map to the store (one folder per version). A version that is there already is
    replaced, so a repeated run leaves one copy of it."""
    (slot_map.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("version").parquet(path))


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The given version, or the newest."""
    store = spark.read.parquet(path)
    wanted = store.agg(F.max("version")).scalar() if version is None else F.lit(version)
    return store.where(F.col("version") == wanted)


def place_records(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, vslot, shard and slot: the row's position in its shard, 0 and up without gaps.
    The records before a slot in its shard are those of these records, counted per slot and laid out by
    the map; those before a row in its slot come from a window over the slot's different rows. Equal
    rows fold into one with a count and take the next positions, dealt out in chunks."""
    keys = ["vslot", "doc_id", "text_crc32", "size"]
    folded = records.groupBy(*keys).agg(F.count(F.lit(1)).alias("__c"))
    held = folded.groupBy("vslot").agg(F.sum("__c").alias("__held"))
    own = slot_map.select("vslot", "shard").join(held, "vslot", "left")
    before = F.sum(F.coalesce("__held", F.lit(0))).over(W.partitionBy("shard").orderBy("vslot").rowsBetween(W.unboundedPreceding, -1))
    offsets = own.select("vslot", "shard", F.coalesce(before, F.lit(0)).alias("__before"))
    up_to = F.sum("__c").over(W.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size").rowsBetween(W.unboundedPreceding, -1))
    rows = folded.withColumn("__nth", F.coalesce(up_to, F.lit(0))).join(F.broadcast(offsets), "vslot")
    last = F.floor((F.col("__c") - 1) / CHUNK).cast("long")
    rows = rows.withColumn("__k", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    inside = F.sequence(F.col("__k") * CHUNK, F.least((F.col("__k") + 1) * CHUNK, F.col("__c")) - 1)
    rows = rows.withColumn("__i", F.explode(inside))
    return rows.select("doc_id", "size", "text_crc32", "vslot", "shard", (F.col("__before") + F.col("__nth") + F.col("__i")).cast("bigint").alias("slot"))


def op10(spark, sf_dir):
    records = stored(slot_records(table(spark, sf_dir, "documents", "doc_id", "text")))
    store = scratch_path(spark, "slots")
    write_map(initial_map(slot_bytes(records)), store)
    write_map(rebalance(read_map(spark, store, 1)), store)
    out = place_records(records, read_map(spark, store))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
