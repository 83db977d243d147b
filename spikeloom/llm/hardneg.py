"""Hard-negative mining (operator 12): exact integer scores by Strassen tiles, mergeable heaps.

Vectors become integers, floor(scale * x). Rows are packed into candidate tiles, query rows (anchors)
into anchor tiles; every candidate tile meets every anchor tile once per pass, and the product of two
tiles is taken by Strassen's recursion: odd sides are padded with zeros, half-size blocks are added and
multiplied seven times instead of eight, down to ``leaf``. All sums are int64, which wraps alike on both sides
of every identity, so a score is exact whenever it fits 64 bits itself. A leaf is multiplied in
floating point only where its largest possible sum is below 2^53, thus exactly, else in int64.

Pass one keeps for each anchor a heap of its best rows of the same label, pass two for each of these
positives a heap of the best rows of other labels whose score lies in the positive's window. Heaps live in the
task across tiles; a full heap's last score raises the bar for the next tile. A task passes its heaps
on, and heaps merge by rank, cut once more before the shuffle. A label or a vector that holds a
third of all rows only fills tiles; no group is collected.

Work grows with anchors times rows, which is what the question asks. If the anchor tiles are small enough,
Spark broadcasts them by its own measured limit; else tiles meet by (anchor tile, group), ``groups``
groups per tile.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no part;
vectors of different length are compared as if padded with zeros; a null id is no anchor's, and sorts
after all others among equal scores; repeated rows are rows of their own (an anchor that stands twice is
its own positive, and returns its rows twice); extra columns are dropped.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spikeloom.llm.common import table
from spikeloom.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Mine:
    positives: int = 5
    negatives: int = 10
    low: int = 30           # percent of the positive's score, least
    high: int = 90          # and most
    scale: int = 256
    tile: int = 1024        # candidate rows of a tile
    anchors: int = 1024     # anchor rows of a tile, about
    leaf: int = 32
    groups: int = 16
    heaps: int = 8          # anchor tiles whose heaps a task holds at a time


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = 32) -> np.ndarray:
    """a @ b of int64 matrices."""
    (n, k), m = a.shape, b.shape[1]
    if min(n, k, m) <= leaf:
        most = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * k
        if most < 2 ** 53:
            return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
        return a @ b
    if n % 2 or k % 2 or m % 2:
        a = np.pad(a, ((0, n % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, m % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l] = m1 + m4 - m5 + m7
    out[:i, l:] = m3 + m5
    out[i:, :l] = m2 + m4
    out[i:, l:] = m1 - m2 + m3 + m6
    return out[:n, :m]


class Heaps:
    """The best ``most`` entries of each of n groups: score high first, then id (none last), then row."""

    def __init__(self, n: int, most: int):
        self.most = most
        self.bar = np.full(n, np.iinfo(np.int64).min)     # entries below can't enter
        self.held = [np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64, np.int64)]

    def add(self, group, score, none, ids, rows) -> None:
        new = [np.concatenate(x) for x in zip(self.held, (group, score, none, ids, rows))]
        group, score, none, ids, rows = new
        order = np.lexsort((rows, ids, none, ~score, group))
        first = np.searchsorted(group[order], group[order])
        rank = np.arange(len(order)) - first
        order = order[rank < self.most]
        self.held = [x[order] for x in new]
        last = rank[rank < self.most] == self.most - 1
        self.bar[self.held[0][last]] = self.held[1][last]


def _tile_task(rows: int):
    """Arrow task: rows (row, id, label, vector, floors...) packed into tiles."""
    def pack(part: list) -> pa.RecordBatch:
        t = pa.Table.from_batches(part).combine_chunks()
        return tile(t)

    def run(batches):
        part, n = [], 0
        for b in batches:
            at = 0
            while at < b.num_rows:
                piece = b.slice(at, rows - n)
                part.append(piece)
                n, at = n + piece.num_rows, at + piece.num_rows
                if n == rows:
                    yield pack(part)
                    part, n = [], 0
        if n:
            yield pack(part)
    return run


def tile(t: pa.Table) -> pa.RecordBatch:
    """One row that holds a table of rows: numbers, ids, labels, positives' scores and the vectors, padded with
    zeros to the longest, in the narrowest type that holds them."""
    one = t.to_batches()[0]
    vectors = one.column("vector")
    size = np.asarray(vectors.value_lengths())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    wide = int(size.max(initial=0))
    m = np.zeros((len(size), wide), np.int64)
    m[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    kind = next(k for k in ("<i2", "<i4", "<i8") if not len(flat) or (np.iinfo(k).min <= flat.min() and flat.max() <= np.iinfo(k).max))
    floors = one.column("floors").to_pylist()
    arrays = [pa.array([one.column("row").to_pylist()], pa.list_(pa.int64())), pa.array([one.column("id").to_pylist()], pa.list_(pa.int64())),
              pa.array([one.column("label").to_pylist()], pa.list_(pa.int64())),
              pa.array([floors], pa.list_(pa.list_(pa.int64()))),
              pa.array([kind]), pa.array([wide], pa.int32()), pa.array([m.astype(kind).tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, TILE_NAMES)


TILE_NAMES = ["row", "id", "label", "floors", "kind", "wide", "vectors"]
TILE = "row array<long>, id array<long>, label array<long>, floors array<array<long>>, kind string, wide int, vectors binary"


def unpacked(cols: dict, i: int, side: str):
    """Rows, null ids, ids, labels and vectors of one packed tile."""
    get = lambda n: cols[f"{side}_{n}"][i]
    ids = get("id")
    none = np.asarray(ids.values.is_null())
    kind, wide = get("kind").as_py(), get("wide").as_py()
    rows = np.asarray(get("row").values)
    m = np.frombuffer(get("vectors").as_py(), kind).reshape(len(rows), wide).astype(np.int64)
    return rows, none, np.asarray(ids.values.fill_null(0)), np.asarray(get("label").values), m


def _meet_task(p: Mine, same: bool):
    """Arrow task over pairs of tiles (a_..., c_...): the heaps of their anchors, over rows of the same label or, per
    positive, over rows of other labels inside its window."""
    most = p.positives if same else p.negatives

    def out(rows: np.ndarray, heaps: list[Heaps]) -> pa.RecordBatch:
        cols = [np.concatenate(c) for c in zip(*([rows[h.held[0]], np.full(len(h.held[0]), k + 1, np.int32), *h.held[1:]]
                                                 for k, h in enumerate(heaps)))]
        a, k, score, none, ids, row = cols
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(k, pa.int32()), pa.array(score), pa.array(ids, mask=none),
                                           pa.array(row)], ["anchor", "k", "score", "id", "row"])

    def run(batches):
        held: dict = {}         # anchor tile -> (rows, windows, heaps)
        for b in batches:
            cols = dict(zip(b.schema.names, b.columns))
            for i, key in enumerate(b.column("block").to_pylist()):
                arow, _, _, alabel, avec = unpacked(cols, i, "a")
                crow, cnone, cid, clabel, cvec = unpacked(cols, i, "c")
                if key not in held:
                    if len(held) == p.heaps:
                        rows, _, heaps = held.pop(next(iter(held)))
                        yield out(rows, heaps)
                    kinds = [()] if same else range(p.positives)
                    given = [f or [] for f in cols["a_floors"][i].as_py()]
                    bounds = None if same else [window([f[k] if k < len(f) else None for f in given], p) for k in kinds]
                    held[key] = (arow, bounds, [Heaps(len(arow), most) for _ in kinds])
                _, bounds, heaps = held[key]
                wide = max(avec.shape[1], cvec.shape[1])
                avec, cvec = (np.pad(v, ((0, 0), (0, wide - v.shape[1]))) for v in (avec, cvec))
                # a quarter of the tile at a time: the first rows raise the bar for the rest
                for lo in range(0, len(crow), max(1, p.tile // 4)):
                    part = slice(lo, lo + max(1, p.tile // 4))
                    score = strassen(avec, cvec[part].T, p.leaf)
                    equal = alabel[:, None] == clabel[part][None, :]
                    fits = equal & (arow[:, None] != crow[part][None, :]) if same else ~equal
                    for k, heap in enumerate(heaps):
                        least, top = (heap.bar, None) if same else (np.maximum(bounds[k][0], heap.bar), bounds[k][1])
                        ok = fits & (score >= least[:, None])
                        if top is not None:
                            ok &= score <= top[:, None]
                        x, y = np.nonzero(ok)
                        if len(x):
                            heap.add(x, score[x, y], cnone[part][y], cid[part][y], crow[part][y])
        for rows, _, heaps in held.values():
            yield out(rows, heaps)
    return run


def window(scores: list, p: Mine) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of negatives for each positive's score; an empty range where there is none."""
    low = [-(-p.low * s // 100) if s is not None else 1 for s in scores]
    high = [p.high * s // 100 if s is not None else 0 for s in scores]
    return np.array(low, np.int64), np.array(high, np.int64)


def _packed_groups(rows: DataFrame, key: str) -> DataFrame:
    """One tile per value of ``key``; keys are hashes of row numbers, so groups are of even size."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("row").combine_chunks()
        return pa.Table.from_batches([tile(t.drop([key]))]).append_column(key, t.column(key).slice(0, 1))
    return rows.groupBy(key).applyInArrow(run, f"{TILE}, {key} long")


def _meet(candidates: DataFrame, anchors: DataFrame, blocks: int, p: Mine, same: bool) -> DataFrame:
    """Heaps of all pairs of tiles: (anchor, k, score, id, row)."""
    c = candidates.select(*[F.col(n).alias(f"c_{n}") for n in TILE_NAMES if n != "floors"],
                          F.pmod(F.xxhash64("vectors", "row"), F.lit(p.groups)).alias("g"))
    c = c.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    a = anchors.select("block", *[F.col(n).alias(f"a_{n}") for n in TILE_NAMES])
    a = a.withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(p.groups - 1).cast("long"))))
    return c.join(a, ["block", "g"]).mapInArrow(_meet_task(p, same), "anchor long, k int, score long, id long, row long")


def _best(heaps: DataFrame, most: int, *group: str) -> DataFrame:
    """Heaps merged: the best of each group with their rank."""
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(rows: DataFrame, anchor: Column, p: Mine = Mine(), id_col: str = "vec_id", vector_col: str = "embedding",
         label: Column | str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``anchor`` says which rows ask."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    label = F.col(label) if isinstance(label, str) else label
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * p.scale))
    d = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("vector"),
                    F.coalesce(anchor, F.lit(False)).alias("asks"), (v.isNotNull() & finite).alias("ok"))
    d = stored(d.where("ok and label is not null").drop("ok").withColumn("row", F.monotonically_increasing_id()))
    blocks = max(1, -(-d.where("asks").count() // p.anchors))
    none = F.lit(None).cast("array<long>")
    candidates = stored(d.select("row", "id", "label", "vector", none.alias("floors")).mapInArrow(_tile_task(p.tile), TILE))
    asking = d.where("asks").select("row", "id", "label", "vector", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"))
    tiles = _packed_groups(asking.withColumn("floors", none), "block")
    good = stored(_best(_meet(candidates, tiles, blocks, p, True), p.positives, "anchor"))
    floors = good.groupBy("anchor").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("floors"))
    asking = asking.join(floors.withColumnRenamed("anchor", "row"), "row")
    found = _best(_meet(candidates, _packed_groups(asking, "block"), blocks, p, False), p.negatives, "anchor", "k")
    pos = good.select("anchor", F.col("rank").alias("k"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = d.where("asks").select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return found.join(pos, ["anchor", "k"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def op12(spark, sf_dir):
    d = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(d, F.col("vec_id") % 100 == 0, label=label)


OP12_SQL = r"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
        list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * c.q[i]))::BIGINT AS score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id AND a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INT AS rank, s.vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 10"""
