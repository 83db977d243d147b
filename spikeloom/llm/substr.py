"""Substring dedup (operator 5): compressed FM-index per shard, matching statistics of streamed texts.

Goal: every word covered by a window of ``window`` words whose word sequence also starts anywhere else.

  runs      one Arrow pass: the windows of a text fall into runs that share their smallest hashed
            ``anchor``-word gram. Equal windows have equal anchors, so a window can only repeat where
            its anchor does. A run's segment is the words its windows cover; each window position of
            the corpus lies in exactly one segment
  repeats   anchors are counted over the corpus; runs whose anchor occurs once are done
  segments  equal segments fold into one with its count; folded ones repeat as a whole
  shards    the distinct segments of the other anchors go to shards by anchor. A shard builds an
            FM-index over them (wavelet matrix of the word-level BWT, bit vectors with block ranks) and
            streams its single segments through it: backward search gives, from each end, the longest
            match that occurs twice; matches of ``window`` words or more are reported as intervals
  removal   intervals are merged per text, and the kept words hashed

Anchors with more than ``hot`` distinct segments are counted window by window instead, by 128 bits of
the window's words: equal windows have equal anchors, so those counted twice or more repeat and the
others do not. The counts are aggregated and joined, so a passage in a third of all texts meets in no
task. Shard sizes follow ``shard_words``; nothing is capped.

Defined results: null texts and texts without words have no words and nothing removed; repeated rows
are copies of each other, so their windows repeat; a null id is kept as null.
"""

from __future__ import annotations

import hashlib
import sys
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spikeloom.llm import shingles as S
from spikeloom.llm.common import table
from spikeloom.llm.neardup import content_key, packed_forms
from spikeloom.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Repeats:
    window: int = 35            # words of a window
    anchor: int = 8             # words of an anchor gram
    hot: int = 2_000            # distinct segments from which an anchor's windows are counted one by one
    shard_words: int = 400_000  # words a shard indexes, about


# ---------------------------------------------------------------- runs

def smallest(values: np.ndarray, w: int) -> np.ndarray:
    """Position of the leftmost smallest value in each w consecutive values (by their upper 40 bits)."""
    low = np.uint64((1 << 24) - 1)
    at = np.arange(len(values), dtype=np.uint64)
    x = (values & ~low) | (at & low)
    n = len(values) - w + 1
    span = 1
    while 2 * span <= w:
        x = np.minimum(x[: len(x) - span], x[span:])
        span *= 2
    x = np.minimum(x[:n], x[w - span:w - span + n])
    start = np.arange(n, dtype=np.uint64)
    return (start + (((x & low) - start) & low)).astype(np.int64)


def text_runs(h: np.ndarray, p: Repeats):
    """anchor hash, segment hash, first window, number of windows of each run of one text."""
    if len(h) < p.window:
        z = np.zeros(0, np.int64)
        return z, z, z.astype(np.int32), z.astype(np.int32)
    g = S.gram_hashes(h, p.anchor)
    m = smallest(g, p.window - p.anchor + 1)
    first = np.flatnonzero(np.append(True, m[1:] != m[:-1]))
    count = np.diff(np.append(first, len(m)))
    # a segment's hash: a polynomial over its words, from prefix sums
    up, down = S.powers(len(h) + 1)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[: len(h)], out=sums[1:])
    end = first + count + p.window - 1
    seg = S.mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64))
    return g[m[first]].view(np.int64), seg.view(np.int64), first.astype(np.int32), count.astype(np.int32)


def _run_task(p: Repeats):
    def run(batches):
        tables: dict = {}
        for b in S.pieces(batches):
            forms = [S.normal(t, lower=False) for t in b.column("text").to_pylist()]
            keys = [content_key(f) for f in forms]
            shas = [hashlib.sha256(f).hexdigest() for f in forms]
            n_words = [f.count(b" ") + 1 if f else 0 for f in forms]
            parts: list = [[], [], [], []]
            lengths = []
            for lo, hi in S.blocks(map(len, forms)):
                h = S.word_hashes(b" ".join([f for f in forms[lo:hi] if f]), tables)
                at = 0
                for n in n_words[lo:hi]:
                    got = text_runs(h[at:at + n], p)
                    at += n
                    lengths.append(len(got[0]))
                    for x, y in zip(parts, got):
                        x.append(y)
            offsets = pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x) if x else np.zeros(0, t), pa.from_numpy_dtype(t)))
                     for x, t in zip(parts, (np.int64, np.int64, np.int32, np.int32))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                 pa.array(n_words, pa.int64()), pa.array(shas, pa.string()), *lists],
                ["doc_id", "k1", "k2", "n_words", "sha", "anchors", "segs", "firsts", "counts"])
    return run


# ---------------------------------------------------------------- FM-index

class FMIndex:
    """Word-level FM-index: wavelet matrix over the BWT, one bit vector with block ranks per level."""

    def __init__(self, text: np.ndarray):
        """``text``: symbols >= 1; a terminator 0 is added."""
        t = np.append(text, 0)
        self.n = n = len(t)
        order = suffix_order(t)
        bwt = t[order - 1]
        sigma = int(t.max()) + 1
        self.less = np.append(0, np.cumsum(np.bincount(t, minlength=sigma)))[:sigma]
        self.levels = []
        x = bwt
        for bit in range(max(1, (sigma - 1).bit_length()) - 1, -1, -1):
            ones = ((x >> bit) & 1).astype(bool)
            padded = np.zeros((n // 64 + 1) * 64, np.uint8)
            padded[:n] = ones
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            ranks = np.append(0, np.cumsum(np.bitwise_count(packed).astype(np.int64)))[:-1].astype(np.int32)
            self.levels.append((bit, packed, ranks, n - int(ones.sum())))
            x = np.concatenate([x[~ones], x[ones]])
        self.base = self._down(np.arange(sigma), np.zeros(sigma, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, packed, ranks, zeros in self.levels:
            block = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = ranks[block] + np.bitwise_count(packed[block] & mask)
            at = np.where((symbols >> bit) & 1, zeros + ones, at - ones)
        return at

    def extend(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one symbol more on their left."""
        both = self._down(np.concatenate([symbols, symbols]), np.concatenate([lo, hi]))
        shift = self.less[symbols] - self.base[symbols]
        return both[: len(lo)] + shift, both[len(lo):] + shift


def suffix_order(t: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; the last symbol is the only 0."""
    n = len(t)
    rank = np.unique(t, return_inverse=True)[1].astype(np.int64)
    span = 1
    while True:
        second = np.zeros(n, np.int64)
        second[: n - span] = rank[span:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key)
        k = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.append(0, np.cumsum(k[1:] != k[:-1]))
        rank = new
        span *= 2
        if rank[order[-1]] == n - 1 or span >= n:
            return order


def repeated_parts(index: FMIndex, ids: np.ndarray, first: np.ndarray, length: np.ndarray, window: int):
    """(segment, start, end) of the parts of ``window`` words or more that occur twice in the index.
    Matching statistics from the right: a match grows to the left while it occurs twice; where it
    stops, the next end is the last one that a window further left can have."""
    out: list = []
    seg = np.flatnonzero(length >= window)
    end = length[seg].copy()
    at = end.copy()
    lo, hi = np.zeros(len(seg), np.int64), np.full(len(seg), index.n, np.int64)
    while len(seg):
        new_lo, new_hi = index.extend(ids[first[seg] + at - 1], lo, hi)
        grows = new_hi - new_lo >= 2
        lo, hi = np.where(grows, new_lo, 0), np.where(grows, new_hi, index.n)
        at = np.where(grows, at - 1, at)
        stop = ~grows | (at == 0)
        found = stop & (end - at >= window)
        if found.any():
            out.append(np.stack([seg[found], at[found], end[found]]))
        # windows further left start before ``at``, so they end at or before at + window - 1
        end = np.where(stop, np.where(at == 0, 0, np.minimum(end - 1, at + window - 1)), end)
        at = np.where(stop, end, at)
        lo, hi = np.where(stop, 0, lo), np.where(stop, index.n, hi)
        live = end >= window
        seg, end, at, lo, hi = seg[live], end[live], at[live], lo[live], hi[live]
    return np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)


def _shard_task(p: Repeats):
    def run(t: pa.Table) -> pa.Table:
        segs = [s.split(b" ") for s in t.column("words").to_pylist()]
        length = np.array([len(s) for s in segs], np.int64)
        number: dict = {}
        ids = np.array([number.setdefault(w, len(number) + 2) for s in segs for w in s], np.int64)
        first = np.cumsum(length) - length
        # each segment ends with the separator 1
        text = np.insert(ids, first + length, 1) if len(ids) else ids
        found = repeated_parts(FMIndex(text), ids, first, np.where(t.column("single").to_numpy(zero_copy_only=False), length, 0), p.window)
        row, start = t.column("row").to_numpy(), t.column("start").to_numpy()
        return pa.table({"row": pa.array(row[found[0]]), "a": pa.array((start[found[0]] + found[1]).astype(np.int32)),
                         "b": pa.array((start[found[0]] + found[2]).astype(np.int32))})
    return run


def _segment_task(p: Repeats):
    """Cuts the wanted segments out of each text."""
    def run(batches):
        for b in S.pieces(batches):
            out: list = []
            for row, packed, wanted in zip(b.column("row").to_pylist(), b.column("packed").to_pylist(), b.column("wanted").to_pylist()):
                words = zlib.decompress(packed).split(b" ")
                for x in wanted:
                    part = b" ".join(words[x["first"]:x["first"] + x["n"] + p.window - 1])
                    out.append((x["anchor"], row, x["first"], x["single"], part))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
                 pa.array(cols[3], pa.bool_()), pa.array(cols[4], pa.binary())], ["place", "row", "start", "single", "words"])
    return run


def _window_task(p: Repeats):
    """Two hashes of every window of the wanted segments of each text."""
    def run(batches):
        for b in S.pieces(batches):
            out: list = []
            for row, packed, wanted in zip(b.column("row").to_pylist(), b.column("packed").to_pylist(), b.column("wanted").to_pylist()):
                words = zlib.decompress(packed).split(b" ")
                for x in wanted:
                    for s in range(x["first"], x["first"] + x["n"]):
                        key = hashlib.blake2b(b" ".join(words[s:s + p.window]), digest_size=16).digest()
                        out.append((int.from_bytes(key[:8], "big", signed=True), int.from_bytes(key[8:], "big", signed=True), row, s, x["single"]))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.bool_())], ["h1", "h2", "row", "start", "single"])
    return run


def merged(parts: list[dict]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted((x["a"], x["b"]) for x in parts):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _merge_task():
    def run(batches):
        for b in S.pieces(batches):
            spans = [merged(x) for x in b.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array([sum(y - x for x, y in s) for s in spans], pa.int64()),
                 pa.array([[z for s in one for z in s] for one in spans], pa.list_(pa.int32()))], ["row", "n_removed", "spans"])
    return run


def _kept_task():
    def run(batches):
        for b in S.pieces(batches):
            out = []
            for packed, spans in zip(b.column("packed").to_pylist(), b.column("spans").to_pylist()):
                words = zlib.decompress(packed).split(b" ")
                for i in range(len(spans) - 2, -1, -2):
                    del words[spans[i]:spans[i + 1]]
                out.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc_id", "n_words", "n_removed", "spans")],
                                              pa.array(out, pa.string())], ["doc_id", "n_words", "n_removed", "spans", "kept_sha256"])
    return run


# ---------------------------------------------------------------- the operator

def repeated_spans(rows: DataFrame, source: DataFrame, p: Repeats) -> DataFrame:
    """(row, a, b): word intervals whose windows of ``p.window`` words occur elsewhere too. Rows with
    no such interval are absent; intervals of a row may overlap."""
    counts = rows.select(F.explode("anchors").alias("anchor")).groupBy("anchor").agg(F.count(F.lit(1)).alias("c"))
    # stored, so the join below has plain shuffles on both sides and a hot anchor's runs can be split
    repeated = stored(counts.where("c > 1").select("anchor"))
    runs = rows.select("row", F.explode(F.arrays_zip("anchors", "segs", "firsts", "counts")).alias("r")).select(
        F.col("r.anchors").alias("anchor"), F.col("r.segs").alias("seg"), "row",
        F.col("r.firsts").alias("first"), F.col("r.counts").alias("n"))
    runs = stored(runs.join(repeated, "anchor"))
    segs = stored(runs.groupBy("anchor", "seg", "n").agg(
        F.count(F.lit(1)).alias("c"), F.min(F.struct("row", "first")).alias("at")))
    whole = runs.join(segs.where("c > 1").select("anchor", "seg", "n"), ["anchor", "seg", "n"]).select(
        "row", F.col("first").alias("a"), (F.col("first") + F.col("n") + p.window - 1).alias("b"))
    # single segments are searched among all distinct segments of their anchor
    groups = segs.groupBy("anchor").agg(F.min("c").alias("least"), F.count(F.lit(1)).alias("k"))
    groups = stored(groups.where("least = 1 AND k > 1").select("anchor", (F.col("k") > p.hot).alias("hot")))
    wanted = segs.join(groups, "anchor").select(
        F.col("at.row").alias("row"), F.struct("anchor", F.col("at.first").alias("first"), "n", "hot",
                                               (F.col("c") == 1).alias("single")).alias("w"))
    wanted = stored(wanted.groupBy("row").agg(F.collect_list("w").alias("wanted")))
    total, any_hot = wanted.select(F.explode("wanted").alias("w")).agg(
        F.sum(F.when(~F.col("w.hot"), F.col("w.n") + p.window - 1)), F.max("w.hot")).first()
    shards = max(1, -(-int(total or 0) // p.shard_words))

    def texts(hot: bool) -> DataFrame:
        some = wanted.withColumn("wanted", F.filter("wanted", lambda x: x["hot"] == F.lit(hot))).where(F.size("wanted") > 0)
        keyed = some.join(rows.select("row", "k1", "k2"), "row")
        return keyed.join(packed_forms(source.select("text"), lower=False), ["k1", "k2"]).select("row", "packed", "wanted")
    cut_out = texts(False).mapInArrow(_segment_task(p), "place long, row long, start int, single boolean, words binary")
    found = cut_out.groupBy(F.pmod(F.xxhash64("place"), F.lit(shards)).alias("shard")).applyInArrow(
        _shard_task(p), "row long, a int, b int")
    if any_hot:
        # both stored, so a window of very many rows can be split in the join
        windows = stored(texts(True).mapInArrow(_window_task(p), "h1 long, h2 long, row long, start int, single boolean"))
        twice = stored(windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h1", "h2"))
        found = found.union(windows.where("single").join(twice, ["h1", "h2"]).select(
            "row", F.col("start").alias("a"), (F.col("start") + p.window).alias("b")))
    return whole.union(found)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Repeats = Repeats()) -> DataFrame:
    """doc_id, n_words, n_removed, spans (flat list of removed word intervals), kept_sha256."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    rows = source.mapInArrow(_run_task(p), f"doc_id {id_type}, k1 long, k2 long, n_words long, sha string, anchors array<long>, "
                             "segs array<long>, firsts array<int>, counts array<int>")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()))
    spans = repeated_spans(rows.select("row", "k1", "k2", "anchors", "segs", "firsts", "counts"), source, p)
    per_row = spans.groupBy("row").agg(F.collect_list(F.struct("a", "b")).alias("parts")).mapInArrow(
        _merge_task(), "row long, n_removed long, spans array<int>")
    plain = rows.select("row", "doc_id", "k1", "k2", "n_words", "sha").join(per_row, "row", "left")
    plain = stored(plain.withColumn("n_removed", F.coalesce("n_removed", F.lit(0).cast("long"))))
    # texts kept or removed as a whole need no look at their words any more
    ends = plain.where("n_removed = 0 OR n_removed = n_words").select(
        "doc_id", "n_words", "n_removed", "spans",
        F.when(F.col("n_removed") == 0, F.col("sha")).otherwise(F.sha2(F.lit(""), 256)).alias("kept_sha256"))
    # equal texts that hold a window are removed as a whole, so the others have a key of their own
    some = plain.where("n_removed > 0 AND n_removed < n_words").join(packed_forms(source.select("text"), lower=False), ["k1", "k2"])
    some = some.select("doc_id", "n_words", "n_removed", "spans", "packed").mapInArrow(
        _kept_task(), f"doc_id {id_type}, n_words long, n_removed long, spans array<int>, kept_sha256 string")
    return ends.unionByName(some)


def op5(spark, sf_dir):
    out = remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


OP5_SQL = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT rid, unnest(list_transform(range(1, len(w) - 33), lambda i: {'i': i, 'g': md5(array_to_string(w[i:i + 34], ' '))})) AS x FROM d WHERE len(w) >= 35),
g AS (SELECT rid, x.i AS i, count(*) OVER (PARTITION BY x.g) AS c FROM win),
cov AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS p FROM g WHERE c > 1),
rem AS (SELECT rid, list(p) AS ps, count(*) AS n FROM cov GROUP BY rid),
words AS (SELECT rid, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN cov USING (rid, p) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(rem.n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN rem USING (rid) LEFT JOIN kept USING (rid)"""
