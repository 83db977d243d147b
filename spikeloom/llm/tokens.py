"""Token counts (operator 3): map-side two-tier lookup of pre-token lengths.

A byte-level BPE encodes each pre-token by itself. Texts are cut, vectorised over their UTF-8 bytes, where
the pattern is sure to part two pre-tokens: before white space that follows anything else, where ASCII
or Latin-1 letters, digits and punctuation meet, and after a single line end. A place that is not sure
(an apostrophe, another script) is not cut, which is always right: a unit then holds several pre-tokens
and is encoded whole. A text has the sum of its units' counts.

Tier one is a compact hash table of the corpus's most frequent units (counted over all documents: every
task keeps a bounded summary, only the summaries meet), encoded once and broadcast; ``table_size``
bounds it. Tier two is a cache of fixed size in every Python worker; what neither holds is encoded by
the library. Both compare all bytes of a unit (up to ``WIDE``; longer ones go to the library), so a result
never depends on them. Units are never shuffled.

Texts that hold one of the tokenizer's special strings are encoded whole by the library, which treats
the string by its default. A tokenizer file with a normalizer or another pre-tokenizer than the plain
byte-level one is refused. Defined results: a null text is empty (0 bytes, 0 tokens); extra columns pass
through (those named like an output are replaced); repeated rows are counted one by one.
"""

from __future__ import annotations

import json
import re
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spikeloom.llm import shingles as S
from spikeloom.llm.common import named, table, text_of
from spikeloom.llm.lookup import HashTable
from spikeloom.session import stored

# Spark ships these functions with their code, so workers need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKENIZER = "byte_bpe_50k.json"
TABLE_SIZE = 131_072        # units of the broadcast table: some 12 MB
SUMMARY_SIZE = 131_072      # units a task reports at most
WATCHED = 262_144           # units a task counts at a time
CACHE_BITS = 17             # slots of a worker's cache, as a power of two: 5 MB
WIDE = 32                   # bytes of a unit that tables hold
SECTION = 1 << 20           # bytes cut into units at a time

# classes of bytes: 1 letter, 2 digit, 3 punctuation, 4 apostrophe, 5 white space, 6 other control, 0 not sure
CLASS = np.zeros(256, np.uint8)
CLASS[33:127] = 3
CLASS[[*range(65, 91), *range(97, 123)]] = 1
CLASS[48:58] = 2
CLASS[39] = 4
CLASS[[*range(9, 14), 32]] = 5
CLASS[28:32] = 6
# pairs of classes (8 * before + after) between which a pre-token ends
CUT = np.zeros(64, bool)
for _before, _after in ("05", "15", "25", "35", "45", "12", "13", "14", "21", "23", "24", "31", "32"):
    CUT[8 * int(_before) + int(_after)] = True
KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
# units that are one pre-token for sure: letters with or without a space before
SINGLE = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+").fullmatch


def marks(x: np.ndarray) -> np.ndarray:
    """Whether a pre-token is sure to start at each byte, the first left out."""
    c = CLASS[x]
    lead = np.flatnonzero(x[:-1] == 0xC3)       # Latin-1 letters but the signs of times and division
    lead = lead[(x[lead + 1] | 0x20) != 0xB7]
    c[lead] = c[lead + 1] = 1
    out = np.zeros(len(x), bool)
    out[1:] = CUT[c[:-1] * 8 + c[1:]]
    # after other characters than ASCII: not if they may be white space themselves
    odd = np.flatnonzero(out[1:] & (c[:-1] == 0)) + 1
    if len(odd):
        one, two, three = x[odd - 1], x[odd - 2], x[odd - 3]
        white = (two == 0xC2) & ((one == 0x85) | (one == 0xA0)) | (three >= 0xE1) & (three <= 0xE3)
        out[odd[white | (one < 0x80)]] = False
    line = np.flatnonzero(out & (x == 10))
    line = line[line + 1 < len(x)]
    after = c[line + 1]
    out[line[(after >= 1) & (after <= 4)] + 1] = True
    return out


def units(data: np.ndarray, firsts: np.ndarray):
    """Units of the bytes of many texts as arrays (starts, ends), a section at a time; ``firsts`` are the
    places where texts start. A unit longer than a section is one section."""
    lo, n = 0, len(data)
    while lo < n:
        wide = SECTION
        while True:
            hi = min(n, lo + wide)
            back = min(3, lo)                   # what stands before decides about the first places
            m = marks(data[lo - back:hi])[back:]
            a, b = np.searchsorted(firsts, [lo, hi])
            m[firsts[a:b] - lo] = True
            m[0] = True
            starts = np.flatnonzero(m) + lo
            if hi == n or len(starts) > 2:
                break
            wide *= 2
        if hi < n:                              # the last two may go on, or turn out otherwise
            hi, starts = starts[-2], starts[:-2]
        yield starts, np.append(starts[1:], hi)
        lo = int(hi)


def keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Hash, up to WIDE bytes as four words, and length of each unit; ``data`` has WIDE bytes more."""
    view = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    size = ends - starts
    words = [view[starts] & KEEP[np.minimum(size, 8)], view[starts + 8] & KEEP[np.clip(size - 8, 0, 8)]]
    h = words[0] * np.uint64(0x9E3779B97F4A7C15) + words[1] * np.uint64(0xD6E8FEB86659FD93) + size.astype(np.uint64)
    long = np.flatnonzero(size > 16)
    for i in (2, 3):
        w = np.zeros(len(starts), np.uint64)
        w[long] = view[starts[long] + 8 * i] & KEEP[np.clip(size[long] - 8 * i, 0, 8)]
        h[long] += w[long] * np.uint64(0xA0761D6478BD642F + 2 * i)
        words.append(w)
    return S.mix(h), words, size


class Lengths:
    """Tier one: token counts of given units."""

    def __init__(self, known: list[bytes], counts: list[int]):
        blob = np.frombuffer(b"".join(known) + bytes(WIDE), np.uint8)
        ends = np.cumsum([len(k) for k in known], dtype=np.int64)
        starts = np.append(0, ends)[:-1]
        h, self.words, self.size = keys(blob, starts, ends)
        self.table, self.size, self.counts = HashTable(h), self.size.astype(np.int16), np.array(counts, np.int32)

    def find(self, h, words, size) -> np.ndarray:
        """Counts of the units, -1 where unknown."""
        if not len(self.size):
            return np.full(len(h), -1, np.int64)
        row = self.table.find(h)
        same = (row >= 0) & (self.size[row] == size)
        for a, b in zip(self.words, words):
            same &= a[row] == b
        return np.where(same, self.counts[row], -1).astype(np.int64)


class Cache:
    """Tier two: the last unit of each slot with its count."""

    def __init__(self, bits: int = CACHE_BITS):
        self.shift = np.uint64(64 - bits)
        self.words = [np.zeros(1 << bits, np.uint64) for _ in range(WIDE // 8)]
        self.size, self.counts = np.zeros(1 << bits, np.int16), np.zeros(1 << bits, np.int32)

    def find(self, h, words, size) -> np.ndarray:
        at = (h >> self.shift).astype(np.int64)
        same = (self.size[at] == size) & (size <= WIDE)
        for a, b in zip(self.words, words):
            same &= a[at] == b
        return np.where(same, self.counts[at], -1).astype(np.int64)

    def put(self, h, words, size, counts) -> None:
        # one unit a slot, so that its words and its count belong together
        ok = np.flatnonzero(size <= WIDE)
        at, first = np.unique((h[ok] >> self.shift).astype(np.int64), return_index=True)
        ok = ok[first]
        for a, b in zip(self.words, words):
            a[at] = b[ok]
        self.size[at], self.counts[at] = size[ok], counts[ok]


def load(path: str):
    """The tokenizer and its special strings; refuses files whose texts are not cut as assumed here."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    spec = json.loads(tokenizer.to_str())
    pre = spec["pre_tokenizer"] or {}
    if spec["normalizer"] is not None or pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space"):
        raise ValueError(f"{path}: not a plain byte-level tokenizer")
    if any(t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        raise ValueError(f"{path}: a special string takes white space beside it")
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, [t["content"] for t in spec["added_tokens"]]


def _worker(path: str):
    """Tokenizer, special strings and cache of this worker, made once."""
    home = sys.modules.setdefault("_spikeloom_token_worker", types.ModuleType("_spikeloom_token_worker"))
    if getattr(home, "path", None) != path:
        home.tokenizer, home.special = load(path)
        home.cache = Cache()
        home.path = path
    return home


def byte_chars() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for
    themselves, the rest in order from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _lengths(tokenizer, blobs: list[bytes]) -> np.ndarray:
    """Token counts by the library; single pre-tokens go to its merge model without its pipeline."""
    out = np.zeros(len(blobs), np.int64)
    chars, merge, rest = byte_chars(), tokenizer.model.tokenize, []
    for i, b in enumerate(blobs):
        if SINGLE(b):
            out[i] = len(merge(b.decode("latin-1").translate(chars)))
        else:
            rest.append(i)
    for lo in range(0, len(rest), 2048):
        part = rest[lo:lo + 2048]
        out[part] = [len(e) for e in tokenizer.encode_batch_fast([blobs[i].decode() for i in part], add_special_tokens=False)]
    return out


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of strings without nulls, with WIDE zeros after them, and where texts start
    and end (one more than rows)."""
    if not len(col):
        return np.zeros(WIDE, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    at = np.frombuffer(offsets, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    out = np.zeros(at[-1] - at[0] + WIDE, np.uint8)
    if at[-1] > at[0]:
        out[:-WIDE] = np.frombuffer(data, np.uint8)[at[0]:at[-1]]
    return out, at - at[0]


class Counts:
    """Counts of the most frequent units of a task, in bounded memory: what is known is counted by its
    row, the rest waits and is merged in now and then."""

    def __init__(self):
        self.held = [np.zeros(0, np.uint64) for _ in range(1 + WIDE // 8)] + [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.wait, self.waiting, self.table = [], 0, HashTable(self.held[0])

    def add(self, h, words, size) -> None:
        row = self.table.find(h)
        known = row >= 0
        if known.any():
            self.held[-1] += np.bincount(row[known], minlength=len(self.held[-1]))
        new = np.flatnonzero(~known & (size <= WIDE))
        if len(new):
            one, first, n = np.unique(h[new], return_index=True, return_counts=True)
            first = new[first]
            self.wait.append([one, *[w[first] for w in words], size[first], n])
            self.waiting += len(one)
        if self.waiting > WATCHED:
            self.merge()

    def merge(self) -> None:
        every = [np.concatenate(c) for c in zip(self.held, *self.wait)]
        total, first, back = np.unique(every[0], return_index=True, return_inverse=True)
        held = [total, *[c[first] for c in every[1:-1]], np.bincount(back, every[-1], len(total)).astype(np.int64)]
        if len(total) > WATCHED:
            top = np.argpartition(-held[-1], WATCHED)[:WATCHED]
            held = [c[top] for c in held]
        self.held, self.wait, self.waiting, self.table = held, [], 0, HashTable(held[0])

    def top(self, n: int) -> tuple[list[bytes], list[int]]:
        self.merge()
        best = np.argsort(-self.held[-1], kind="stable")[:n]
        rows = np.stack([c[best] for c in self.held[1:1 + WIDE // 8]], axis=1).astype("<u8").tobytes()
        return ([rows[i * WIDE:i * WIDE + s] for i, s in enumerate(self.held[-2][best].tolist())],
                self.held[-1][best].tolist())


def _summaries():
    """Arrow task: the most frequent units of the task's texts with their counts."""
    def run(batches):
        seen = Counts()
        for b in batches:
            data, at = text_bytes(b.column(0))
            for starts, ends in units(data[:-WIDE], at[:-1][at[:-1] < at[1:]]):
                seen.add(*keys(data, starts, ends))
        found, many = seen.top(SUMMARY_SIZE)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(many, pa.int64())], ["unit", "n"])
    return run


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text", table_size: int = TABLE_SIZE) -> Lengths:
    """Token counts of the most frequent units of all documents, at most ``table_size`` (those of a count that
    does not fit whole are left out). The only rows shuffled are
    the tasks' bounded summaries; the result is bounded by the parameter."""
    found = docs.select(text_of(text_col).alias("t")).mapInArrow(_summaries(), "unit binary, n long")
    counts = stored(found.groupBy("unit").agg(F.sum("n").alias("n")))
    # the least count that fits, from one row per count: no sort of the units, and only those kept reach the driver
    hist = counts.groupBy("n").agg(F.count(F.lit(1)).alias("c"))
    hist = hist.withColumn("upto", F.sum("c").over(Window.partitionBy(F.lit(0)).orderBy(F.desc("n"))))
    least = hist.where(F.col("upto") <= table_size).agg(F.min("n")).first()[0]
    known = counts.where(F.col("n") >= F.lit(least)).select("unit").toArrow().column("unit").to_pylist()
    return Lengths(known, _lengths(load(path)[0], known).tolist())


def _count(w, known: Lengths, col: pa.Array) -> np.ndarray:
    """Tokens of each text of a column without nulls."""
    data, at = text_bytes(col)
    full = np.flatnonzero(at[1:] > at[:-1])
    out = np.zeros(len(col), np.int64)
    for starts, ends in units(data[:-WIDE], at[full]):
        h, words, size = keys(data, starts, ends)
        n = known.find(h, words, size)
        miss = np.flatnonzero(n < 0)
        if len(miss):
            h, words, size = h[miss], [x[miss] for x in words], size[miss]
            m = w.cache.find(h, words, size)
            new = np.flatnonzero(m < 0)
            blobs = [data[a:b].tobytes() for a, b in zip(starts[miss[new]].tolist(), ends[miss[new]].tolist())]
            order = {k: i for i, k in enumerate(dict.fromkeys(blobs))}
            m[new] = _lengths(w.tokenizer, list(order))[[order[k] for k in blobs]] if blobs else 0
            w.cache.put(h[new], [x[new] for x in words], size[new], m[new])
            n[miss] = m
        own = full[np.searchsorted(at[full], starts, "right") - 1]
        out[own[0]:own[-1] + 1] += np.bincount(own - own[0], n).astype(np.int64)
    raw = data.tobytes() if any(len(s) for s in w.special) else b""
    whole = set()
    for s in w.special:
        p = raw.find(s.encode())
        while p >= 0:
            whole.add(int(full[np.searchsorted(at[full], p, "right") - 1]))
            p = raw.find(s.encode(), p + 1)
    for i in whole:
        out[i] = len(w.tokenizer.encode(col[i].as_py(), add_special_tokens=False))
    return out


def _counter(path: str, shared):
    """Arrow task: appends n_tokens to each batch; the text is its last column and goes."""
    def run(batches):
        w, known = _worker(path), shared.value
        for b in batches:
            out = _count(w, known, b.column(b.num_columns - 1))
            cols = [*b.columns[:-1], pa.array(out, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, [*b.schema.names[:-1], "n_tokens"])
    return run


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", table_size: int = TABLE_SIZE) -> DataFrame:
    """All columns but the text, n_bytes and n_tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text_col, table_size))
    rest = [c for c in docs.columns if c not in (text_col, "n_bytes", "n_tokens")]
    t = text_of(text_col)
    # plain names on the way through Arrow: it takes no dots
    plain = [c.alias(f"c{i}") for i, c in enumerate(named(rest))]
    rows = docs.select(*plain, F.octet_length(t).cast("long").alias("n_bytes"), t.alias("text"))
    schema = rows.drop("text").withColumn("n_tokens", F.lit(0).cast("long")).schema
    return rows.mapInArrow(_counter(path, shared), schema).toDF(*rest, "n_bytes", "n_tokens")


def op3(spark, sf_dir, path: str | None = None):
    import public_tokenizers
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = count_tokens(docs, path or public_tokenizers.path(TOKENIZER))
    return out.withColumn("over_limit", F.col("n_tokens") > 1024)
