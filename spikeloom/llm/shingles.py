"""Numpy helpers used inside Arrow tasks: words and shingles of many texts at once.

Texts are normal forms: lower-case or not, their words joined by one space, as UTF-8 bytes.
Everything works on blocks of a few MB, so memory follows the block, not the partition.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Spark ships these functions with their code, so workers need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 2 << 20
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def normal(text: str | None, lower: bool = True) -> bytes:
    """Words (runs of anything but space and bytes 9-13) joined by one space; A-Z lower-cased."""
    raw = (text or "").encode()
    return b" ".join((raw.lower() if lower else raw).split())


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (BASE, INVERSE):
        p = np.full(n, base, np.uint64)
        p[:1] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def word_hashes(blob: bytes, tables: dict) -> np.ndarray:
    """A hash of each word of a normal form (empty: no words). ``tables`` keeps powers between calls."""
    if not blob:
        return np.zeros(0, np.uint64)
    a = np.frombuffer(blob, np.uint8)
    parts, at = [], 0
    while at < len(blob):
        end = len(blob)
        if end - at > BLOCK:
            cut = blob.rfind(b" ", at, at + BLOCK)
            cut = cut if cut > at else blob.find(b" ", at + BLOCK)
            end = cut if cut > at else end
        x = a[at:end]
        if len(tables.get("p", ((),))[0]) < len(x) + 1:
            tables["p"] = powers(max(len(x) + 1, BLOCK // 4))
        up, down = tables["p"]
        spaces = np.flatnonzero(x == 32)
        starts, ends = np.append(0, spaces + 1), np.append(spaces, len(x))
        sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum((x.astype(np.uint64) + np.uint64(1)) * up[: len(x)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * down[starts]
        parts.append(mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        at = end + 1
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive words of one word array (may be empty)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    factor = 1
    for j in range(k):
        out += h[j:j + n] * np.uint64(factor)
        factor = factor * 0x2545F4914F6CDD1D % (1 << 64)
    return mix(out)


def shingle_sets(texts: list[bytes], k: int, tables: dict) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each normal form: (owner index, hash), sorted by both.
    A text of fewer than k words has its whole sequence as one shingle, an empty one none."""
    n_words = np.array([t.count(b" ") + 1 if t else 0 for t in texts], np.int64)
    h = word_hashes(b" ".join([t for t in texts if t]), tables)
    owner = np.repeat(np.arange(len(texts)), n_words)
    first = np.cumsum(n_words) - n_words
    g = gram_hashes(h, k)
    # keep grams that end in the text they start in
    inside = owner[: len(g)] == owner[k - 1:] if len(g) else np.zeros(0, bool)
    own, val = [owner[: len(g)][inside]], [g[inside]]
    for n in range(1, k):
        short = np.flatnonzero(n_words == n)
        if len(short):
            at = first[short]
            acc, factor = np.zeros(len(short), np.uint64), 1
            for j in range(n):
                acc += h[at + j] * np.uint64(factor)
                factor = factor * 0x2545F4914F6CDD1D % (1 << 64)
            own.append(short)
            val.append(mix(acc + np.uint64(n)))
    o, v = np.concatenate(own), np.concatenate(val)
    order = np.lexsort((v, o))
    o, v = o[order], v[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (v[1:] != v[:-1])
    return o[new], v[new]


def pieces(batches, rows: int = 1_000, most: int = 2 * BLOCK):
    """The batches in slices of at most ``rows`` rows and about ``most`` bytes of text: Python objects
    exist for one slice at a time. A longer text is a slice of its own."""
    for b in batches:
        size = np.zeros(b.num_rows, np.int64)
        for c in b.columns:
            if pa.types.is_string(c.type) or pa.types.is_binary(c.type) or pa.types.is_large_string(c.type):
                size += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False)
        for lo, hi in blocks(size.tolist(), most):
            for at in range(lo, hi, rows):
                yield b.slice(at, min(rows, hi - at))


def blocks(sizes, most: int = BLOCK):
    """Ranges of consecutive items of about ``most`` bytes; a longer item is a range of its own."""
    at, total, n = 0, 0, 0
    for n, x in enumerate(sizes, 1):
        if n - 1 > at and total + x > most:
            yield at, n - 1
            at, total = n - 1, 0
        total += x
    if at < n:
        yield at, n
