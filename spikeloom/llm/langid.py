"""Language identification (operator 13): prediction by partial matching over bytes.

Every language has a context tree of variable order: the counts of each byte after each context of 0 to
``order`` bytes. The code length of a text under a language is the sum over its bytes of the bits the tree
asks for (method C): a byte seen n times after a context that was followed N times by D different bytes
costs log2((N + D) / n); one not seen there costs the escape log2((N + D) / D) and is asked again one byte
of context shorter; an unknown context costs nothing; below order 0 a byte costs 8 bits. Statistics are
frozen before the first text is scored. Costs are rounded once to 1/4096 bit, so sums are exact and do
not depend on how rows are dealt. The language of the shortest code wins (ties: first by name); its score
is its share of the sum of 2^-length over all languages.

Counting covers all labelled texts: tasks count windows of order + 1 bytes by arrays, sums meet in a
shuffle, shorter contexts are sums of longer ones. The trees keep about the ``grams`` most frequent windows in
all, as many per language, for the ``languages`` with most rows: these two parameters bound what
is broadcast. Costs of all languages for a window stand in one row of a hash table, so a byte is looked
up once for all languages.

Texts are lower-cased; all ASCII but letters is one space; before a text stand spaces.
Defined results: a null text and one without a letter are ``und`` with score 0, as is everything if nothing
is labelled; rows with a null language or a null text teach nothing; a null id is not held out; repeated
rows teach and are predicted one by one; extra columns are dropped.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spikeloom.llm import shingles as S
from spikeloom.llm.common import table
from spikeloom.llm.lookup import HashTable
from spikeloom.llm.tokens import WIDE, text_bytes
from spikeloom.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNIT = 4096                 # a bit, in units of cost
BLOCK = 1 << 20             # bytes of text worked on at a time
HELD = 400_000              # counts a task holds before it passes them on
# what a byte stands for: letters and bytes beyond ASCII for themselves, the rest for a space
STANDS = np.full(256, 32, np.uint8)
STANDS[97:123] = np.arange(97, 123)
STANDS[65:91] = np.arange(97, 123)
STANDS[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class Trees:
    order: int = 4          # bytes of the longest context, up to 7
    grams: int = 262_144    # windows kept over all languages
    languages: int = 64     # languages learned, those with most rows


def windows(data: np.ndarray, at: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The window of each byte of some texts (its context and itself, context in the low bytes), and how
    many bytes each text has. ``at``: where texts start, and the end."""
    x = STANDS[data]
    drop = x == 32
    # a space after a space goes; before a text stand spaces
    drop[1:] &= x[:-1] == 32
    first = at[:-1][at[:-1] < at[1:]]
    drop[first] = x[first] == 32
    place = np.flatnonzero(~drop)
    many = np.diff(np.searchsorted(place, at))
    out = np.full(len(place) + order * len(many) + 8, 32, np.uint8)
    q = np.arange(len(place)) + order * (np.repeat(np.arange(len(many)), many) + 1)
    out[q] = x[place]
    view = np.ndarray((len(out) - 7,), "<u8", out, strides=(1,))
    return view[q - order] & np.uint64((1 << 8 * (order + 1)) - 1), many


def text_windows(col: pa.Array, order: int):
    """(first row, windows, bytes per text) for some texts of a column without nulls at a time."""
    data, at = text_bytes(col)
    for lo, hi in S.blocks(np.diff(at).tolist(), BLOCK):
        grams, many = windows(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo], order)
        yield lo, grams, many


def _count_task(order: int):
    """Arrow task over (lang, text): counts of the windows of each language."""
    def run(batches):
        held: dict = {}
        total = 0

        def out():
            for lang, parts in held.items():
                gram, back = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                n = np.bincount(back, np.concatenate([n for _, n in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)),
                                                  pa.array(n)], ["lang", "gram", "n"])
            held.clear()
        for b in batches:
            langs = b.column(0).to_pylist()
            for lo, grams, many in text_windows(b.column(1), order):
                own = np.repeat(np.arange(len(many)), many)
                names = langs[lo:lo + len(many)]
                for lang in set(names):
                    mine = np.array([x == lang for x in names])
                    g, n = np.unique(grams[mine[own]], return_counts=True)
                    held.setdefault(lang, []).append((g, n))
                    total += len(g)
                if total > HELD:
                    yield from out()
                    total = 0
        yield from out()
    return run


class Model:
    """Frozen costs. ``seen[k]`` and ``rows[k]``: table and costs per language of the windows of k bytes
    of context; ``known[k]`` and ``escapes[k]``: the same for contexts of k bytes."""

    def __init__(self, languages: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int):
        self.languages, self.order = languages, order
        self.seen, self.rows, self.known, self.escapes = [], [], [], []
        below = None
        for k in range(order + 1 if languages else 0):
            per = []
            for lang in languages:
                g, n = counts[lang]
                key, back = np.unique(g >> np.uint64(8 * (order - k)), return_inverse=True)
                per.append((key, np.bincount(back, n)))
            contexts = [np.unique(key & np.uint64((1 << 8 * k) - 1), return_inverse=True) for key, _ in per]
            every, known = (np.unique(np.concatenate(x)) for x in ([p[0] for p in per], [c[0] for c in contexts]))
            # where nothing is seen: the escape, then the cost one order below
            escape = np.zeros((len(known), len(languages)), np.int32)
            if k:
                cost = below.take(every >> np.uint64(8))
            else:
                cost = np.full((len(every), len(languages)), 8 * UNIT, np.int32)
            place = np.searchsorted(known, every & np.uint64((1 << 8 * k) - 1))
            for i, ((key, n), (context, back)) in enumerate(zip(per, contexts)):
                total, kinds = np.bincount(back, n), np.bincount(back)
                escape[np.searchsorted(known, context), i] = np.rint(UNIT * np.log2((total + kinds) / kinds))
                cost[:, i] += escape[place, i]
                cost[np.searchsorted(every, key), i] = np.rint(UNIT * np.log2((total + kinds)[back] / n))
            self.seen.append(HashTable(S.mix(every)))
            self.rows.append(cost)
            self.known.append(HashTable(S.mix(known)))
            self.escapes.append(escape)
            below = _Rows(every, cost)

    def costs(self, grams: np.ndarray) -> np.ndarray:
        """Costs of windows, one column per language."""
        out = np.zeros((len(grams), len(self.languages)), np.int32)
        left = np.arange(len(grams))
        for k in range(self.order, -1, -1):
            row = self.seen[k].find(S.mix(grams))
            hit = row >= 0
            if hit.all() and k == self.order:
                return self.rows[k][row]
            out[left[hit]] += self.rows[k][row[hit]]
            left, grams = left[~hit], grams[~hit]
            if not len(left):
                return out
            row = self.known[k].find(S.mix(grams & np.uint64((1 << 8 * k) - 1)))
            some = row >= 0
            out[left[some]] += self.escapes[k][row[some]]
            grams = grams >> np.uint64(8)
        out[left] += 8 * UNIT
        return out

    def lengths(self, grams: np.ndarray, many: np.ndarray) -> np.ndarray:
        """Code lengths of texts in units of cost, one column per language."""
        out = np.zeros((len(many), len(self.languages)), np.int64)
        step = max(1 << 14, (1 << 22) // max(1, len(self.languages)))
        ends = np.cumsum(many)
        for lo in range(0, len(grams), step):
            hi = min(len(grams), lo + step)
            c = self.costs(grams[lo:hi])
            a, b = np.searchsorted(ends, [lo, hi - 1], "right")
            rows = np.arange(a, b + 1)[many[a:b + 1] > 0]
            firsts = np.maximum(ends[rows] - many[rows], lo) - lo
            for i in range(c.shape[1]):
                out[rows, i] += np.add.reduceat(c[:, i], firsts, dtype=np.int64)
        return out


class _Rows:
    """Cost rows by sorted keys."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        self.keys, self.rows = keys, rows

    def take(self, keys: np.ndarray) -> np.ndarray:
        return self.rows[np.searchsorted(self.keys, keys)].copy()


def learn(labelled: DataFrame, p: Trees = Trees(), text_col: str = "text", lang_col: str = "lang") -> Model:
    """Context trees of the languages of ``labelled`` texts."""
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.lower(F.col(text_col)).alias("text"))
    rows = rows.where("lang is not null and text is not null")
    top = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(p.languages)
    languages = sorted(r["lang"] for r in top.collect())
    if not languages:
        return Model([], {}, p.order)
    counts = rows.where(F.col("lang").isin(languages)).mapInArrow(_count_task(p.order), "lang string, gram long, n long")
    counts = stored(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    # the most frequent of each language by a histogram of counts; of the count that does not fit whole,
    # the share by a hash that fits
    most = max(1, p.grams // len(languages))
    order = Window.partitionBy("lang").orderBy(F.desc("n"))
    hist = counts.groupBy("lang", "n").agg(F.count(F.lit(1)).alias("c")).withColumn("upto", F.sum("c").over(order))
    room = F.greatest(F.lit(0), F.least(F.col("c"), most - F.col("upto") + F.col("c"))) / F.col("c")
    hist = hist.select("lang", "n", room.alias("room")).where("room > 0")
    part = F.pmod(F.xxhash64("gram"), F.lit(1 << 20)) < F.col("room") * (1 << 20)
    found = counts.join(hist, ["lang", "n"]).where(part).select("lang", "gram", "n").toArrow()
    names, grams, n = found.column("lang").to_numpy(), found.column("gram").to_numpy(), found.column("n").to_numpy()
    return Model(languages, {x: (grams[names == x].view(np.uint64), n[names == x]) for x in languages}, p.order)


def _score_task(shared):
    """Arrow task: appends lang_pred and score; the text is the last column and goes (null: not to be scored)."""
    def run(batches):
        model = shared.value
        names = np.array([*model.languages, "und"], object)
        for b in batches:
            text = b.column(b.num_columns - 1)
            pred, score = np.full(b.num_rows, len(names) - 1), np.zeros(b.num_rows)
            asked = np.flatnonzero(text.is_valid().to_numpy(zero_copy_only=False)) if model.languages else []
            if len(asked):
                for lo, grams, many in text_windows(text.drop_null(), model.order):
                    n = model.lengths(grams, many)
                    best = n.argmin(axis=1)
                    more = (n - n[np.arange(len(n)), best][:, None]) / UNIT
                    at = asked[lo:lo + len(many)]
                    pred[at], score[at] = best, 1 / np.exp2(-more).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(names[pred], pa.string()), pa.array(score)],
                                             [*b.schema.names[:-1], "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Model, carry: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns to carry, lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = F.col(text_col)
    plain = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    rows = docs.select(*plain, F.when(text.rlike(r"\p{L}"), F.lower(text)).alias("text"))
    schema = rows.drop("text").withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema
    return rows.mapInArrow(_score_task(shared), schema).toDF(*carry, "lang_pred", "score")


def held_out(id_col: str = "doc_id") -> Column:
    """A third of the rows, by their id, that teach nothing."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op13(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", held_out())
    return predict(docs, learn(docs.where(~F.col("held_out"))), carry=("doc_id", "held_out"))
