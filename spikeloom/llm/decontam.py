"""Benchmark decontamination (operator 9): SimHash over item-sized windows.

For a benchmark item of L words, windows of L consecutive words of a document are compared with it
(a document shorter than the item is one window). Shared shingles are summed by weight for every
start of a window, as a running sum over the places where a shingle enters and leaves. A similar
window shares at least ``percent`` of the item's weight, so a window is laid at every start whose sum
reaches that of the lightest item of L words: none that can be similar is left out. Then
  fingerprint  64-bit SimHash of the window's distinct 5-word shingles, each weighing its length
  blocks       a fingerprint is ``blocks`` keys of 12 or 13 bits. Two within the radius differ by
               floor(radius / blocks) bits at most in one block at least (pigeonhole), so an item is entered
               under every key that close to its own, a window looks up its own keys, and none is missed
  verify       weighted Jaccard of the shingle sets, compared as integers, at ``percent`` or more

Windows are laid once per text and equal windows are fingerprinted and verified once, however many
documents hold them. Only DataFrame
operations. The shingles of the benchmark are broadcast in parts of at most ``BROADCAST_ROWS`` rows,
one pass over the documents per part; everything else is a shuffle join.

Defined results: null or empty texts and items match nothing; a null id is kept as null; repeated rows
are one match; items of fewer than five words are one shingle, matched as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spikeloom.llm.common import ascii_lower, cut, table, text_of, unwrapped, words, wrapped
from spikeloom.session import stored

BROADCAST_ROWS = 500_000    # benchmark shingles (24 bytes each) broadcast at a time


@dataclass(frozen=True)
class Leak:
    k: int = 5              # words of a shingle
    percent: int = 75       # least weighted similarity
    radius: int = 19        # most differing fingerprint bits
    blocks: int = 5         # blocks of a fingerprint: 12 or 13 bits each


def _grams(w: Column | str, k: int) -> Column:
    """Texts of all k consecutive words of an array, empty below k words."""
    n = F.size(w)
    return F.when(n >= k, F.transform(F.sequence(F.lit(1), n - (k - 1)), lambda i: F.array_join(F.slice(w, i, k), " "))) \
        .otherwise(F.array().cast("array<string>"))


def _gram_hashes(w: Column | str, k: int) -> Column:
    n = F.size(w)
    return F.when(n >= k, F.transform(F.sequence(F.lit(1), n - (k - 1)), lambda i: F.xxhash64(F.slice(w, i, k)))) \
        .otherwise(F.array().cast("array<bigint>"))


def _shingles(w: str, p: Leak) -> Column:
    """Distinct shingles; the whole sequence for fewer than k words."""
    whole = F.when(F.size(w) > 0, F.array(F.array_join(w, " "))).otherwise(F.array().cast("array<string>"))
    return F.when(F.size(w) >= p.k, F.array_distinct(_grams(w, p.k))).otherwise(whole)


def _weight(shingles: Column | str) -> Column:
    return F.aggregate(shingles, F.lit(0).cast("long"), lambda a, s: a + F.length(s))


def fingerprints(sets: DataFrame, *keys: str) -> DataFrame:
    """Adds fp, the 64-bit SimHash of the column ``shingles``, for rows unique by ``keys``."""
    one = sets.select(*keys, F.explode("shingles").alias("s"))
    one = one.select(*keys, F.xxhash64("s").alias("h"), F.length("s").cast("long").alias("w"))
    votes = one.groupBy(*keys).agg(*[
        F.sum(F.when(F.col("h").bitwiseAND(F.shiftleft(F.lit(1).cast("long"), b)) != 0, F.col("w"))
              .otherwise(-F.col("w"))).alias(f"v{b}") for b in range(64)])
    fp = F.lit(0).cast("long")
    for b in range(64):
        bit = F.when(F.col(f"v{b}") > 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
        fp = fp.bitwiseOR(F.shiftleft(bit, b))
    return sets.join(votes.select(*keys, fp.alias("fp")), list(keys))


def _block(fp: Column, i: int, p: Leak) -> Column:
    lo, hi = (64 * x // p.blocks for x in (i, i + 1))
    return F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("long"))


def block_keys(fp: Column, p: Leak) -> Column:
    """One struct (block number, bits of that block) per block."""
    return F.array(*[F.struct(F.lit(i).alias("no"), _block(fp, i, p).alias("bits")) for i in range(p.blocks)])


def entered(marks: DataFrame, fp: str, p: Leak) -> DataFrame:
    """The rows once for every key (``block``) that differs from one of their own by floor(radius / blocks) bits at
    most: two fingerprints within the radius differ so little in one block at least."""
    flips = []
    for i in range(p.blocks):
        width = 64 * (i + 1) // p.blocks - 64 * i // p.blocks
        flips += [(i, sum(1 << b for b in bits)) for n in range(p.radius // p.blocks + 1) for bits in combinations(range(width), n)]
    # a fixed table, a few hundred rows per block
    flips = marks.sparkSession.createDataFrame(flips, "no int, flip long")
    own = marks.withColumn("__b", F.explode(block_keys(F.col(fp), p)))
    own = own.withColumn("no", F.col("__b.no")).join(F.broadcast(flips), "no")
    return own.withColumn("block", F.struct("no", F.col("__b.bits").bitwiseXOR(F.col("flip")).alias("bits"))).drop("__b", "no", "flip")


def _items(benchmark: DataFrame, p: Leak) -> DataFrame:
    w = benchmark.select("item_id", words(ascii_lower(text_of("text"))).alias("w")).where(F.size("w") > 0)
    return w.withColumn("n", F.size("w")).withColumn("shingles", _shingles("w", p))


def _shared(texts: DataFrame, items: DataFrame, p: Leak) -> DataFrame | None:
    """k1, k2, n, pos, weight: places in a text of shingles that some item of n words has."""
    out = None
    for k in sorted(r[0] for r in items.select(F.least("n", F.lit(p.k))).distinct().collect()):
        sized = items.where(F.col("n") >= k) if k == p.k else items.where(F.col("n") == k)
        both = F.arrays_zip(_gram_hashes("w", k).alias("h"), F.transform(_grams("w", k), F.length).alias("weight"))
        grams = sized.select("n", F.explode(both).alias("x")).select("n", F.col("x.h").alias("h"), F.col("x.weight").alias("weight"))
        grams = cut(grams.groupBy("n", "h").agg(F.max("weight").cast("long").alias("weight")))
        parts = max(1, -(-grams.count() // BROADCAST_ROWS))
        d = texts.withColumn("w", words(ascii_lower(F.col("t")))).withColumn("g", _gram_hashes("w", k))
        # outer: the inner form would add a filter that computes the hashes once more
        d = d.select("k1", "k2", F.posexplode_outer("g").alias("pos", "h"))
        for part in range(parts):
            some = grams.where(F.pmod("h", F.lit(parts)) == part)
            hit = d.join(F.broadcast(some), "h").select("k1", "k2", "n", "pos", "weight")
            out = hit if out is None else out.unionByName(hit)
    # copies of a text fold here
    return None if out is None else out.groupBy("k1", "k2", "n", "pos").agg(F.max("weight").alias("weight"))


def _spans(shared: DataFrame, items: DataFrame, p: Leak) -> DataFrame:
    """k1, k2, spans (n, first and last start, shared): starts of windows that share enough weight for
    an item of n words. ``shared`` counts a repeated shingle each time, so it is never too small."""
    reach = F.col("n") - F.least("n", F.lit(p.k))
    enter = F.struct(F.greatest(F.lit(0), F.col("pos") - reach).alias("at"), F.col("weight").alias("d"))
    leave = F.struct((F.col("pos") + 1).alias("at"), (-F.col("weight")).alias("d"))
    steps = shared.select("k1", "k2", "n", F.explode(F.array(enter, leave)).alias("x"))
    steps = steps.groupBy("k1", "k2", "n", F.col("x.at").alias("at")).agg(F.sum("x.d").alias("d"))
    place = W.partitionBy("k1", "k2", "n").orderBy("at")
    runs = steps.select("k1", "k2", "n", F.col("at").alias("a"), (F.lead("at").over(place) - 1).alias("b"),
                        F.sum("d").over(place.rowsBetween(W.unboundedPreceding, 0)).alias("shared"))
    least = items.groupBy("n").agg(F.min(_weight(F.col("shingles"))).alias("least"))
    runs = runs.join(F.broadcast(least), "n").where(F.col("shared") * 100 >= F.col("least") * p.percent)
    return runs.groupBy("k1", "k2").agg(F.collect_list(F.struct("n", "a", "b", "shared")).alias("spans"))


def _windows(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """k1, k2, n, start, shared, win: the windows at the starts of ``spans``."""
    # a row of spans has no bound, so they are never broadcast: a merge join at every size, split where a text has many copies
    held = texts.join(stored(spans).hint("merge"), ["k1", "k2"]).withColumn("w", words(ascii_lower(F.col("t"))))

    def wins(x: Column) -> Column:
        last = F.least(x["b"], F.greatest(F.lit(0), F.size("w") - x["n"]))
        starts = F.when(x["a"] <= last, F.sequence(x["a"], last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda s: F.struct(
            x["n"].alias("n"), s.alias("start"), x["shared"].alias("shared"),
            F.array_join(F.slice("w", s + 1, x["n"]), " ").alias("win")))
    laid = held.select("k1", "k2", F.explode_outer(F.flatten(F.transform("spans", wins))).alias("x"))
    laid = laid.select("k1", "k2", "x.n", "x.start", "x.shared", "x.win").where("win IS NOT NULL")
    return laid.distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          p: Leak = Leak()) -> DataFrame:
    """doc_id, key (hash of the text), item_id, n_windows, best_percent, first_word for every
    document and item with a similar window."""
    t = text_of(text_col)
    d = docs.select(F.col(id_col).alias("doc_id"), t.alias("t"), F.xxhash64(t).alias("k1"), F.xxhash64(F.lit(1), t).alias("k2"))
    texts = d.select("k1", "k2", "t")
    items = cut(_items(benchmark, p))
    shared = _shared(texts, items, p)
    if shared is None:
        kinds = [x.schema[c].dataType.simpleString() for x, c in ((docs, id_col), (benchmark, "item_id"))]
        return docs.sparkSession.createDataFrame([], f"doc_id {kinds[0]}, key long, item_id {kinds[1]}, "
                                                 "n_windows long, best_percent int, first_word int")
    laid = stored(_windows(texts, _spans(shared, items, p)))
    wins = laid.groupBy("n", "win").agg(F.max("shared").alias("shared")).withColumn("w", F.split("win", " ")) \
        .select("n", "win", "shared", _shingles("w", p).alias("shingles"))
    # the union is the window's weight and the item's less the shared one
    least = items.groupBy("n").agg(F.min(_weight(F.col("shingles"))).alias("least"))
    wins = wins.join(F.broadcast(least), "n").where(
        F.col("shared") * (100 + p.percent) >= (_weight(F.col("shingles")) + F.col("least")) * p.percent)
    wins = fingerprints(stored(wins.select("n", "win", "shingles")), "n", "win")
    marks = fingerprints(items.select("item_id", "n", F.array_join("w", " ").alias("text"), "shingles"), "item_id", "n", "text") \
        .select("item_id", "n", F.col("shingles").alias("item_shingles"), F.col("fp").alias("item_fp"))
    wins, marks = stored(wins), cut(marks)
    a = wins.select("n", "win", "fp", F.explode(block_keys(F.col("fp"), p)).alias("block"))
    b = entered(marks.select("n", "item_id", "item_fp"), "item_fp", p)
    near = a.join(b, ["n", "block"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= p.radius)
    near = near.select("n", "win", "item_id").distinct()
    both = near.join(wins.select("n", "win", "shingles"), ["n", "win"]).join(
        marks.select("n", "item_id", "item_shingles"), ["n", "item_id"])
    common = _weight(F.array_intersect("shingles", "item_shingles"))
    union = _weight("shingles") + _weight("item_shingles") - F.col("common")
    good = both.withColumn("common", common).withColumn("union", union) \
        .where(F.col("common") * 100 >= F.col("union") * p.percent) \
        .select("n", "win", "item_id", F.floor(F.col("common") * 100 / F.col("union")).cast("int").alias("percent"))
    found = laid.join(good, ["n", "win"]).groupBy("k1", "k2", "item_id").agg(
        F.count(F.lit(1)).alias("n_windows"), F.max("percent").alias("best_percent"), F.min("start").alias("first_word"))
    # stored, so a text that very many documents hold can be split in the join
    return d.select("doc_id", "k1", "k2").join(stored(found), ["k1", "k2"]).select(
        "doc_id", F.col("k1").alias("key"), "item_id", "n_windows", "best_percent", "first_word").distinct()


def clean(docs: DataFrame, benchmark: DataFrame, p: Leak = Leak()) -> DataFrame:
    """Documents without a leak, all columns kept."""
    bad = leaks(docs, benchmark, p=p).select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct()
    d = wrapped(docs, F.col("doc_id").alias("__doc_id"), F.xxhash64(text_of("text")).alias("__text_key"))
    same = (d["__text_key"] == bad["__key"]) & d["__doc_id"].eqNullSafe(bad["__id"])
    return unwrapped(d.join(bad, same, "left_anti"), docs)


def op9(spark, sf_dir):
    out = leaks(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return out.select("doc_id", "item_id", "n_windows", "best_percent", "first_word")
