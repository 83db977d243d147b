"""MinHash near-dedup (operator 1): fast similarity sketches, banding, exact verification.

A text's set is its distinct 5-word shingles (fewer words: the whole sequence). Its sketch has
``bands * rows`` coordinates, filled in rounds: round i throws every shingle into one hashed bin
with a value that sorts after those of earlier rounds, until all bins are filled; from round t on,
round t + j puts every shingle into bin j, so 2t rounds always fill the sketch. The expected work is
O(t log t + n), and agreement of coordinates is as concentrated as with independent hashes.

Steps (each a Spark job):
  sketch     one Arrow pass over the texts: content key, set size, one key per band
  contents   equal word sequences are one node from here on (groups of copies fold in the shuffle)
  buckets    nodes that share a band key
  hubs       the node of a bucket that shares most buckets with others is its hub; each node is verified
             on full sets against the best hub of its buckets only, which joins most groups
  rest       where a bucket still holds several components: if it has up to ``partners`` pairs across
             components per node, those pairs are verified; else its nodes go as one group (or as
             pairs of blocks of ``block`` nodes) to a task that compares their full sets all at once and
             returns a spanning set of links. So no link that shares a band is lost, and no group
             is expanded into pairs of rows
  components pointer jumping over the links to hubs, then alternating large and small stars over the
             links between components, cut after each round
A link at the threshold shares no band with probability (1 - 0.75^rows)^bands, about 2e-5.

Defined results: null texts and texts without words have empty sets, link to nothing and are kept;
rows with a null id take part, ids compare null-safe; repeated rows share a component and both count
as kept if they bear its smallest id. ``near_duplicates`` drops extra columns unless asked to carry
them; ``keep_one`` keeps all columns and one row of each component.
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
from spikeloom.llm.common import ROW_KEYS, cut, row_keys, table, unwrapped, wrapped
from spikeloom.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Near:
    k: int = 5              # words of a shingle
    percent: int = 75       # least similarity of a link
    bands: int = 40
    rows: int = 5
    partners: int = 8       # a bucket's pairs across components are made up to this many per node
    block: int = 1024       # nodes of a block where a larger bucket is compared in blocks
    shingles: int = 500_000  # shingles of a block's nodes, about


def sketches(owner: np.ndarray, values: np.ndarray, n: int, t: int) -> np.ndarray:
    """Fast similarity sketches of n sets, given as (owner, hash); t coordinates each."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n * t, empty, np.uint64)
    # owners without values never fill
    live = np.zeros(n, bool)
    live[owner] = True
    for i in range(2 * t):
        if not len(owner):
            break
        g = S.mix(values + np.uint64((i + 1) * 0xA0761D6478BD642F % (1 << 64)))
        if i < t:
            at = ((g & np.uint64(0xFFFFFFFF)) * np.uint64(t) >> np.uint64(32)).astype(np.int64)
        else:
            at = np.full(len(g), i - t, np.int64)
        np.minimum.at(out, owner * t + at, (np.uint64(i) << np.uint64(32)) | (g >> np.uint64(32)))
        open_ = (out.reshape(n, t) == empty).any(axis=1) & live
        more = open_[owner]
        owner, values = owner[more], values[more]
    return out.reshape(n, t)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, different between bands."""
    x = sketch.reshape(len(sketch), bands, rows)
    key = np.zeros(x.shape[:2], np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)
    for r in range(rows):
        key = S.mix(key ^ S.mix(x[:, :, r] + np.uint64(r + 1)))
    return key.view(np.int64)


def content_key(text: bytes) -> tuple[int, int]:
    """128 bits of a normal form."""
    d = hashlib.blake2b(text, digest_size=16).digest()
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def _sketch_task(p: Near):
    """The columns before the text, and what the text's set gives."""
    def run(batches):
        tables: dict = {}
        for b in S.pieces(batches):
            texts = [S.normal(t) for t in b.column(b.num_columns - 1).to_pylist()]
            for lo, hi in S.blocks(map(len, texts)):
                part = texts[lo:hi]
                owner, values = S.shingle_sets(part, p.k, tables)
                sizes = np.bincount(owner, minlength=len(part))
                keys = band_keys(sketches(owner, values, len(part), p.bands * p.rows), p.bands, p.rows)
                ids = [content_key(t) for t in part]
                flat = pa.array(keys.reshape(-1), pa.int64())
                step = np.arange(0, len(part) * p.bands + 1, p.bands, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(lo, hi - lo) for c in b.columns[:-1]], pa.array([i for i, _ in ids], pa.int64()),
                     pa.array([j for _, j in ids], pa.int64()), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(step), flat)],
                    [*b.schema.names[:-1], "k1", "k2", "n_shingles", "keys"])
    return run


def _form_task(lower: bool):
    """Content key and packed normal form of each text with words, once per batch."""
    def run(batches):
        for b in batches:
            seen: set = set()
            for part in S.pieces([b]):
                keys, packed = [], []
                for t in part.column("text").to_pylist():
                    x = S.normal(t, lower)
                    if x:
                        key = content_key(x)
                        if key not in seen:
                            seen.add(key)
                            keys.append(key)
                            packed.append(zlib.compress(x, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _ in keys], pa.int64()), pa.array([j for _, j in keys], pa.int64()),
                     pa.array(packed, pa.binary())], ["k1", "k2", "packed"])
    return run


def packed_forms(texts: DataFrame, lower: bool) -> DataFrame:
    """One packed normal form per content key (k1, k2); ``texts`` has the one column text. Copies fold
    in the batch, then before the shuffle."""
    return texts.mapInArrow(_form_task(lower), "k1 long, k2 long, packed binary") \
        .groupBy("k1", "k2").agg(F.first("packed").alias("packed"))


def unpacked_blocks(*columns: pa.Array):
    """(first row, unpacked texts of each column) for rows of about ``S.BLOCK`` unpacked bytes at a time."""
    rows, total, at = [], 0, 0
    for i, row in enumerate(zip(*columns)):
        row = [zlib.decompress(x.as_buffer()) for x in row]
        size = sum(map(len, row))
        if rows and total + size > S.BLOCK:
            yield at, list(zip(*rows))
            rows, total, at = [], 0, i
        rows.append(row)
        total += size
    if rows:
        yield at, list(zip(*rows))


def _verify_task(p: Near):
    """Pairs of normal forms whose full shingle sets are similar enough."""
    def run(batches):
        tables: dict = {}
        for b in batches:
            good = np.zeros(b.num_rows, bool)
            for at, (left, right) in unpacked_blocks(b.column("fa"), b.column("fb")):
                n = len(left)
                oa, va = S.shingle_sets(list(left), p.k, tables)
                ob, vb = S.shingle_sets(list(right), p.k, tables)
                o, v = np.concatenate([oa, ob]), np.concatenate([va, vb])
                order = np.lexsort((v, o))
                o, v = o[order], v[order]
                both = np.bincount(o[1:][(o[1:] == o[:-1]) & (v[1:] == v[:-1])], minlength=n)
                union = np.bincount(o, minlength=n) - both
                good[at:at + n] = (union > 0) & (100 * both >= p.percent * union)
            yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(good)),
                                              b.column("b").filter(pa.array(good))], ["a", "b"])
    return run


def common_counts(left: np.ndarray, n: int, owner: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``left`` (numbers) with all n sets (owner, hash)."""
    at, many = np.unique(values, return_inverse=True, return_counts=True)[1:]
    keep = many[at] > 1
    owner, at = owner[keep], np.unique(at[keep], return_inverse=True)[1]
    out = np.zeros((len(left), n), np.float32)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    for lo in range(0, int(at[-1]) + 1 if len(at) else 0, 2048):
        part = slice(np.searchsorted(at, lo), np.searchsorted(at, lo + 2048))
        held = np.zeros((n, 2048), np.float32)
        held[owner[part], at[part] - lo] = 1
        out += held[left] @ held.T
    return out


def _block_task(p: Near):
    """Links between the components of one group of nodes: enough of them to join what is linked."""
    def run(t: pa.Table) -> pa.Table:
        nodes, comp = t.column("node").to_numpy(), np.unique(t.column("comp").to_numpy(), return_inverse=True)[1]
        n, parts, tables = len(nodes), [], {}
        for at, (texts,) in unpacked_blocks(t.column("packed").combine_chunks()):
            o, v = S.shingle_sets(list(texts), p.k, tables)
            parts.append((o + at, v))
        owner, values = (np.concatenate(x) for x in zip(*parts))
        size = np.bincount(owner, minlength=n)
        links = []
        outside = np.flatnonzero(comp != np.bincount(comp).argmax())
        for lo in range(0, len(outside), 512):
            left = outside[lo:lo + 512]
            both = common_counts(left, n, owner, values)
            i, j = np.nonzero((100 * both >= p.percent * (size[left][:, None] + size[None, :] - both))
                              & (comp[left][:, None] != comp[None, :]))
            # one link for each pair of components that has any
            first = np.unique(np.minimum(comp[left[i]], comp[j]) * np.int64(n) + np.maximum(comp[left[i]], comp[j]), return_index=True)[1]
            links += zip(left[i[first]].tolist(), j[first].tolist())
        a, b = [nodes[i] for i, _ in links], [nodes[j] for _, j in links]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def verify(pairs: DataFrame, forms: DataFrame, p: Near) -> DataFrame:
    """The pairs (a, b) that are links; ``forms`` has node and packed. A hub with very many partners
    is one row on the other side of the join, so adaptive skew handling can split its pairs."""
    fb = forms.select(F.col("node").alias("b"), F.col("packed").alias("fb"))
    fa = forms.select(F.col("node").alias("a"), F.col("packed").alias("fa"))
    full = pairs.join(fb, "b").join(fa, "a").select("a", "b", "fa", "fb")
    return full.mapInArrow(_verify_task(p), "a long, b long")


def roots(parents: DataFrame) -> DataFrame:
    """(node, comp) of a forest given as (node, up): every node jumps to its parent's parent until all
    point at a root. Roots have no row."""
    p = cut(parents)
    while True:
        above = p.select(F.col("node").alias("up"), F.col("up").alias("top"))
        p = cut(p.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")))
        if p.where("moved").isEmpty():
            return p.select("node", F.col("up").alias("comp"))
        p = p.select("node", "up")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of the links (a, b): comp is the smallest node reachable."""
    e = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
        before = state
        # large star: every larger neighbour of u moves to the smallest node around u
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = cut(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        # small star: u and its smaller neighbours move to the smallest of them
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(
            least.select("u", F.col("m").alias("v"))).distinct()
        e = cut(e)


def merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, comp) after more links: only links between components count."""
    ends = comps.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
    more = links.join(ends, "a").join(ends.toDF("b", "cb"), "b").where("ca <> cb")
    more = cut(more.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    if more.isEmpty():
        return comps
    to = components(more).select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    return stored(comps.join(to, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")))


def _mixed(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Members (key, node, size, comp) of the buckets that hold several components, with the bucket's number
    of nodes n, the shingles of all, its number of pairs across components and its largest component."""
    m = members.join(comps, "node").select("key", "node", "size", "comp")
    parts = m.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("size").alias("total"))
    square = F.col("c").cast("double") * F.col("c")
    buckets = parts.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.sum("c").alias("n"), F.sum("total").alias("total"), F.sum(square).alias("within"),
                                       F.max(F.struct("c", "comp"))["comp"].alias("major")).where("k > 1")
    across = (F.col("n").cast("double") * F.col("n") - F.col("within")) / 2
    # stored, so a hot bucket's members can be split in the join
    return m.join(stored(buckets.select("key", "n", "total", across.alias("across"), "major")), "key")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Near = Near(),
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns to carry, n_shingles, component_id, kept for every row, and component: a
    number of its own for each component, null for an empty set (ids may repeat or be null)."""
    source = docs.select(F.col(id_col).alias("doc_id"), *carry, F.col(text_col).alias("text"))
    given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    rows = source.mapInArrow(_sketch_task(p), f"{given}, k1 long, k2 long, n_shingles long, keys array<long>")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()))
    full = rows.where("n_shingles > 0")
    contents = stored(full.groupBy("k1", "k2").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("least"), F.first("n_shingles").alias("size")))
    firsts = full.join(contents.select(F.col("node").alias("row")), "row", "left_semi")
    bands = firsts.select(F.col("row").alias("node"), F.col("n_shingles").alias("size"), F.explode("keys").alias("key"))
    shared = stored(bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    members = stored(bands.join(shared, "key").select("key", "node", "size", "n"))
    # a node's rank: how many others it meets in its buckets, then the smaller number
    ranks = members.groupBy("node").agg(F.sum("n").alias("met")).select(
        "node", F.struct("met", (-F.col("node")).alias("less")).alias("rank"))
    ranked = members.join(ranks, "node")
    hubs = stored(ranked.groupBy("key").agg(F.max("rank").alias("hub")))
    nodes = members.join(hubs, "key").groupBy("node").agg(F.max("hub").alias("hub")).select("node", (-F.col("hub.less")).alias("a"))
    wanted = contents.join(nodes, "node").select("k1", "k2", "node", "a")
    forms = stored(wanted.join(packed_forms(source.select("text"), lower=True), ["k1", "k2"]).select("node", "a", "packed"))
    done = forms.where("node <> a").select("a", F.col("node").alias("b"))
    links = verify(done, forms, p)
    up = roots(links.select(F.col("b").alias("node"), F.col("a").alias("up")))
    comps = stored(forms.select("node").join(up, "node", "left").select("node", F.coalesce("comp", "node").alias("comp")))
    mixed = stored(_mixed(members, comps))
    few = F.col("across") <= F.col("n") * p.partners
    # pairs across components have an end outside the largest one
    some = mixed.where(few).where("comp <> major").select("key", F.col("node").alias("x"), F.col("comp").alias("cx"), F.col("size").alias("sx"))
    near = some.join(mixed.where(few).select("key", F.col("node").alias("y"), F.col("comp").alias("cy"), F.col("size").alias("sy")), "key")
    # sets whose sizes are too far apart can't be similar
    near = near.where((F.col("cx") != F.col("cy")) & (F.least("sx", "sy") * 100 >= F.greatest("sx", "sy") * p.percent))
    near = near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    tried = done.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    found = verify(near.join(tried, ["a", "b"], "left_anti"), forms, p)
    # every block of a large bucket meets every other in one group
    blocks = F.ceil(F.greatest(F.col("n") / p.block, F.col("total") / p.shingles)).cast("int")
    large = mixed.where(~few).withColumn("i", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    large = large.withColumn("j", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "key", "node", "comp", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"))
    whole = large.join(forms.select("node", "packed"), "node").groupBy("key", "lo", "hi").applyInArrow(_block_task(p), "a long, b long")
    comps = merged(comps, found.union(whole))
    least = contents.select("node", "least", "k1", "k2").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    # stored, so a component with very many nodes can be split in the join
    ends = stored(least.groupBy("comp").agg(F.min("least").alias("component_id")))
    classes = stored(least.join(ends, "comp").select("k1", "k2", "component_id", F.col("comp").alias("component")))
    out = rows.select("doc_id", *carry, "k1", "k2", "n_shingles").join(classes, ["k1", "k2"], "left")
    comp = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", *carry, "n_shingles", comp.alias("component_id"),
                      F.col("doc_id").eqNullSafe(comp).alias("kept"), "component")


def keep_one(docs: DataFrame, p: Near = Near()) -> DataFrame:
    """One row of each component, the one of its smallest id, with all columns; of equal rows one."""
    keyed = wrapped(docs, *row_keys())
    classes = near_duplicates(docs.select("doc_id", "text", *row_keys()), p=p, carry=ROW_KEYS).where("kept")
    chosen = classes.where("n_shingles > 0").groupBy("component").agg(F.min(F.struct(*ROW_KEYS)).alias("r")).select("r.*")
    chosen = chosen.union(classes.where("n_shingles = 0").select(*ROW_KEYS))
    return unwrapped(keyed.join(chosen, list(ROW_KEYS), "left_semi").dropDuplicates(list(ROW_KEYS)), docs)


def op1(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text")).drop("component")


OP1_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id AS node, doc_id AS seen FROM d UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN c ON c.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""
