"""Cases that earlier versions of the corpus operators got wrong."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from spikeloom.llm import decontam, lookup, neardup, secrets, shards, shingles, tokens, warc
from tests.llm.test_operators import captures


def test_header_names_in_any_case(spark):
    rows = [(1, "http://a.org/", 1, "response", None, None, "x", {"Date": "1", "Content-Type": "t", "ETAG": "e"}, None),
            (2, "http://a.org/", 2, "revisit", None, None, "x", {"date": "2", "Vary": "v", "Server": "s"}, None)]
    got = warc.resolve_revisits(captures(spark, rows)).collect()
    assert [(r["verdict"], r["headers"]) for r in got] == [("not_modified", {"date": "2", "Content-Type": "t", "ETAG": "e", "Vary": "v"})]


def test_a_burst_of_captures_is_cut_finely(spark):
    """Half of all captures fall into one second of a year."""
    rows = [(i, "http://hot.org/", 31_000_000 + i % 1000 if i % 2 else i * 60_000, "response" if i % 3 else "revisit", f'"{i % 5}"', None, None, {}, None) for i in range(600)]
    out = {r["record_id"]: r["response_id"] for r in warc.resolve_revisits(captures(spark, rows), 16).collect()}
    for i, _, ts, kind, *_ in rows:
        if kind == "revisit":
            old = max(((r[2], r[0]) for r in rows if r[3] == "response" and r[2] < ts), default=(None, None))
            assert out[i] == old[1]


DOC = "doc_id long, text string"


def test_a_stored_map_places_later_records(spark, tmp_path):
    store = str(tmp_path / "map")
    first = shards.slot_records(spark.createDataFrame([(i, f"text {i}") for i in range(50)], DOC))
    for _ in range(2):      # written again by a repeated run
        shards.write_map(shards.initial_map(shards.slot_bytes(first)), store)
    later = shards.slot_records(spark.createDataFrame([(i, f"other {i}") for i in range(1000)] + [(5, "same")] * 200 + [(None, None)] * 3, DOC))
    rows = shards.place_records(later, shards.read_map(spark, store)).collect()
    assert len(rows) == 1203 and shards.read_map(spark, store).count() == shards.N_SLOTS
    by: dict = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_copies_are_dealt_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(shards, "CHUNK", 7)
    records = shards.slot_records(spark.createDataFrame([(1, "a")] * 50 + [(2, "b")] * 8 + [(3, "c")], DOC))
    rows = shards.place_records(records, shards.initial_map(shards.slot_bytes(records), 1)).collect()
    assert sorted(r["slot"] for r in rows) == list(range(59))
    assert sorted((r["doc_id"], r["size"]) for r in rows) == [(1, 2)] * 50 + [(2, 2)] * 8 + [(3, 2)]


def test_many_secrets_in_one_text(spark):
    rnd = random.Random(1)
    values = ["".join(rnd.choice("0123456789abcdef") for _ in range(32)) for _ in range(8000)]
    text = " é ".join(values)
    got = secrets.scan(spark.createDataFrame([(1, text, "x")], "doc_id long, text string, __t string")).first()
    assert [(s["start"], s["stop"], s["value"]) for s in got["found"]] == [(35 * i, 35 * i + 32, v) for i, v in enumerate(values)]
    assert got["__t"] == "x"


def test_many_repositories_of_one_owner_are_copies(spark):
    value = "token = example0123456789"
    rows = [(i, value, f"l{i}", "s0") for i in range(7)] + [(50, "token = only1here2once3", "l0", "s0")]
    out = secrets.scan_corpus(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert {r["doc_id"]: (r["n_live"], r["n_copied"], r["max_owners"], r["max_repos"]) for r in out} == {
        **{i: (0, 1, 1, 7) for i in range(7)}, 50: (1, 0, 1, 1)}


def test_blocks_find_all_within_the_radius_and_visit_few(spark):
    p = decontam.Leak()
    rnd = random.Random(6)
    items = [rnd.getrandbits(64) for _ in range(60)]
    near = []
    for i, x in enumerate(items):
        for _ in range(6):
            y = x
            for b in rnd.sample(range(64), rnd.randint(0, p.radius)):
                y ^= 1 << b
            near.append((i, y))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    others = [rnd.getrandbits(64) for _ in range(2000)]
    fps = [y for _, y in near] + others
    a = spark.createDataFrame([(n, signed(y)) for n, y in enumerate(fps)], "n long, fp long")
    b = spark.createDataFrame([(i, signed(x)) for i, x in enumerate(items)], "i long, fp long")
    a = a.select("n", F.explode(decontam.block_keys(F.col("fp"), p)).alias("block"))
    b = decontam.entered(b, "fp", p).select("i", "block")
    met = a.join(b, "block").select("n", "i").distinct().cache()
    got = {tuple(r) for r in met.collect()}
    assert {(n, i) for n, (i, _) in enumerate(near)} <= got
    visited = len([1 for n, _ in got if n >= len(near)]) / (len(others) * len(items))
    print(f"pairs of random fingerprints visited: {visited:.3f}")
    assert visited < 0.25


def test_tables_compare_all_bytes():
    known = tokens.Lengths([b" the", b"x" * 32, b"\n"], [1, 7, 1])
    blob = b" the" + b"x" * 32 + b"x" * 31 + b"\n" + b" thE"
    data = np.frombuffer(blob + bytes(tokens.WIDE), np.uint8)
    ends = np.cumsum([4, 32, 31, 1, 4])
    h, words, size = tokens.keys(data, np.append(0, ends[:-1]), ends)
    assert known.find(h, words, size).tolist() == [1, 7, -1, 1, -1]
    cache = tokens.Cache(4)
    cache.put(h, words, size, np.arange(5))
    found = cache.find(h, words, size)
    assert ((found == np.arange(5)) | (found == -1)).all() and (found >= 0).any()
    # rows with the same hash: one is kept, the other is not mixed up with it
    t = lookup.HashTable(np.array([5, 5, 1 << 63], np.uint64))
    assert t.find(np.array([5, 6, 1 << 63], np.uint64)).tolist() in ([0, -1, 2], [1, -1, 2])


def test_units_are_cut_where_the_library_cuts():
    import public_tokenizers
    w = tokens._worker(public_tokenizers.path(tokens.TOKENIZER))
    rnd = random.Random(5)
    alpha = [*"ab Z09.,'s \n\t\r—é×÷ñ你　\xa0 \x1c\x85日½²“”🙂", "'t're ''", "\n\n", "<|endoftext|>", "'ll", "don't", " " * 40, "x" * 70]
    keep, tokens.SECTION = tokens.SECTION, 64
    try:
        for _ in range(150):
            texts = ["".join(rnd.choice(alpha) for _ in range(rnd.randrange(0, 120))) for _ in range(20)]
            got = tokens._count(w, tokens.Lengths([b" a", b"b"], [1, 1]), pa.array(texts)).tolist()
            assert got == [len(e) for e in w.tokenizer.encode_batch(texts, add_special_tokens=False)]
    finally:
        tokens.SECTION = keep


def test_other_tokenizers_are_refused():
    import public_tokenizers
    import pytest
    with pytest.raises(ValueError):
        tokens.load(public_tokenizers.path("word_bpe_49k.json"))


def test_slices_follow_bytes():
    texts = ["x" * 10, "y" * 5_000_000, None, "z" * 10, "z" * 3_000_000, "w" * 3_000_000]
    b = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], ["i", "text"])
    sizes = [sum(len(t or "") for t in p.column("text").to_pylist()) for p in shingles.pieces([b])]
    assert sum(sizes) == sum(len(t or "") for t in texts) and len(sizes) >= 4
    assert all(s <= 4 << 20 or s == 5_000_000 for s in sizes)


def test_blocks_of_unpacked_texts():
    texts = [b"a " * 600_000, b"b", b"c " * 1_200_000, b"d"]
    out = list(neardup.unpacked_blocks(pa.array([zlib.compress(t) for t in texts])))
    assert [t for _, (part,) in out for t in part] == texts and [at for at, _ in out] == [0, 2, 3]


def test_blocks_cut_by_shingles(spark):
    rnd = random.Random(3)
    w = [f"a{rnd.randrange(10 ** 6)}" for _ in range(150)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(w)))
        at = rnd.randrange(len(w))
        w = w[:at] + [f"b{i}"] + w[at + 1:]
    p = neardup.Near(partners=0, shingles=1000)
    got = neardup.near_duplicates(spark.createDataFrame(rows, DOC), p=p)
    assert {r["component_id"] for r in got.collect()} == {0}
