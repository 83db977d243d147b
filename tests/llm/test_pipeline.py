"""The corpus pipeline against the brute-force operators, stage by stage."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as C
from spikeloom.llm import decontam, neardup, packing, quality, tokens
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.test_operators import SCHEMA, awkward


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=repr)


def test_run_keeps_what_brute_force_keeps(spark, monkeypatch):
    seen = []

    def watched(name, stage):
        def f(spark, docs, sf_dir):
            seen.append((name, docs))
            return stage(spark, docs, sf_dir)
        return name, f
    monkeypatch.setattr(C, "STAGES", [watched(*s) for s in C.STAGES])
    packed = C.run(spark, SF_SMALL)
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    for (name, before), (_, after) in zip(seen, seen[1:]):
        rows = [(r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect()]
        assert after.columns == before.columns
        if name == "quality_rules":
            want = [i for i, t in rows if brute.passes(t, quality.METHOD_RULES, quality.BASE_RULES, quality.STOP_WORDS, quality.SYMBOLS)]
        elif name == "near_dedup":
            want = [doc for doc, _, comp in brute.near(rows) if doc == comp]
        elif name == "benchmark_decontamination":
            bad = {doc for doc, _ in brute.every_leak(rows, bench, radius=decontam.Leak().radius)}
            want = [doc for doc, _ in rows if doc not in bad]
        else:
            whole = [tuple(r) for r in before.select("doc_id", "text", "source", "lang").collect()]
            bad = brute.live([r[1:] for r in whole])
            want = [r[0] for n, r in enumerate(whole) if n not in bad]
        assert ids(after) == sorted(want, key=repr), name
    # every token of every document that is left is in some bin, no bin is too full or holds a source twice
    library = Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER))
    size = {r["doc_id"]: len(library.encode(r["text"] or "", add_special_tokens=False)) + 1 for r in seen[-1][1].collect()}
    bins: dict = {}
    for r in packed.collect():
        bins.setdefault(r["pack_id"], []).append(r)
        size[r["doc_id"]] -= r["n_tokens"]
    assert set(size.values()) == {0}
    for rows in bins.values():
        assert sum(r["n_tokens"] for r in rows) <= packing.CAPACITY and len({r["source"] for r in rows}) == len(rows)


def test_awkward_and_no_rows(spark):
    docs = spark.createDataFrame(awkward(), SCHEMA)
    columns = docs.columns
    for _, stage in C.STAGES[:-1]:
        docs = neardup.stored(stage(spark, docs, SF_SMALL))
        assert docs.columns == columns
    assert C.STAGES[-1][1](spark, docs, SF_SMALL).count() >= docs.count() > 0
    none = spark.createDataFrame([], SCHEMA)
    for _, stage in C.STAGES:
        assert stage(spark, none, SF_SMALL).count() == 0
