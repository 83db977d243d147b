"""Operators 11 to 13 against plain Python."""

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from spikeloom.llm import hardneg, langid, repair
from tests.conftest import SF_CHECK, SF_SMALL

sys.setrecursionlimit(20_000)      # the plain versions recurse over rows
CONV = "conv_id long, turn long, role string, text string, chunk long, codes string"


def cheapest(rows):
    """Cost, audit and rows of the cheapest edits of (role, text, must go, truncated) rows: every way is weighed."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(None)
    def best(i, state, inserts):
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        for to in "ua":
            if (state, to) in after and inserts < 2:
                c, a, r = best(i, to, inserts + 1)
                ways.append((c + 5, "I" + a, (({"u": "user", "a": "assistant"}[to], ""),) + r))
        if i < len(rows):
            role, text, gone, cut = rows[i]
            c, a, r = best(i + 1, state, 0)
            ways.append((c + 2, "D" + a, r))
            if not gone:
                if (state, role[:1]) in after:
                    c, a, r = best(i + 1, role[:1], 0)
                    ways.append((c + 5 * cut, "K" + a, ((role, text),) + r))
                for to in "ua":
                    if (state, to) in after:
                        c, a, r = best(i + 1, to, 0)
                        ways.append((c + 1 + 5 * cut, "R" + a, (({"u": "user", "a": "assistant"}[to], text),) + r))
        return min(ways, default=(math.inf, "", ()), key=lambda w: w[:2])
    return best(0, "", 0)


def repaired(table):
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, hash) of every conversation of (conv, turn, role, text) rows."""
    groups = defaultdict(list)
    for conv, turn, role, text in table:
        groups[conv]
        shown = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(shown.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        groups[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        seen, work, counts = set(), [], Counter()
        for _, role, text in rows:
            ink = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            work.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(work, work[1:]))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, left = cheapest(work)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest))
    return out


def talk(rnd, n, conv, texts):
    # one row per turn and role, so the order of rows is never a matter of ties
    return [(conv, t, rnd.choice(["user", "assistant", "user", "assistant", "system", "tool"]), rnd.choice(texts)) for t in range(n)]


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_repair_of_given_conversations(spark):
    t = spark.read.parquet(f"{SF_CHECK}/conversations.parquet")
    got = repair.op11(spark, SF_CHECK).collect()
    assert ordered(got) == ordered(repaired([tuple(r) for r in t.select("conv_id", "turn", "role", "text").collect()]))


@pytest.mark.parametrize("size", [3, 16_384])
def test_repair_awkward(spark, size, tmp_path):
    rnd = random.Random(4)
    texts = ["Fine.", "Same again!", "", " \n", "no end", "Also. fine?", "x.", "é?", "many words without an end " * 40, "ok. \t", "日本。", "Yes!"]
    rows = [r for c in range(40) for r in talk(rnd, rnd.randrange(1, 25), c, texts)]
    rows += talk(rnd, 400, 1000, [f"word {i}." for i in range(300)] + ["cut"])          # many chunks
    rows += [(1001, t, "user", "cut off") for t in range(120)]                          # nothing converges
    rows += [(1002, t, "system", "") for t in range(60)]                                # forced deletions only
    rows += [(1003, t, "user", "same.") for t in range(50)] + [(1003, 60, "assistant", "done.")]
    rows += [(1004, 3, "user", "copies.")] * 30 + [(1004, 4, "assistant", "done.")]
    rows += [(None, None, None, None), (None, 5, "user", "Hi."), (None, 6, "assistant", "Ho."), (7000, None, "user", "Hi."),
             (7000, 1, None, "x."), (7001, 2, "", "empty role."), (7002, 1, "user", None), (7003, None, None, None)]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], CONV).repartition(4)
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    got = repair.op11(spark, str(tmp_path), size).collect()
    assert ordered(got) == ordered(repaired(rows))


def test_repair_of_no_rows(spark, tmp_path):
    spark.createDataFrame([], CONV).write.parquet(str(tmp_path / "conversations.parquet"))
    assert repair.op11(spark, str(tmp_path)).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 1, "user", "x.", 1, "")], CONV).write.mode("overwrite").parquet(str(tmp_path / "conversations.parquet"))
    assert [tuple(r) for r in repair.op11(spark, str(tmp_path)).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_reruns_stop_where_vectors_differ_by_a_constant():
    rnd = random.Random(2)
    for _ in range(200):
        codes = bytes(rnd.choice([0, 1, 2, 3, 4, 9, 10]) for _ in range(rnd.randrange(1, 40)))
        old, new = repair.END, tuple(rnd.randrange(12) for _ in range(4))
        new = repair.opened(list(new))
        start = repair.run_back(codes, old)[0]
        assert repair.rerun(codes, old, start, new) == repair.run_back(codes, new)[0]


VEC = "vec_id long, embedding array<float>, label int, row long, score long"


def negatives(rows):
    """op12 over (vec_id, vector, label) rows."""
    d = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        d.append((i, [math.floor(256 * float(np.float32(x))) for x in v], int(math.fmod(label + 1, 10)) if i is not None and i % 7 == 0 else label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    place = lambda e: (-e[0], e[1] is None, e[1] or 0)
    out = []
    for n, (i, v, label) in enumerate(d):
        if i is None or i % 100:
            continue
        scores = [(dot(v, w), j, m) for k, (j, w, m) in enumerate(d) if k != n]
        for ps, pid, _ in sorted((s for s in scores if s[2] == label), key=place)[:5]:
            good = sorted((s for s in scores if s[2] != label and 30 * ps <= 100 * s[0] <= 90 * ps), key=place)[:10]
            out += [(i, pid, r, j, ps, s) for r, (s, j, _) in enumerate(good, 1)]
    return out


def test_hard_negatives_awkward(spark):
    rnd = random.Random(8)
    vec = lambda n=12: [rnd.gauss(0.2, 0.3) for _ in range(n)]
    same = vec()
    rows = [(i, vec(), rnd.randrange(4)) for i in range(700)] + [(i, same, 1) for i in range(700, 950)]
    rows += [(1000, None, 1), (1001, vec(), None), (1002, [0.1, None], 1), (1100, [float("nan")] * 12, 2), (1003, [float("inf")] * 12, 2),
             (None, vec(), 1), (None, same, 2), (1200, [], 1), (1300, vec(20), 3), (1301, vec(5), 3), (1400, vec(), 77), (-100, vec(), -5), (1401, vec(), 2), (1401, vec(), 2)]
    df = spark.createDataFrame([(*r, 1, 1) for r in rows], VEC).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    want = ordered(negatives(rows))
    for p in (hardneg.Mine(), hardneg.Mine(tile=50, anchors=4, leaf=2, heaps=2)):
        got = hardneg.mine(df, F.col("vec_id") % 100 == 0, p, label=label).collect()
        assert ordered(got) == want and len(want) > 300
    empty = spark.createDataFrame([], VEC)
    assert hardneg.mine(empty, F.col("vec_id") % 100 == 0).count() == 0


def test_repeated_anchor_is_a_row_of_its_own(spark):
    rows = [(100, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (1, [0.5, 0.25], 2)]
    got = hardneg.mine(spark.createDataFrame([(*r, 0, 0) for r in rows], VEC), F.col("vec_id") % 100 == 0).collect()
    assert [tuple(r)[:2] for r in got] == [(100, 100)] * 2


def test_strassen_is_exact():
    rnd = np.random.default_rng(3)
    for n, k, m in ((1, 1, 1), (37, 65, 41), (128, 64, 96), (5, 130, 7), (66, 33, 100)):
        for most in (200, 1 << 20, 1 << 29):
            a, b = rnd.integers(-most, most, (n, k)), rnd.integers(-most, most, (k, m))
            assert (hardneg.strassen(a, b, 8) == a @ b).all()


def code_length(model, text, order):
    """Bits of a text under counts[k][context][byte], straight from the definition, each byte rounded as stated."""
    raw = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.lower().encode())
    raw = b" " * order + re.sub(b" +", b" ", raw.lstrip(b" "))
    total = 0
    for i in range(order, len(raw)):
        bits = 0
        for k in range(order, -1, -1):
            after = model[k].get(raw[i - k:i])
            if after is None:
                continue
            n, kinds = sum(after.values()), len(after)
            if raw[i] in after:
                total += bits + round(4096 * math.log2((n + kinds) / after[raw[i]]))
                break
            bits += round(4096 * math.log2((n + kinds) / kinds))
        else:
            total += bits + 8 * 4096
    return total


def trees(texts, order):
    model = [defaultdict(Counter) for _ in range(order + 1)]
    for text in texts:
        raw = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.lower().encode())
        raw = b" " * order + re.sub(b" +", b" ", raw.lstrip(b" "))
        for i in range(order, len(raw)):
            for k in range(order + 1):
                model[k][raw[i - k:i]][raw[i]] += 1
    return model


def test_code_lengths(spark, monkeypatch):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()]
    docs = [(i, t[:3000], x) for i, t, x in docs] + [(900, None, "en"), (901, "", "en"), (902, " 12 !?", "de"), (903, "a text", None), (None, "der die das", "de"),
                                                     (904, "日本語 の 文", None), (905, "Ünïcode ÇÀ", "fr"), (906, "the and of " * 500, None)] + [(907, "the the", "en")] * 3
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, lang string, score long, c0 string").repartition(3)
    taught = [d for d in docs if d[1] is not None and d[2] is not None and (d[0] is None or zlib.crc32(str(d[0]).encode()) % 3 != 1)]
    p = langid.Trees(order=3)
    model = {x: trees([t for _, t, y in taught if y == x], p.order) for x in {d[2] for d in taught}}
    monkeypatch.setattr(langid, "BLOCK", 5000)
    teach = df.withColumn("held", langid.held_out())
    got = langid.predict(teach, langid.learn(teach.where("not held"), p), carry=("doc_id", "held")).collect()
    want = []
    for i, text, _ in docs:
        held = i is not None and zlib.crc32(str(i).encode()) % 3 == 1
        if text is None or not any(c.isalpha() for c in text):
            want.append((i, held, "und", 0.0))
            continue
        n = {x: code_length(m, text, p.order) for x, m in model.items()}
        best = min(n, key=lambda x: (n[x], x))
        want.append((i, held, best, 1 / sum(2.0 ** (-(v - n[best]) / 4096) for v in n.values())))
    key = lambda r: (repr(r[0]), r[2], r[3])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-9


def test_held_out_accuracy(spark):
    d = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "lang")
    right = langid.op13(spark, SF_CHECK).where("held_out").join(d, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_nothing_learned(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    model = langid.learn(df)
    assert {tuple(r) for r in langid.predict(df, model).collect()} == {(1, "und", 0.0), (2, "und", 0.0)}
    assert langid.predict(df.where("false"), model).count() == 0
