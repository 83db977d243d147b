"""Conversation structure repair (operator 11): rank-convergence parallel Viterbi.

A conversation is the sequence of its rows by turn (nulls first; rows of one turn by role, then by a hash
of role and text). Faults of a row, the first counts: blank text; a (role, text) seen earlier; truncated,
the last character that is no white space not one of ``.!?``. Edits turn it into a sequence whose role initials
match ``(s?(ua)+)?``: Keep costs 0, Rerole to user or assistant 1, Delete 2, Insert an empty user or
assistant row 5; blank and duplicate rows must go, a truncated row that stays costs 5 more. The audit is
the cheapest edits' initials in order, the ASCII-least among equals.

The accepting states are start, after s, after u, after a, so the cost to go at a gap between rows is a
vector of four numbers, and a row is a (min, +) matrix. Conversations are cut into chunks of at most ``chunk``
rows by a range partitioning of the light rows (no texts), so one of any length is many chunks:

  backward   every chunk is run from its end: the last of a conversation from the true vector, others from a
             speculative one (as if the conversation ended there)
  fix-up     a chunk whose successor's vector differs from the one it used by more than a constant is run
             again, beside its old run, only until the two vectors differ by a constant: from there on
             all costs shift alike. Passes go on until no chunk has to run; costs then are the true ones
             but for a constant per chunk, which no decision depends on
  stitch     each chunk's map from entry state to exit state; maps are composed along a conversation by
             doubling, so its chunks know the state they are entered in
  trace      forward from that state, always the least letter that stays on a cheapest path

Most conversations are one chunk and need no fix-up. Copies of a row (same turn, role and text) fold into one
with a count before anything is shuffled: the first stands for all, the rest must be deleted and only shift
costs. Vectors do not converge through chunks whose every row is better deleted; where ``PASSES`` fix-ups
leave a conversation unfinished, its chunks' whole matrices are composed from the end by doubling, which
gives the same vectors in as many rounds as the logarithm of its chunks.

Defined results: null conversation ids are one conversation; a null role or text is one space; a role with another
initial than s, u, a (or none) can't be kept; a conversation without rows has no cost, no audit and
no repaired rows; extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spikeloom.llm.common import table
from spikeloom.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 16_384
PASSES = 8
FAR = 1 << 40               # a cost beyond all others
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# fixed values: states 0 start, 1 after s, 2 after u, 3 after a; what an initial leads to
AFTER = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
FORWARD = (2, 2, 3, 2)      # by a user or assistant row, whichever fits
FORCED, CUT_OFF = 4, 8      # bits of a code beside the initial's number
INITIALS = "sua"            # numbers 0 to 2; 3 is any other
END = (0, 2 * INSERT, INSERT, 0)


def opened(v: list) -> tuple:
    """A vector with the inserts its gap may hold."""
    a, b = v[3], v[2]
    a2, u2 = min(a, INSERT + b), min(b, INSERT + a)
    return min(v[0], INSERT + u2), min(v[1], INSERT + u2), u2, a2


def before(code: int, v: tuple) -> tuple:
    """The vector before a row, from the one after it."""
    if code & FORCED:
        return tuple(x + DELETE for x in v)
    more = TRUNCATED if code & CUT_OFF else 0
    out = []
    kind = code & 3
    for s in range(4):
        best = min(DELETE + v[s], REROLE + more + v[FORWARD[s]])
        to = AFTER[INITIALS[kind]][s] if kind < 3 else None
        if to is not None:
            best = min(best, KEEP + more + v[to])
        out.append(best)
    return opened(out)


def level(v) -> tuple:
    """A vector but for a constant."""
    least = min(v)
    return tuple(x - least for x in v)


def run_back(codes, end) -> list[tuple]:
    """Vectors at all gaps of a chunk, the last one given."""
    out = [tuple(end)]
    for c in reversed(codes):
        out.append(before(c, out[-1]))
    return out[::-1]


def rerun(codes, old_end, old_start, end) -> tuple:
    """The vector before a chunk for a new vector after it, known for another: both runs go on only until
    they differ by a constant."""
    a, b = tuple(old_end), tuple(end)
    for c in reversed(codes):
        if level(a) == level(b):
            break
        a, b = before(c, a), before(c, b)
    else:
        return b
    return tuple(x + b[0] - a[0] for x in old_start)


def trace(codes, gaps: list[tuple], state: int, last: bool) -> tuple[str, int, list[tuple]]:
    """Audit, exit state and what stands after the edits: (row number, or -1 for an inserted row; role initial
    where it is not the row's own)."""
    audit, out, i, n = [], [], 0, len(codes)
    while True:
        v = gaps[i]
        if i == n and (not last or (v[state] == 0 and state in (0, 3))):
            return "".join(audit), state, out
        to, letter = FORWARD[state], "ua"[FORWARD[state] - 2]
        if i < n:
            c, w = codes[i], gaps[i + 1]
            if c & FORCED or DELETE + w[state] == v[state]:
                audit.append("D")
                i += 1
                continue
        if INSERT + v[to] == v[state]:
            audit.append("I")
            out.append((-1, letter))
            state = to
            continue
        kind, more = c & 3, TRUNCATED if c & CUT_OFF else 0
        own = AFTER[INITIALS[kind]][state] if kind < 3 else None
        if own is not None and more + w[own] == v[state]:
            audit.append("K")
            out.append((i, ""))
            state = own
        else:
            audit.append("R")
            out.append((i, letter))
            state = to
        i += 1


def _chunk_task(size: int):
    """Arrow task over sorted light rows: one row per run of a conversation, cut to ``size``."""
    def run(batches):
        held, at = [], 0        # columns of the open chunk
        conv, none = None, True

        def out():
            nonlocal held, at
            cols = [[x for part in held for x in part[i]] for i in range(5)]
            codes = bytes(cols[4])
            held, at = [], at + 1
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.int64()), pa.array([at]), pa.array([codes], pa.binary()), *[pa.array([c], pa.list_(pa.int64())) for c in cols[:4]]],
                ["conv", "chunk", "codes", "turns", "k1", "k2", "extra"])
        for b in batches:
            convs = b.column(0).to_pylist()
            cols = [b.column(i).to_pylist() for i in range(1, 6)]
            starts = [0, *[i for i in range(1, len(convs)) if convs[i] != convs[i - 1]], len(convs)]
            for lo, hi in zip(starts, starts[1:]):
                if lo == hi:
                    continue
                if held and convs[lo] != conv:
                    yield out()
                conv = convs[lo]
                while lo < hi:
                    room = size - sum(len(p[0]) for p in held)
                    part = [c[lo:min(hi, lo + room)] for c in cols]
                    held.append(part)
                    lo += len(part[0])
                    if len(part[0]) == room:
                        yield out()
        if held:
            yield out()
    return run


def matched(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """The columns of ``left`` and the others of ``right`` where the keys are equal, nulls included."""
    r = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return left.join(r, on, how).drop(*[f"__{k}" for k in keys])


def _per_chunk(f, names: list[str], types: list):
    """Arrow task that calls f on each row (a dict) and returns a tuple, or a list of tuples with ``many``."""
    def run(batches):
        for b in batches:
            rows = [x for r in b.to_pylist() for x in f(r)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)
    return run


def light_rows(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text) without texts: copies folded, faults found. ``copies`` rows stand there, ``first``
    says whether one of them is the first of its (role, text)."""
    found = F.regexp_extract(F.col("text"), r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    d = rows.select("conv", "turn", "role", F.xxhash64("role", "text").alias("k1"), F.xxhash64(F.lit(7), "text", "role").alias("k2"),
                    (found == "").alias("blank"), (~found.isin(".", "!", "?")).alias("cut_off"))
    d = d.groupBy("conv", "turn", "role", "k1", "k2", "blank", "cut_off").agg(F.count(F.lit(1)).alias("copies"))
    d = stored(d)
    # stored, so a hot text's rows can be split in the join
    least = stored(d.groupBy("conv", "k1", "k2").agg(F.count("turn").alias("known"), F.count(F.lit(1)).alias("turns"), F.min("turn").alias("least"))
                   .where("turns > 1").select("conv", "k1", "k2", F.when(F.col("known") == F.col("turns"), F.col("least")).alias("least"), F.lit(True).alias("more")))
    first = F.col("more").isNull() | F.col("turn").eqNullSafe(F.col("least"))
    return matched(d, least, ["conv", "k1", "k2"], "left").select(*d.columns, first.alias("first"))


def chunks_of(light: DataFrame, size: int = CHUNK) -> DataFrame:
    """One row per chunk: conv, chunk (order within the conversation), codes, turns, k1, k2, extra (deletions forced
    after each row), and whether it is the last."""
    initial = F.position(F.substring("role", 1, 1), F.lit(INITIALS))
    kind = F.when((F.length("role") > 0) & (initial > 0), initial - 1).otherwise(3)
    forced = F.col("blank") | ~F.col("first")
    code = kind + F.when(forced, FORCED).otherwise(F.when(F.col("cut_off"), CUT_OFF).otherwise(0))
    d = light.select("conv", "turn", "role", "k1", "k2", (F.col("copies") - 1).alias("extra"), code.cast("int").alias("code"))
    d = stored(d)
    spread = d.repartitionByRange("conv", "turn", "role", "k1", "k2").sortWithinPartitions("conv", "turn", "role", "k1", "k2")
    made = spread.select("conv", "turn", "k1", "k2", "extra", "code").mapInArrow(
        _chunk_task(size), "conv long, chunk long, codes binary, turns array<long>, k1 array<long>, k2 array<long>, extra array<long>")
    # partitions are in order, and so are the chunks of one
    made = stored(made.select("*", F.spark_partition_id().alias("part")))
    order = Window.partitionBy("conv").orderBy("part", "chunk")
    numbered = made.select("conv", "part", "chunk", F.row_number().over(order).cast("long").alias("j"),
                           F.lead("chunk").over(order).isNull().alias("last"))
    if numbered.where("j > 1").isEmpty():
        return made.withColumn("chunk", F.lit(1).cast("long")).withColumn("last", F.lit(True)).drop("part")
    both = matched(made, numbered, ["conv", "part", "chunk"])
    return stored(both.select("conv", F.col("j").alias("chunk"), "codes", "turns", "k1", "k2", "extra", "last"))


VECTOR = "array<long>"


def composed(chunks: DataFrame) -> DataFrame:
    """(conv, j, true_end): the vectors after chunks (conv, j, codes), from their matrices composed by doubling."""
    def matrix(r):
        columns = [run_back(r["codes"], [0 if i == t else FAR for i in range(4)])[0] for t in range(4)]
        return [(r["conv"], r["j"], [c[i] for i in range(4) for c in columns])]
    m = stored(chunks.mapInArrow(_per_chunk(matrix, ["conv", "j", "m"], [pa.int64(), pa.int32(), pa.list_(pa.int64())]), f"conv long, j int, m {VECTOR}"))
    four = F.sequence(F.lit(0), F.lit(3))
    step, longest = 1, m.agg(F.max("j")).first()[0] or 0
    while step < longest:
        later = m.select("conv", (F.col("j") - step).alias("j"), F.col("m").alias("after"))
        cell = lambda i, k: F.get("m", F.floor(i / 4).cast("int") * 4 + k) + F.get("after", k * 4 + i % 4)
        both = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.array_min(F.transform(four, lambda k: cell(i, k))))
        m = stored(matched(m, later, ["conv", "j"], "left").select("conv", "j", F.when(F.col("after").isNotNull(), both).otherwise(F.col("m")).alias("m")))
        step *= 2
    end = F.lit(list(END)).cast(VECTOR)
    ends = F.transform(four, lambda s: F.array_min(F.transform(four, lambda t: F.get("m", s * 4 + t) + F.get(end, t))))
    after = m.select("conv", (F.col("j") - 1).alias("j"), ends.alias("v"))
    return matched(m, after, ["conv", "j"], "left").select("conv", "j", F.coalesce("v", end).alias("true_end"))


def solved(chunks: DataFrame) -> DataFrame:
    """(conv, chunk, end, entry) of the chunks of conversations of several: the vector after each, true but for a
    constant, and the state it is entered in."""
    several = chunks.where(~F.col("last") | (F.col("chunk") > 1)).select("conv", "chunk", "last", "codes")
    # a chunk of forced deletions changes nothing but a constant: its neighbours meet
    free = several.where(F.length(F.regexp_replace(F.hex("codes"), "0[4567]", "")) > 0)
    order = Window.partitionBy("conv").orderBy("chunk")
    d = stored(free.select("conv", "chunk", "codes", F.row_number().over(order).alias("j"), F.lead("chunk").over(order).isNull().alias("final")))
    end = F.lit(list(END)).cast(VECTOR)

    def start(r):
        return [(r["conv"], r["j"], r["used"], list(run_back(r["codes"], r["used"])[0]))]

    def again(r):
        return [(r["conv"], r["j"], r["next"], list(rerun(r["codes"], r["used"], r["start"], r["next"])))]
    names, types = ["conv", "j", "used", "start"], [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    schema = f"conv long, j int, used {VECTOR}, start {VECTOR}"
    state = stored(d.select("conv", "j", "codes", end.alias("used")).mapInArrow(_per_chunk(start, names, types), schema))
    flat = lambda c: F.transform(c, lambda x: x - F.array_min(c))
    for n in range(PASSES + 1):
        pairs = matched(state, state.select("conv", (F.col("j") - 1).alias("j"), flat(F.col("start")).alias("next")), ["conv", "j"], "left")
        stale = F.col("next").isNotNull() & (flat(F.col("used")) != F.col("next"))
        pairs = stored(pairs.select("conv", "j", "used", "start", "next", stale.alias("stale")))
        if pairs.where("stale").isEmpty():
            break
        if n == PASSES:
            left = pairs.where("stale").select("conv").distinct()
            new = composed(matched(d, left, ["conv"]).select("conv", "j", "codes"))
            state = stored(matched(state, new, ["conv", "j"], "left").select("conv", "j", F.coalesce("true_end", "used").alias("used"), "start"))
            break
        left = matched(pairs.where("stale"), d.select("conv", "j", "codes"), ["conv", "j"])
        new = left.select("conv", "j", "codes", "used", "start", "next").mapInArrow(_per_chunk(again, names, types), schema)
        state = stored(new.union(pairs.where("not stale").select("conv", "j", "used", "start")))

    def ways(r):
        gaps = run_back(r["codes"], r["used"])
        return [(r["conv"], r["j"], [trace(r["codes"], gaps, s, r["final"])[1] for s in range(4)])]
    d = matched(d, state.select("conv", "j", "used"), ["conv", "j"])
    maps = d.select("conv", "j", "codes", "used", "final").mapInArrow(
        _per_chunk(ways, ["conv", "j", "to"], [pa.int64(), pa.int32(), pa.list_(pa.int64())]), f"conv long, j int, to {VECTOR}")
    maps = stored(maps)
    # doubling: after the round of step n a chunk's map covers the 2n chunks up to it
    step, longest = 1, maps.agg(F.max("j")).first()[0] or 0
    while step < longest:
        prior = maps.select("conv", (F.col("j") + step).alias("j"), F.col("to").alias("first"))
        both = F.transform("first", lambda s: F.element_at("to", (s + 1).cast("int")))
        maps = stored(matched(maps, prior, ["conv", "j"], "left").select("conv", "j", F.coalesce(both, "to").alias("to")))
        step *= 2
    entry = maps.select("conv", (F.col("j") + 1).alias("j"), F.element_at("to", 1).cast("int").alias("entry"))
    out = matched(d, entry, ["conv", "j"], "left")
    return stored(out.select("conv", "chunk", F.col("used").alias("end"), F.coalesce("entry", F.lit(0)).alias("entry"), "final"))


def edits(chunks: DataFrame) -> DataFrame:
    """Per chunk (conv, chunk): audit, cost, illegal pairs within, first and last initial, and ``stays``, the rows after the edits."""
    known = solved(chunks) if not chunks.where("not last").isEmpty() else None
    one = F.lit(list(END)).cast(VECTOR)
    if known is None:
        d = chunks.select("*", one.alias("end"), F.lit(0).alias("entry"), F.lit(True).alias("final"))
    else:
        d = matched(chunks, known, ["conv", "chunk"], "left")
        alone = F.col("last") & (F.col("chunk") == 1)
        # chunks of forced deletions alone, and single ones, have no row there
        d = d.withColumn("final", F.coalesce("final", alone)).withColumn("entry", F.coalesce("entry", F.when(alone, 0)))
        d = d.withColumn("end", F.coalesce("end", one))

    def f(r):
        codes, extra = r["codes"], r["extra"]
        if r["entry"] is None:
            audit, stays = "D" * len(codes), []
        else:
            audit, _, stays = trace(codes, run_back(codes, r["end"]), r["entry"], r["final"])
        cost, letters, i, cut_off = 0, [], -1, 0
        for x in audit:
            letters.append(x)
            if x == "I":
                cost += INSERT
                continue
            i += 1
            cost += {"K": KEEP, "R": REROLE, "D": DELETE}[x]
            if x != "D" and codes[i] & CUT_OFF:
                cost += TRUNCATED
            if extra[i]:
                letters.append("D" * extra[i])
                cost += DELETE * extra[i]
        kinds = "".join("sua?"[c & 3] * min(2, 1 + e) for c, e in zip(codes, extra))
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:])) + sum(e - 1 for e in extra if e > 1)
        rows = [{"i": n, "turn": r["turns"][i] if i >= 0 else None, "k1": r["k1"][i] if i >= 0 else None,
                 "k2": r["k2"][i] if i >= 0 else None, "role": {"u": "user", "a": "assistant"}.get(letter)}
                for n, (i, letter) in enumerate(stays)]
        return [(r["conv"], r["chunk"], "".join(letters), cost, illegal, kinds[0], kinds[-1], rows)]
    kind = pa.list_(pa.struct([("i", pa.int32()), ("turn", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("role", pa.string())]))
    return stored(d.select("conv", "chunk", "codes", "turns", "k1", "k2", "extra", "end", "entry", "final").mapInArrow(
        _per_chunk(f, ["conv", "chunk", "audit", "cost", "illegal", "head", "tail", "stays"],
                   [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), kind]),
        "conv long, chunk long, audit string, cost long, illegal long, head string, tail string, "
        "stays array<struct<i:int,turn:long,k1:long,k2:long,role:string>>"))


def repaired_rows(rows: DataFrame, done: DataFrame) -> DataFrame:
    """The conversations after the edits: conv, chunk, i (order), role, text."""
    e = done.select("conv", "chunk", F.explode("stays").alias("s")).select("conv", "chunk", "s.*")
    texts = rows.groupBy("conv", "turn", F.xxhash64("role", "text").alias("k1"), F.xxhash64(F.lit(7), "text", "role").alias("k2")).agg(
        F.first("role").alias("own"), F.first("text").alias("text"))
    kept = matched(e.where("k1 is not null"), texts, ["conv", "turn", "k1", "k2"])
    kept = kept.select("conv", "chunk", "i", F.coalesce("role", "own").alias("role"), "text")
    return kept.union(e.where("k1 is null").select("conv", "chunk", "i", "role", F.lit("").alias("text")))


def _digest_task():
    """Arrow task over lines sorted by conversation: SHA-256 of each one's lines, taken in as they pass."""
    def run(batches):
        conv, h = None, None
        for b in batches:
            found = []
            for c, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if h is None or c != conv:
                    if h is not None:
                        found.append((conv, h.hexdigest()))
                    conv, h = c, hashlib.sha256()
                else:
                    h.update(b"\n")
                h.update(line.encode())
            yield out(found)
        if h is not None:
            yield out([(conv, h.hexdigest())])

    def out(found):
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int64()), pa.array([x for _, x in found], pa.string())],
                                          ["conv", "repaired_sha256"])
    return run


def digests(lines: DataFrame) -> DataFrame:
    """(conv, repaired_sha256). A digest is sequential by nature: a conversation's lines stream through one task, which holds
    a batch of them at a time."""
    d = lines.select("conv", "chunk", "i", F.concat("role", F.lit(":"), "text").alias("line"))
    d = d.repartition("conv").sortWithinPartitions("conv", "chunk", "i")
    return d.select("conv", "line").mapInArrow(_digest_task(), "conv long, repaired_sha256 string")


def report(ids: DataFrame, rows: DataFrame, size: int = CHUNK) -> DataFrame:
    """One row per id of ``ids`` (conv): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. ``rows`` are
    conv, turn, role, text without nulls in the last two."""
    light = stored(light_rows(rows))
    chunks = chunks_of(light, size)
    done = edits(chunks)
    zero = F.lit(0).cast("long")
    blank = F.when(F.col("blank"), F.col("copies")).otherwise(zero)
    again = F.when(F.col("blank"), zero).otherwise(F.col("copies") - F.col("first").cast("long"))
    cut_off = F.when(F.col("first") & ~F.col("blank") & F.col("cut_off"), F.lit(1)).otherwise(zero)
    turns = light.groupBy("conv", "turn").agg(F.sum(blank).alias("blank"), F.sum(again).alias("duplicate"), F.sum(cut_off).alias("truncated"))
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    faults = turns.groupBy("conv").agg(F.coalesce(span, zero).alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    order = Window.partitionBy("conv").orderBy("chunk")
    joint = F.concat(F.lag("tail").over(order), F.col("head"))
    e = done.select("conv", "chunk", "audit", "cost", (F.col("illegal") + F.coalesce((~joint.isin("su", "ua", "au")).cast("long"), zero)).alias("illegal"))
    parts = F.sort_array(F.collect_list(F.struct("chunk", "audit")))
    e = e.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
                              F.array_join(F.transform(parts, lambda x: x["audit"]), "").alias("audit"))
    out = ids.select("conv").distinct()
    for d in (faults, e, digests(repaired_rows(rows, done))):
        out = matched(out, d, ["conv"], "left")
    empty = hashlib.sha256().hexdigest()
    return out.select("conv", *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text) of the table after the damage that a row's conversation and turn decide."""
    space = F.lit(" ")
    shown = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    d = conversations.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"),
                             F.coalesce("text", space).alias("text"), (F.crc32(shown.cast("binary")) % 20).alias("c"))
    c: Column = F.col("c")
    text = F.when(c == 1, "").when(c == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(c == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    d = d.where(c != 0).select("conv", "turn", F.when(c == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("times"))
    return d.select("conv", "turn", "role", "text", F.explode("times").alias("copy")).drop("copy")


def op11(spark, sf_dir, size: int = CHUNK):
    t = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    ids = t.select(F.col("conv_id").cast("long").alias("conv"))
    return report(ids, damaged(t), size).withColumnRenamed("conv", "conv_id")
