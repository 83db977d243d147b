"""Edge tables (L1-L3) and an exact "first n by key" (D4, H3).

`unique_edges` takes the first n distinct pairs of given candidates. `uniform_edges` and `degree_edges` need no
candidates to throw away: a keyed permutation numbers all pairs, or all partners of a node, so pairs
are distinct by construction and their number is exact.
"""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spikeloom.functions.draws import draw_int, draw_int_sql, draw_uniform, draw_uniform_sql
from spikeloom.operators.joins import pick_eligible
from spikeloom.operators.timeline import expand_counts
from spikeloom.params import GrowthParams
from spikeloom.session import stored

HIST_BLOCKS = 4096


def first_n_by(df: DataFrame, key: str, n: int, blocks: int = HIST_BLOCKS, rows_ranked: int = 1_000_000) -> DataFrame:
    """The ``n`` rows with the smallest unique integer ``key``, without a global sort. ``df`` is read a few times: give
    stored rows.

    A histogram of key blocks (at most ``blocks`` rows) finds the block where the running count
    passes n. While that block holds more than ``rows_ranked`` rows it is cut into blocks in turn; then
    only its rows are ranked, to find the last key that stays. Works for any n.
    """
    if n <= 0:
        return df.limit(0)
    rng = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    if rng["lo"] is None:
        return df
    lo, hi, need, inside = int(rng["lo"]), int(rng["hi"]), n, df
    while True:
        width = max(1, math.ceil((hi - lo + 1) / blocks))
        hist = inside.groupBy(F.floor((F.col(key) - F.lit(lo)) / F.lit(width)).cast("bigint").alias("b")) \
            .agg(F.count(F.lit(1)).alias("c")).orderBy("b").collect()
        for r in hist:
            if need <= r["c"]:
                break
            need -= r["c"]
        else:
            return df
        lo, hi = lo + r["b"] * width, lo + (r["b"] + 1) * width - 1
        inside = df.where(F.col(key).between(lo, hi))
        if r["c"] <= rows_ranked or width == 1:
            break
    last = inside.select(key).orderBy(key).limit(need).agg(F.max(key)).first()[0]
    return df.where(F.col(key) <= F.lit(last))


def distinct_pairs(cands: DataFrame) -> DataFrame:
    """Self pairs out, one row per (a, b) with its first candidate id."""
    return cands.where(F.col("a") != F.col("b")).groupBy("a", "b").agg(F.min("cid").alias("cid"))


def unique_edges(cands: DataFrame, n: int) -> DataFrame:
    """L1 from candidates (cid, a, b): the first n distinct non-self pairs in the order of their first candidate. A hot
    pair folds before the shuffle; the pairs are stored once, the cut reads files. Fewer than n: all."""
    return first_n_by(stored(distinct_pairs(cands)), "cid", n).select("a", "b", "cid")


# --- pairs without drawing twice: a keyed permutation ------------------------------------------

ROUNDS = 4
WALKS = 64      # steps outside the range after which a walk is given up with an error


def sides(n: Column) -> tuple[Column, Column]:
    """Sides a, b of a rectangle that holds n numbers: a * b >= n, and less than a + 1 numbers too many."""
    a = F.greatest(F.lit(1), F.ceil(F.sqrt(n.cast("double")))).cast("bigint")
    return a, F.ceil((n / a)).cast("bigint")


def _round(i: int, left: Column, right: Column, a: Column, b: Column, seed: int, tag: str, key: Column) -> tuple[Column, Column]:
    """One round of the network: shifts one half by a draw on the other, so it can be undone."""
    other, size = (right, a) if i % 2 == 0 else (left, b)
    shift = draw_int(draw_uniform(seed, f"{tag}{i}", F.concat_ws("/", key.cast("string"), other.cast("string"))), 0, size)
    return ((left + shift) % a, right) if i % 2 == 0 else (left, (right + shift) % b)


def _feistel(x: Column, a: Column, b: Column, seed: int, tag: str, key: Column) -> Column:
    """One pass of the network over a x b as one expression. It repeats its rounds: 11 hashes."""
    left, right = F.floor(x / b).cast("bigint"), x % b
    for i in range(ROUNDS):
        left, right = _round(i, left, right, a, b, seed, tag, key)
    return left * b + right


def _walked(first: Column, n: Column, seed: int, tag: str, key: Column) -> Column:
    """``first``, or where that lies outside 0..n-1, the next place inside on the walk from it."""
    a, b = sides(n)
    far = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), first, lambda v, _: F.when(v < n, v).otherwise(_feistel(v, a, b, seed, tag, key)))
    far = F.when(far < n, far).otherwise(F.raise_error(F.lit("permuted: walk too long")).cast("bigint"))
    return F.when(first < n, first).otherwise(far)


def permuted(x: Column, n: Column, seed: int, tag: str, key: Column) -> Column:
    """A seeded permutation of 0..n-1, one per ``key``, at the place x: a Feistel network over the smallest near-square that
    holds n numbers, walked on while it lands outside (seldom: a share of one in the square's side). For few rows; many
    take `with_permuted`."""
    return _walked(_feistel(x, *sides(n), seed, tag, key), n, seed, tag, key)


def with_permuted(df: DataFrame, out: str, x: Column, n: Column, seed: int, tag: str, key: Column) -> DataFrame:
    """Adds `permuted` as a column ``out`` to many rows. Each round is a projection of its own, so a row hashes once per
    round in compiled code; only rows that land outside enter the walk."""
    a, b = sides(n)
    rows = df.withColumns({"__left": F.floor(x / b).cast("bigint"), "__right": x % b})
    for i in range(ROUNDS):
        left, right = _round(i, F.col("__left"), F.col("__right"), a, b, seed, tag, key)
        rows = rows.withColumns({"__left": left, "__right": right})
    rows = rows.withColumn("__first", F.col("__left") * b + F.col("__right"))
    return rows.withColumn(out, _walked(F.col("__first"), n, seed, tag, key)).drop("__left", "__right", "__first")


def _place(c: Column) -> Column:
    """A place, typed as never null (-1 for none): the null check that a join on it adds would be pushed below the
    permutation, and so repeat it."""
    return F.coalesce(c, F.lit(-1).cast("bigint"))


def uniform_edges(spark: SparkSession, n: int, n_nodes: int, seed: int, tag: str = "pairs", rows_per_part: int = 1_000_000) -> DataFrame:
    """L1 without drawing twice: n distinct ordered pairs (eid, a, b) of different nodes 0..n_nodes-1, uniform over all
    pairs. Pair number ``eid`` goes through a keyed permutation of all pairs, so no two rows meet: no
    aggregate, no shuffle, no loop, and more edges never change the first ones."""
    every = n_nodes * (n_nodes - 1)
    if n > every:
        raise ValueError(f"{n} edges requested but only {every} pairs exist")
    parts = max(1, math.ceil(n / rows_per_part), spark.sparkContext.defaultParallelism if n > 0 else 1)
    e = spark.range(0, n, 1, parts).withColumnRenamed("id", "eid")
    e = with_permuted(e, "__p", F.col("eid"), F.lit(every).cast("bigint"), seed, tag, F.lit(""))
    a, r = F.floor(F.col("__p") / (n_nodes - 1)).cast("bigint"), F.col("__p") % (n_nodes - 1)
    return e.select("eid", _place(a).alias("a"), r.alias("__r")).select(
        "eid", "a", _place(F.col("__r") + (F.col("__r") >= F.col("a")).cast("bigint")).alias("b"))


def degree_edges(degrees: DataFrame, key: str, place: str, degree: str, n_nodes: int, seed: int, tag: str = "out",
                 chunk_rows: int = 250_000) -> DataFrame:
    """Edges with given out-degrees: (key, k, b): node ``key`` at ``place`` 0..n_nodes-1 points at as many different others as its
    degree says (at most n_nodes - 1), b being their places. Each node walks its own permutation of the others, so partners
    are distinct by construction; a node with very many is expanded in chunks by many tasks."""
    d = degrees.select(key, F.col(place).cast("bigint").alias("__at"), F.least(F.col(degree), F.lit(n_nodes - 1)).cast("bigint").alias("__d"))
    rows = expand_counts(d, "__d", chunk_rows, "k")
    rows = with_permuted(rows, "__o", F.col("k"), F.lit(n_nodes - 1).cast("bigint"), seed, tag, F.col("__at"))
    return rows.select(key, "k", _place(F.col("__o") + (F.col("__o") >= F.col("__at")).cast("bigint")).alias("b"))


def feistel_walk_sql(src: str, n: str, seed: int, tag: str, key: str) -> str:
    """DuckDB twin: ``src`` has columns x and whatever else; the result is a WITH RECURSIVE item ``walk`` whose rows with
    done hold the permuted x. ``n`` is a scalar, ``key`` the permutation's key."""
    a = f"CAST(greatest(1, ceil(sqrt(CAST({n} AS DOUBLE)))) AS BIGINT)"
    b = f"CAST(ceil({n} / {a}) AS BIGINT)"
    body = f"(SELECT *, x // {b} AS l0, x % {b} AS r0 FROM frontier)"
    names = "l0", "r0"
    for i in range(ROUNDS):
        l, r = names
        other, size = (r, a) if i % 2 == 0 else (l, b)
        u = draw_uniform_sql(seed, f"{tag}{i}", f"concat_ws('/', CAST({key} AS VARCHAR), CAST({other} AS VARCHAR))")
        shift = draw_int_sql(u, 0, size)
        new = f"l{i + 1}", f"r{i + 1}"
        body = (f"(SELECT *, {f'({l} + {shift}) % {a}' if i % 2 == 0 else l} AS {new[0]}, "
                f"{r if i % 2 == 0 else f'({r} + {shift}) % {b}'} AS {new[1]} FROM {body})")
        names = new
    drop = ", ".join(f"l{i}, r{i}" for i in range(ROUNDS + 1))
    out = f"{names[0]} * {b} + {names[1]}"
    step = body.replace("frontier", "(SELECT * FROM walk WHERE NOT done)")
    return (f"walk AS (SELECT * EXCLUDE ({drop}) REPLACE ({out} AS x), {out} < {n} AS done FROM {body.replace('frontier', src)} "
            f"UNION ALL SELECT * EXCLUDE ({drop}) REPLACE ({out} AS x, {out} < {n} AS done) FROM {step})")


def add_reciprocal(edges: DataFrame, q: float, seed: int, tag: str = "reverse",
                   a: str = "a", b: str = "b", key: str = "cid") -> DataFrame:
    """L2: keep one direction per unordered pair, then add the reverse of a fraction q of them:
    mutual rows are then 2q/(1+q) of the table (q = s/(2-s) for a target share s).

    Output key ``ekey = 2*key (+1 for a reversed row)`` stays unique and ordered.
    """
    lo, hi = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    rest = [c for c in edges.columns if c != key]
    one_way = edges.groupBy(lo.alias("__lo"), hi.alias("__hi")).agg(F.min(F.struct(key, *rest)).alias("__e"))
    one_way = one_way.select(*[F.col("__e").getField(c).alias(c) for c in edges.columns])
    forward = F.struct(F.col(a).alias("x"), F.col(b).alias("y"), (F.col(key) * 2).alias("ekey"))
    back = F.struct(F.col(b).alias("x"), F.col(a).alias("y"), (F.col(key) * 2 + 1).alias("ekey"))
    ways = F.when(draw_uniform(seed, tag, key) < F.lit(float(q)), F.array(forward, back)).otherwise(F.array(forward))
    out = one_way.withColumn("__w", F.explode(ways))
    others = [c for c in edges.columns if c not in (a, b)]
    return out.select(F.col("__w.x").alias(a), F.col("__w.y").alias(b), *others, F.col("__w.ekey").alias("ekey"))


def activated_follows(users: DataFrame, peak_start: str, peak_end: str, p: GrowthParams) -> DataFrame:
    """L3: users (id, created_at) follow with the probability of their join period; the followee is
    drawn among users joined at most ``follow_lead_days`` after the follower, the date 0 to
    ``follow_shift_days`` - 1 days after joining. One follow per follower at most."""
    ts, after = F.col("created_at"), F.datediff(F.to_date("created_at"), F.to_date(F.lit(peak_end)))
    chance = (F.when(ts < F.lit(peak_start).cast("timestamp_ntz"), F.lit(p.follow_p_pre))
              .when(ts < F.lit(peak_end).cast("timestamp_ntz"), F.lit(p.follow_p_peak))
              .otherwise(F.lit(p.follow_p_post) * F.exp(F.lit(-p.follow_decay) * after)))
    f = users.where(draw_uniform(p.seed, "follow_p", "id") < chance).select("id", "created_at")
    f = pick_eligible(f, "id", "created_at", users, "id", "created_at", p.seed, "followee",
                      lead_days=p.follow_lead_days, self_key="id").where("picked <> id")
    day = F.date_add(F.to_date("created_at"), draw_int(draw_uniform(p.seed, "follow_day", "id"), 0, p.follow_shift_days).cast("int"))
    return f.select(F.col("id").alias("following_user_id"), F.col("picked").alias("followed_user_id"),
                    day.cast("timestamp_ntz").alias("created_at"))
