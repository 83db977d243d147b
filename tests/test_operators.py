"""Operator properties on hand-made frames: stability, exact sizes, edge cases."""

import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from spikeloom.functions import draws as D
from spikeloom.functions import text as X
from spikeloom.operators import checks as J
from spikeloom.operators import edges as L
from spikeloom.operators import growth as K
from spikeloom.operators import joins as E
from spikeloom.operators import timeline as T
from spikeloom.params import ROLES
from spikeloom.sources.tables import USERS_SCHEMA


def _values(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_draws_do_not_depend_on_partitioning(spark, parts):
    base = spark.range(0, 2000, 1, 1).select(D.draw_uniform(7, "t", "id").alias("u"), "id")
    other = spark.range(0, 2000, 1, parts).select(D.draw_uniform(7, "t", "id").alias("u"), "id")
    assert _values(base, "id", "u") == _values(other, "id", "u")


def test_other_seed_other_values(spark):
    a = spark.range(100).select(D.draw_uniform(1, "t", "id").alias("u")).collect()
    b = spark.range(100).select(D.draw_uniform(2, "t", "id").alias("u")).collect()
    assert a != b


def test_categorical_shares_within_tolerance(spark):
    n = 20000
    df = spark.range(n).select(D.draw_categorical(D.draw_uniform(3, "role", "id"), ROLES).alias("role"))
    res = {r["role"]: r["ok"] for r in J.check_shares(df, "role", ROLES).collect()}
    assert res == {"regular_user": True, "content_creator": True, "influencer": True}


def test_expand_counts_zero_one_large_and_chunking(spark):
    small = spark.createDataFrame([(0, 0), (1, 1), (2, 1000)], "day long, n long")
    one = T.expand_counts(small, "n", chunk_rows=10_000)
    many = T.expand_counts(small, "n", chunk_rows=7)
    assert one.count() == 1001
    assert _values(one, "day", "offset") == _values(many, "day", "offset")
    assert many.rdd.getNumPartitions() > 1


def test_scale_to_total_is_exact(spark):
    small = spark.createDataFrame([(d, float(w)) for d, w in enumerate([1, 2, 3.3, 0, 7.25])], "day long, w double")
    for n in (0, 1, 13, 1000003):
        got = T.scale_to_total(small, "w", n, "day", "k").agg(F.sum("k")).first()[0]
        assert got == n


def test_pick_eligible_single_member_and_no_candidate(spark):
    pool = spark.createDataFrame([(10, dt.datetime(2024, 1, 5))], "id long, created_at timestamp_ntz")
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 9)),
                                  (10, dt.datetime(2024, 1, 9))], "id long, d timestamp_ntz")
    out = {r["id"]: r["picked"] for r in E.pick_eligible(rows, "id", "d", pool, "id", "created_at", 1, "t",
                                                          self_key="id").collect()}
    assert out == {1: None, 2: 10, 10: None}


def test_dense_positions_split_groups_are_a_permutation(spark):
    pool = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"))
    pos, groups = E.dense_positions(pool, "g", "k", chunk_rows=17, seed=5)
    got = sorted(r["pos"] for r in pos.collect())
    assert got == list(range(1, 501))
    # groups are contiguous blocks in group order
    bounds = {r["g"]: (r["g_start"], r["g_rows"]) for r in groups.collect()}
    for r in pos.collect():
        s, n = bounds[r["g"]]
        assert s < r["pos"] <= s + n


def test_first_n_by_equals_sorted_limit(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 100003).alias("key"))
    for n in (0, 1, 37, 4999, 5000, 9000):
        got = sorted(r["key"] for r in L.first_n_by(df, "key", n).collect())
        want = sorted(r["key"] for r in df.orderBy("key").limit(n).collect())
        assert got == want


def skewed(spark, n, nodes, seed, k=2.0):
    """Candidate pairs with popular ends."""
    u = D.digest(seed, "cand", "cid")
    return spark.range(n).withColumnRenamed("id", "cid").withColumn("__d", u).select(
        "cid", D.power_law_id(D.slice_uniform(F.col("__d"), 0), nodes, k).alias("a"), D.power_law_id(D.slice_uniform(F.col("__d"), 1), nodes, k).alias("b"))


def test_unique_edges_are_the_first_distinct_pairs(spark):
    cands = skewed(spark, 400, 20, 1)
    want, seen = [], set()
    for r in sorted(cands.collect(), key=lambda r: r.cid):
        if r.a != r.b and (r.a, r.b) not in seen:
            seen.add((r.a, r.b))
            want.append((r.a, r.b, r.cid))
    for n in (0, 1, 50, len(want), 5000):
        assert _values(L.unique_edges(cands, n), "a", "b", "cid") == sorted(want[:n])


def test_permutations_are_permutations(spark):
    for n in (1, 2, 3, 6, 17, 100, 1009):
        for key in ("x", "y"):
            got = spark.range(n).select(L.permuted(F.col("id"), F.lit(n).cast("bigint"), 5, "p", F.lit(key)).alias("y")).collect()
            assert sorted(r.y for r in got) == list(range(n))
    a, b = ([r.y for r in spark.range(200).select(L.permuted(F.col("id"), F.lit(200).cast("bigint"), seed, "p", F.lit("")).alias("y")).collect()]
            for seed in (1, 2))
    assert a != b and a != sorted(a)


def test_uniform_edges(spark):
    rows = L.uniform_edges(spark, 20 * 19, 20, 3).collect()
    assert {(r.a, r.b) for r in rows} == {(a, b) for a in range(20) for b in range(20) if a != b}
    few, more = (L.uniform_edges(spark, n, 1000, 3).collect() for n in (100, 5000))
    assert len({(r.a, r.b) for r in more}) == 5000 and all(r.a != r.b for r in more)
    assert {tuple(r) for r in few} <= {tuple(r) for r in more}
    # uniform: ends of 5,000 edges over ten blocks of nodes, within five sd
    counts = [sum(r.b // 100 == k for r in more) for k in range(10)]
    assert max(abs(c - 500) for c in counts) < 5 * (5000 * 0.1 * 0.9) ** 0.5
    assert L.uniform_edges(spark, 0, 5, 1).count() == 0
    with pytest.raises(ValueError):
        L.uniform_edges(spark, 7, 3, 1)


def test_degree_edges(spark):
    deg = spark.createDataFrame([(100 + i, i, d) for i, d in enumerate([0, 1, 5, 9, 30, 3, 3, 3, 9, 2])], "id long, place long, d long")
    rows = L.degree_edges(deg, "id", "place", "d", 10, 7, chunk_rows=4).collect()
    by = {}
    for r in rows:
        by.setdefault(r.id, []).append(r.b)
    assert {i: len(v) for i, v in by.items()} == {100 + i: min(d, 9) for i, d in enumerate([0, 1, 5, 9, 30, 3, 3, 3, 9, 2]) if d}
    assert all(len(set(v)) == len(v) and i - 100 not in v and set(v) <= set(range(10)) for i, v in by.items())


def walk_by_hand(x, n, seed, tag, key):
    """The walk over the network in plain Python."""
    a = max(1, math.ceil(math.sqrt(n)))
    b = math.ceil(n / a)
    while True:
        left, right = divmod(x, b)
        for i in range(L.ROUNDS):
            other, size = (right, a) if i % 2 == 0 else (left, b)
            u = int(hashlib.md5(f"{seed}|{tag}{i}|{key}/{other}".encode()).hexdigest()[:12], 16) / 2 ** 48
            if i % 2 == 0:
                left = (left + int(u * size)) % a
            else:
                right = (right + int(u * size)) % b
        x = left * b + right
        if x < n:
            return x


def test_permutation_in_steps_is_the_one_by_hand(spark):
    for n in (1, 2, 3, 5, 17, 101, 1009):
        rows = spark.range(3 * n).select((F.col("id") % n).alias("x"), F.floor(F.col("id") / n).alias("key"))
        size = F.lit(n).cast("bigint")
        steps = L.with_permuted(rows, "y", F.col("x"), size, 5, "p", F.col("key"))
        assert steps.columns == ["x", "key", "y"]
        want = sorted((k, x, walk_by_hand(x, n, 5, "p", k)) for k in range(3) for x in range(n))
        assert _values(steps, "key", "x", "y") == want
        assert _values(rows.withColumn("y", L.permuted(F.col("x"), size, 5, "p", F.col("key"))), "key", "x", "y") == want


def hashing(df):
    """The optimised plan's nodes that hash: the hashes of those without the walk, and the nodes with it."""
    nodes = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "md5(" in x]
    return [x.count("md5(") for x in nodes if "aggregate(" not in x], [x for x in nodes if "aggregate(" in x]


def test_degree_edges_hash_once_a_round(spark):
    """One hash per round and row, also below a join on the partner, whose null check must not repeat them."""
    nodes = spark.createDataFrame([(100 + i, i, 3) for i in range(50)], "id long, place long, d long")
    e = L.degree_edges(nodes, "id", "place", "d", 50, 7)
    rounds, walks = hashing(e.join(nodes.select(F.col("place").alias("b"), F.col("id").alias("to")), "b"))
    assert rounds == [1] * L.ROUNDS
    assert len(walks) == 1 and "Filter" not in walks[0] and walks[0].index("THEN __first") < walks[0].index("aggregate(")


def test_uniform_edges_hash_once_a_round(spark):
    nodes = spark.createDataFrame([(100 + i, i) for i in range(50)], "id long, place long")
    e = L.uniform_edges(spark, 200, 50, 7)
    for end in ("a", "b"):
        e = e.join(nodes.select(F.col("place").alias(end), F.col("id").alias(f"{end}_id")), end)
    rounds, walks = hashing(e)
    assert rounds == [1] * L.ROUNDS
    assert len(walks) == 1 and "Filter" not in walks[0] and walks[0].index("THEN __first") < walks[0].index("aggregate(")


def test_scaling_with_odd_weights(spark):
    def scaled(*weights, n=10):
        df = spark.createDataFrame([(i, w) for i, w in enumerate(weights)], "day long, w double")
        return [r["k"] for r in T.scale_to_total(df, "w", n, "day", "k").orderBy("day").collect()]
    assert scaled(0.0, 0.0) == [0, 0] and scaled(None, None) == [0, 0]
    assert scaled(None, 1.0, 0.0) == [0, 10, 0]
    for bad in (-1.0, float("nan"), float("inf")):
        with pytest.raises(Exception, match="no weight"):
            scaled(bad, 3.0)


def test_edge_checks_on_hand_made_edges(spark):
    edges = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1), (3, 4)], "a long, b long")
    assert J.check_no_self(edges, "a", "b").count() == 1
    assert _values(J.check_unique(edges, ["a", "b"]), "a", "b", "n_rows") == [(1, 2, 2)]
    r = K.reciprocity(edges, "a", "b").first()
    assert (r.edges, r.mutual_edges) == (3, 2)


def test_orphan_posts(spark):
    users = spark.createDataFrame([(1,), (2,)], "id long")
    posts = spark.createDataFrame([(10, 1), (11, 3)], "id long, user_id long")
    assert _values(J.check_foreign_key(posts, "user_id", users, "id"), "id") == [(11,)]


def test_operators_on_empty_users(spark):
    empty = spark.createDataFrame([], USERS_SCHEMA)
    assert J.check_unique(empty, ["id"]).count() == 0
    assert K.daily_counts(empty, "created_at").count() == 0
    assert K.influence_share(empty.select(F.col("id").alias("b")), "b").first()["edges"] == 0


def test_reciprocal_share_near_target(spark):
    e = L.unique_edges(skewed(spark, 20_000, 3000, 3), 4000)
    both = L.add_reciprocal(e, 0.3 / 1.7, 3)
    share = K.reciprocity(both, "a", "b").first()["mutual_share"]
    assert 0.25 < share < 0.35


def test_text_columns_fast_path_equals_expression(spark):
    df = spark.range(0, 300)
    a = _values(df.select("id", X.make_body(1, "id").alias("b")), "id", "b")
    b = _values(X.add_body(df, 1, "id", "b"), "id", "b")
    assert a == b
    a = _values(df.select("id", X.make_title(1, "id").alias("t")), "id", "t")
    b = _values(X.add_title(df, 1, "id", "t"), "id", "t")
    assert a == b
