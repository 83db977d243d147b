"""Numbering of given rows, weighted picks, change points and SQL reports."""

import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from spikeloom.operators import numbering as N
from spikeloom.operators import segments as G
from spikeloom.plans.catalog import build_q as Q
from spikeloom.plans.registry import QUERIES
from tests.conftest import SF_CHECK, SF_SMALL


def test_numbering_equals_row_number(spark):
    df = spark.range(0, 3000, 1, 7).select((F.col("id") * 7919 % 100003).alias("k"), (F.col("id") % 5).alias("w"))
    for parts in (1, 3, 16):
        got = sorted((r.k, r.n, r.start) for r in N.numbered(df, ["k"], weight="w", parts=parts).collect())
        total = 0
        for i, (k, w) in enumerate(sorted(map(tuple, df.collect())), 1):
            assert got[i - 1] == (k, i, total)
            total += w


def test_one_hot_key_is_many_ranges(spark):
    df = spark.range(0, 4000).select(F.when(F.col("id") % 10 > 0, 1).otherwise(F.lit(None)).alias("k"), "id")
    out = N.numbered(df, ["k"], parts=8).collect()
    assert sorted(r.n for r in out) == list(range(1, 4001))
    assert max(r.n for r in out if r.k is None) == 400      # nulls first
    d = df.withColumn("t", F.xxhash64("id")).repartitionByRange(8, "k", "t").withColumn("p", F.spark_partition_id())
    assert d.groupBy("p").count().agg(F.max("count")).first()[0] < 1000
    assert N.numbered(df.where("false"), ["k"], weight="id").count() == 0


def test_weighted_picks(spark):
    weights = spark.createDataFrame([("hot", 6000), ("a", 1000), ("b", 2500), ("c", 500), ("none", 0), ("minus", -5), ("null", None)], "k string, w long")
    n = 20_000
    rows = spark.range(n).withColumnRenamed("id", "row")
    got = {r.picked: r["count"] for r in N.weighted_pick(rows, "row", weights, "k", "w", 3, "t", chunk_rows=2).groupBy("picked").count().collect()}
    assert sum(got.values()) == n and set(got) == {"hot", "a", "b", "c"}
    for k, p in (("hot", 0.6), ("a", 0.1), ("b", 0.25), ("c", 0.05)):
        assert abs(got[k] - n * p) < 4 * math.sqrt(n * p * (1 - p))
    assert N.weighted_pick(rows.limit(5), "row", weights.where("w <= 0"), "k", "w", 3, "t").where("picked IS NULL").count() == 5


def cheapest(values, penalty):
    """The least cost over all cuts, without any shortcut."""
    best = [0.0]
    for j in range(1, len(values) + 1):
        best.append(min(best[i] + float(((values[i:j] - values[i:j].mean()) ** 2).sum()) + penalty for i in range(j)))
    return best[-1]


def test_segments_are_cheapest():
    rnd = np.random.default_rng(4)
    for _ in range(30):
        v = np.concatenate([rnd.poisson(m, rnd.integers(1, 15)) for m in rnd.integers(1, 60, rnd.integers(1, 5))]).astype(float)
        cuts = G.best_cuts(v, 30.0)
        assert cuts[0] == 0 and cuts == sorted(set(cuts))
        cost = sum(((v[a:b] - v[a:b].mean()) ** 2).sum() + 30.0 for a, b in zip(cuts, [*cuts[1:], len(v)]))
        assert abs(cost - cheapest(v, 30.0)) < 1e-6


def test_change_points_find_the_burst(spark):
    got = sorted(QUERIES["change_points"](spark, SF_CHECK).collect(), key=lambda r: r.first_day)
    peak = max(got, key=lambda r: r["mean"])
    start, end = (dt.datetime.combine(d, dt.time()) for d in (Q.STORY.peak_start, Q.STORY.peak_end))
    assert abs((peak.first_day - start).days) <= 3 and abs((peak.last_day - end).days) <= 4
    d0 = dt.datetime(2024, 1, 1)
    rows = [("x", d0 + dt.timedelta(days=i), 2 if i < 20 else 40) for i in range(40) if i != 5] + [("flat", d0, 3), (None, d0, 1), (None, None, 1)]
    out = G.change_points(spark.createDataFrame(rows, "s string, day timestamp_ntz, n long"), "day", "n", "s").collect()
    # the missing day counts as none, which is no level of its own
    assert sorted((str(r.s), (r.first_day - d0).days, r.days) for r in out) == [("None", 0, 1), ("flat", 0, 1), ("x", 0, 20), ("x", 20, 20)]
    assert G.change_points(spark.createDataFrame([], "s string, day timestamp_ntz, n long"), "day", "n", "s").count() == 0


def test_both_forms_of_the_report(spark):
    a, b = (sorted(map(tuple, QUERIES[n](spark, SF_SMALL).collect())) for n in ("period_report", "period_report_in_sql"))
    assert a == b


def test_shares_are_exact_in_every_group(spark):
    from spikeloom.params import ROLES_BY_PERIOD_E
    sizes = {"pre": 1003, "peak": 17, "post": 1}
    rows = [(i, p) for p, n in sizes.items() for i in range(n)] + [(5000, None), (5001, "other")]
    rows = [(n, p) for n, (_, p) in enumerate(rows)]
    df = spark.createDataFrame(rows, "id long, period string")
    a, b = (sorted(map(tuple, N.exact_shares(df, "id", "period", ROLES_BY_PERIOD_E, 7, chunk_rows=c).collect()), key=repr) for c in (1_000_000, 50))
    assert a == b and len(a) == len(rows)
    for p, n in sizes.items():
        weights = ROLES_BY_PERIOD_E[p]
        total = sum(w for _, w in weights)
        for value, w in weights:
            assert abs(sum(r[1] == p and r[2] == value for r in a) - n * w / total) < 1
    assert {r[2] for r in a if r[1] in (None, "other")} == {None}
