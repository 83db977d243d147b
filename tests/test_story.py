"""The built story against stated targets, and operators on the cases a twin's formula can't show."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spikeloom.functions import draws as D
from spikeloom.functions import text as X
from spikeloom.operators import checks as J
from spikeloom.operators import edges as L
from spikeloom.operators import growth as K
from spikeloom.operators import joins as E
from spikeloom.operators import timeline as T
from spikeloom.plans.enrich import Story, build_follows, build_posts, build_users

STORY = Story(peak_start=dt.date(2024, 3, 1), peak_end=dt.date(2024, 3, 8))


def day(d):
    return F.timestamp_add("SECOND", F.lit(3600 * 9), F.date_add(F.lit("2024-01-01").cast("date"), d.cast("int")).cast("timestamp_ntz"))


@pytest.fixture(scope="module")
def given(spark):
    """3,000 sparse user keys that join over 60 days, and 120,000 activity rows over 120 days."""
    users = spark.range(3000).select((F.col("id") * 7 + 5).alias("id"), day(F.pmod(F.xxhash64("id"), F.lit(60))).alias("created_at"))
    rows = spark.range(120_000).select(F.col("id"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3000)) * 7 + 5).alias("user_id"),
                                       day(F.col("id") % 120).alias("created_at"))
    return users.cache(), rows.cache()


@pytest.fixture(scope="module")
def follows(given):
    users, rows = given
    return build_follows(rows, users, STORY).cache()


def test_follows_burst_in_the_peak(given, follows):
    users, rows = given
    r = {x.table_name: x for x in K.spike_ratio({"follows": follows, "rows": rows}, "created_at", "2024-03-01", "2024-03-08").collect()}
    assert r["follows"].spike_ratio >= 3 and 0.9 < r["rows"].spike_ratio < 1.1
    assert r["follows"].peak_per_day > 2 * r["follows"].post_per_day


def test_follows_shape(given, follows):
    users, _ = given
    inf = K.influence_share(follows, "followed_user_id", 0.2, 3000).first()["top_share"]
    assert 0.7 < inf < 0.9
    assert 0.25 < K.reciprocity(follows, "following_user_id", "followed_user_id").first()["mutual_share"] < 0.36
    for end in ("following_user_id", "followed_user_id"):
        assert J.check_foreign_key(follows, end, users, "id").count() == 0
    assert J.check_no_self(follows, "following_user_id", "followed_user_id").count() == 0
    assert J.check_unique(follows, ["following_user_id", "followed_user_id"]).count() == 0
    lo, hi = follows.agg(F.min("created_at"), F.max("created_at")).first()
    assert dt.datetime(2024, 1, 1) <= lo and hi < dt.datetime(2024, 5, 1)
    early = follows.join(users.select(F.col("id").alias("followed_user_id"), F.col("created_at").alias("j")), "followed_user_id")
    reversed_ok = early.where(F.to_date("created_at") < F.to_date("j"))
    # a reversed follow points at the active user, whose activity here may come before joining
    assert reversed_ok.join(follows.select(F.col("following_user_id").alias("followed_user_id"),
                                           F.col("followed_user_id").alias("following_user_id")),
                            ["followed_user_id", "following_user_id"], "left_anti").count() == 0


def test_popular_users_are_not_the_last_to_join(given, follows):
    users, _ = given
    deg = follows.groupBy(F.col("followed_user_id").alias("id")).agg(F.count(F.lit(1)).alias("d"))
    top = deg.orderBy(F.desc("d")).limit(100).join(users, "id").agg(F.avg(F.datediff("created_at", F.lit("2024-01-01")))).first()[0]
    assert 10 < top < 45


def test_users_and_posts_keep_their_rows(given):
    users, rows = given
    u, p = build_users(users, STORY), build_posts(rows.limit(5000), STORY)
    assert u.count() == 3000 and u.where("role IS NULL OR username IS NULL").count() == 0
    assert p.where("status IS NULL OR body IS NULL OR title IS NULL").count() == 0 and p.count() == 5000


def test_bodies_stay_distinct(spark):
    n = 150_000
    out = X.add_body(spark.range(n), 42, "id").agg(F.countDistinct("body")).first()[0]
    assert out > 0.99 * n


def test_scale_to_total_small_weights_and_large_totals(spark):
    small = spark.createDataFrame([(0, 0.0002), (1, 0.9998)], "day long, w double")
    assert [r["k"] for r in T.scale_to_total(small, "w", 1_000_000, "day", "k").orderBy("day").collect()] == [200, 999_800]
    wide = spark.createDataFrame([(0, 1e-9), (1, 1e9), (2, 0.5)], "day long, w double")
    got = T.scale_to_total(wide, "w", 10 ** 12, "day", "k").agg(F.sum("k")).first()[0]
    assert got == 10 ** 12


def test_pick_eligible_does_not_depend_on_chunks_and_keeps_null_dates(spark):
    pool = spark.range(400).select(F.col("id").alias("k"), day(F.col("id") % 3).alias("t"))
    rows = spark.range(180).select("id", F.when(F.col("id") % 9 > 0, day(F.col("id") % 4)).alias("d"))
    a, b = (sorted(map(tuple, E.pick_eligible(rows, "id", "d", pool, "k", "t", 3, "x", chunk_rows=c).select("id", "picked").collect()))
            for c in (50, 1_000_000))
    assert a == b and len(a) == 180
    assert all((p is None) == (i % 9 == 0) for i, p in a)


def test_first_n_by_recurses_into_the_cut(spark):
    df = spark.range(0, 20_000, 1, 5).select((F.col("id") * 7919 % 1_000_003).alias("key"))
    want = sorted(r["key"] for r in df.orderBy("key").limit(777).collect())
    assert sorted(r["key"] for r in L.first_n_by(df, "key", 777, blocks=4, rows_ranked=10).collect()) == want


def test_unknown_keys_draw_nothing(spark):
    df = spark.createDataFrame([("pre",), ("x",), (None,)], "p string")
    out = df.select("p", D.draw_categorical_by(F.lit(0.5), "p", {"pre": (("a", 1.0),), "post": (("b", 1.0),)}).alias("v")).collect()
    assert {r["p"]: r["v"] for r in out} == {"pre": "a", "x": None, None: None}


def test_draws_hit_the_key_range(spark):
    u = spark.range(20_000).select(D.draw_uniform(1, "a", "id").alias("u"), D.draw_uniform(1, "b", "id").alias("v"), "id")
    got = u.agg(*[f(c) for c in (D.power_law_id("u", 10, 7.21, 0), D.exponential_id("u", "v", 10, 4.0, 2.0, 0), D.fk_cyclic("id", 113, 10, 0))
                  for f in (F.min, F.max)]).first()
    assert tuple(got) == (0, 9, 0, 9, 0, 9)
    one = spark.range(1).select(D.avoid_self(F.lit(0), [F.lit(0)], 1, 0), D.avoid_self(F.lit(9), [F.lit(9)], 10, 0)).first()
    assert tuple(one) == (None, 0)


def test_null_references_are_no_orphans(spark):
    child = spark.createDataFrame([(1, None), (2, 7), (3, 8)], "id long, fk long")
    parent = spark.createDataFrame([(7,), (None,)], "pk long")
    assert [r["id"] for r in J.check_foreign_key(child, "fk", parent, "pk").collect()] == [3]


def test_empty_days_count(spark):
    d = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 4), dt.datetime(2024, 1, 5)]
    df = spark.createDataFrame([(x,) for x in d], "t timestamp_ntz")
    r = K.spike_ratio({"x": df}, "t", "2024-01-04", "2024-01-06").first()
    assert (r.pre_per_day, r.peak_per_day) == (0.666667, 1.0)
    assert K.spike_days(K.daily_counts(df, "t", "n"), "day", "n").count() == 5
    assert K.network_effect(df, "t", df, "t").count() == 5
    weeks = K.cohort_retention(df.select(F.lit(1).alias("k"), "t").limit(1), "k", "t", df.select(F.lit(1).alias("u"), F.col("t").alias("a")),
                               "u", "a", "week").collect()
    assert [(r.period_n, r.active_users) for r in weeks] == [(0, 1)]


def test_edges_in_one_pass(spark):
    edges = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1), (3, 4), (None, 5)], "a long, b long")
    assert sorted(map(tuple, E.reversed_edges(edges, "a", "b").collect())) == [(1, 1), (1, 2), (2, 1)]


def test_a_cluster_needs_a_shared_checkpoint_folder():
    from spikeloom.session import checkpoint_dir

    class Fake:
        class conf:
            get = staticmethod(lambda k, d=None: None)

        class sparkContext:
            master = "yarn"
    with pytest.raises(ValueError):
        checkpoint_dir(Fake)
