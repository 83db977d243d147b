"""Invariants of the tables built over given rows (keys, references, sizes, time order)."""

import pytest
from pyspark.sql import functions as F

from spikeloom.operators import checks as J
from spikeloom.operators import growth as K
from spikeloom.plans.catalog import build_q as Q
from spikeloom.plans.enrich import build_posts, build_users
from spikeloom.session import stored
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def tables(spark):
    return {"users": stored(build_users(Q.people(spark, SF_CHECK), Q.STORY)), "posts": stored(build_posts(Q.rows_of(spark, SF_CHECK), Q.STORY)),
            "follows": Q.follows_stored(spark, SF_CHECK)}


def test_sizes_follow_the_given_rows(spark, tables):
    assert tables["users"].count() == Q.people(spark, SF_CHECK).count()
    assert tables["posts"].count() == Q.rows_of(spark, SF_CHECK).count()


def test_keys_and_references(tables):
    u, p, f = tables["users"], tables["posts"], tables["follows"]
    assert J.check_unique(u, ["id"]).count() == 0
    assert J.check_unique(p, ["id"]).count() == 0
    assert J.check_unique(f, ["following_user_id", "followed_user_id"]).count() == 0
    assert J.check_foreign_key(p, "user_id", u, "id").count() == 0
    assert J.check_foreign_key(f, "followed_user_id", u, "id").count() == 0
    assert J.check_no_self(f, "following_user_id", "followed_user_id").count() == 0
    assert J.check_not_null(u).where("null_count > 0").count() == 0


def test_nothing_before_its_user(tables):
    u = tables["users"].select(F.col("id").alias("user_id"), F.col("created_at").alias("joined"))
    assert tables["posts"].join(u, "user_id").where(F.col("created_at") < F.col("joined")).count() == 0


def test_shape_of_follows(spark, tables):
    n = tables["users"].count()
    got = K.influence_share(tables["follows"], "followed_user_id", 0.2, n).first()
    assert got["edges"] == tables["follows"].count() and got["top_share"] > 0.5
    assert 0.2 < K.reciprocity(tables["follows"], "following_user_id", "followed_user_id").first()["mutual_share"] < 0.4


@pytest.mark.parametrize("name", ["spike_ratio", "influence_share", "period_report", "reciprocity", "table_counts", "built_keys_check"])
def test_plans_stay_small(spark, name):
    from spikeloom.plans.registry import QUERIES
    plan = QUERIES[name](spark, SF_CHECK)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") < 20, (name, plan.count("Scan parquet"))
