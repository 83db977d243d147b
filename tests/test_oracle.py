"""Every registered query against its DuckDB twin on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as E
from spikeloom.plans.registry import ORACLES as SQL
from spikeloom.plans.registry import QUERIES, load_all
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest

load_all()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_duckdb(spark, con, name):
    got = digest(QUERIES[name](spark, SF_SMALL).toPandas())
    want = digest(con.execute(SQL[name]).df())
    assert got == want


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert {r["metric"] for r in rows} >= {"TOTAL_USERS", "TOTAL_POSTS", "TOTAL_FOLLOWS"}
