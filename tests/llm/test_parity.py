"""Corpus queries against their DuckDB twins on the smallest driver tables."""

import duckdb
import pytest

from spikeloom.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, con, name):
    assert digest(QUERIES[name](spark, SF_SMALL).toPandas()) == digest(con.execute(ORACLES[name]).df())
