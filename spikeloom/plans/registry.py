"""Named queries: each one a Spark plan over the driver tables plus its DuckDB twin.

``register(name, sql)`` records a callable ``(spark, sf_dir) -> DataFrame``; ``sql`` is the
DuckDB text over the pre-registered views (None: no SQL twin, rows-only check).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from spikeloom.plans import catalog  # noqa: F401
