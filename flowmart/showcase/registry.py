"""Query registration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, the SQL with the same result."""
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


Fixture = Callable[[SparkSession, str], object]

#: Makers of the files that queries read; a benchmark runs them before its clock.
FIXTURES: list[Fixture] = []
_MADE: dict[tuple, object] = {}


def fixture(fn: Fixture) -> Fixture:
    """Make a query's input files once for each application and folder of tables."""
    def made(spark: SparkSession, sf: str):
        key = (spark.sparkContext.applicationId, fn.__name__, sf)
        if key not in _MADE:
            _MADE[key] = fn(spark, sf)
        return _MADE[key]
    FIXTURES.append(made)
    return made
