"""Dimension reads from a database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession, url: str, query: str, props: Mapping[str, str] | None = None,
    split_on: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 8,
) -> DataFrame:
    """Rows of a query. A large one can be read in parallel ranges of a numeric column."""
    table, options = f"({query}) t", dict(props or {})
    if split_on is None:
        return spark.read.jdbc(url, table, properties=options)
    lo, hi = bounds
    return spark.read.jdbc(
        url, table, column=split_on, lowerBound=lo, upperBound=hi, numPartitions=parts, properties=options
    )
