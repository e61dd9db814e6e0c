"""Staged Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_staged(spark: SparkSession, path: str, indicators: Sequence[str] | None = None) -> DataFrame:
    """A staged folder partitioned by ``indicator``; only the wanted partitions are listed and read."""
    df = spark.read.parquet(path)
    return df if indicators is None else df.where(F.col("indicator").isin(*indicators))


def project_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The wanted columns that exist; an error when none does."""
    found = [c for c in cols if c in df.columns]
    if not found:
        raise ValueError(f"none of the requested columns exist: {list(cols)}")
    return df.select(*[F.col(f"`{c}`") for c in found])
