"""Database sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flowmart.sinks.content import Content, Observed, content_of


def load_jdbc(
    df: DataFrame, url: str, table: str, types: Mapping[str, str] | None = None,
    props: Mapping[str, str] | None = None, mode: str = "error", parts: int | None = None, content: bool = False,
) -> int | Content:
    """Create a table with declared column types and fill it; by default it must not exist.

    Returns the row count or, with ``content``, the content, summed during the write.

    Spark writes per partition, each in its own transaction: for an all-or-nothing load of a small mart pass
    ``parts=1``; for a large one load a side table and swap it in the database after ``verify_load``.
    """
    observed = Observed(df if parts is None else df.coalesce(parts), None if content else {})
    writer = observed.df.write
    if types:
        writer = writer.option("createTableColumnTypes", ", ".join(f"{c} {t}" for c, t in types.items()))
    writer.jdbc(url, table, mode=mode, properties=dict(props or {}))
    found = observed.content()
    return found if content else found.rows


def verify_load(
    spark: SparkSession, url: str, table: str, expected: int | Content, props: Mapping[str, str] | None = None, schema: T.StructType | None = None,
) -> None:
    """Raise when the target's row count differs from the count loaded or, for a :class:`Content`, when its rows do.

    For their content the rows are read back and cast to ``schema``, that of the rows loaded, since databases have types of their own.
    """
    if isinstance(expected, Content):
        if schema is None:
            raise ValueError("the schema of the loaded rows is needed to compare them")
        back = spark.read.jdbc(url, table, properties=dict(props or {}))
        back = back.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
        held = content_of(back)
        if held != expected:
            what = ", ".join(expected.differing(held)) or "the count"
            raise ValueError(f"{table}: {held.rows} rows in the target, {expected.rows} loaded; differing: {what}")
        return
    query = f"(SELECT COUNT(*) AS n FROM {table}) t"
    found = spark.read.jdbc(url, query, properties=dict(props or {})).select(F.col("n").cast("long").alias("n")).first().n
    if found != expected:
        raise ValueError(f"{table}: {found} rows in the target, {expected} loaded")


def drop_jdbc(spark: SparkSession, catalog: str, table: str) -> None:
    """Roll a load back: drop the table through a configured JDBC catalog if it exists."""
    spark.sql(f"DROP TABLE IF EXISTS {catalog}.{table}")
