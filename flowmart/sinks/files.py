"""File sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flowmart.operators.metrics import sort_mart
from flowmart.sinks.content import Content, Observed, content_of
from flowmart.sinks.versions import publish, read_mart


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    contract: T.StructType | None = None,
    rows_per_file: int = 0,
    row_group_bytes: int | None = None,
    content: bool = False,
) -> int | Content:
    """Write Parquet, replacing the folder, and return the row count or, with ``content``, the content, summed during the write.

    The old folder is gone while the new one is written; marts that are read meanwhile are for :func:`publish`. With a contract an empty result is an error, found before the old folder is touched.

    The contract fixes column order and types and fills absent columns with null. Partitioned output is
    rebalanced first: small partitions share tasks, and a partition value with many rows is split over several.
    """
    if contract is not None:
        df = df.to(contract)
        if df.isEmpty():
            raise ValueError(f"{path}: nothing was written")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    observed = Observed(df, None if content else {})
    writer = observed.df.write.mode("overwrite").option("compression", "snappy").partitionBy(*partition_by)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
    found = observed.content()
    return found if content else found.rows


def export_csv(df: DataFrame, path: str, gzip: bool = True, quote_all: bool = False) -> None:
    """CSV with a header, quotes doubled and null as an empty cell.

    Empty text is written as null, since an empty quoted cell is read back as null anyway.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    df = df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit("")) for c in texts})
    writer = df.write.mode("overwrite").option("header", "true").option("escape", '"').option("nullValue", "")
    writer.option("quoteAll", str(quote_all).lower()).option("compression", "gzip" if gzip else "none").csv(path)


def materialize(df: DataFrame, path: str, view: str | None = None, sort: Sequence[str] = ()) -> DataFrame:
    """Optionally name a view, publish as a new version (globally sorted when ``sort`` is given), and return the written table."""
    if view is not None:
        df.createOrReplaceTempView(view)
        df = df.sparkSession.table(view)
    publish(sort_mart(df, sort) if sort else df, path)
    return read_mart(df.sparkSession, path)


def verify_written(spark: SparkSession, path: str, expected: int | Content) -> DataFrame:
    """One row comparing what is found in the target, by the schema of its files, with what was written.

    With a row count only counts are compared. With a :class:`Content` the rows are compared as multisets by the sums of their
    hashes: ``same_content``, both fingerprints, and the columns that differ (``*`` for values exchanged between rows).
    """
    target = read_mart(spark, path)
    if isinstance(expected, int):
        found = target.agg(F.count("*").alias("n_target"))
        return found.select(F.lit(expected).cast("long").alias("n_loaded"), "n_target", (F.col("n_target") == expected).alias("passed"))
    groups = {name: sorted(target.columns) if name == "*" else [name] for name in expected.sums}
    found = content_of(target, {name: [c for c in columns if c in target.columns] for name, columns in groups.items()})
    row = (expected.rows, found.rows, expected.fingerprint, found.fingerprint, expected.differing(found), found.sums == expected.sums, found == expected)
    return spark.createDataFrame([row], (
        "n_loaded long, n_target long, fingerprint_loaded string, fingerprint_target string, differing array<string>, same_content boolean, passed boolean"
    ))
