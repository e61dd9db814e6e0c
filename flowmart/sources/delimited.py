"""Delimited text and suffix-dispatched reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, cols: Sequence[str] | None = None, sep: str = ",",
    quoted_newlines: bool = False,
) -> DataFrame:
    """CSV with a header; the declared columns are found by their name, in any order and among others.

    ``cols`` picks some of them. Only those read are parsed. A declared column that the header lacks fails, and so does a file
    of a folder whose header differs from the others. Only empty cells are null.
    """
    reader = spark.read.option("header", "true").option("sep", sep).option("escape", '"').option("multiLine", str(quoted_newlines).lower())
    header = reader.csv(path).columns
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    missing = [n for n in wanted.names if n not in header]
    if missing:
        raise ValueError(f"{path}: the header lacks {missing}")
    kinds = {f.name: f.dataType for f in wanted.fields}
    full = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in header])
    df = reader.schema(full).option("enforceSchema", "false").csv(path)
    return df.select(*[F.col(f"`{c}`") for c in (wanted.names if cols is None else cols)])


def read_delimited(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Delimited text with a header; all columns are text."""
    return spark.read.option("header", "true").option("sep", sep).option("escape", '"').csv(path)


def read_any(spark: SparkSession, path: str, infer: bool = True) -> DataFrame:
    """Parquet or (compressed) CSV by suffix; CSV types are inferred from the data unless ``infer`` is off."""
    name = path.rstrip("/").lower()
    if name.endswith(".parquet"):
        return spark.read.parquet(path)
    if name.endswith((".csv", ".csv.gz", ".csv.bz2", ".gz")):
        options = {"header": "true", "escape": '"', "inferSchema": str(infer).lower()}
        return spark.read.options(**options).csv(path)
    raise ValueError(f"unsupported file type: {path}")


def is_tab_separated(spark: SparkSession, path: str) -> bool:
    """True when all lines that are not blank hold the same number of tabs, and at least one; one pass over the text."""
    tabs = F.size(F.split("value", "\t")) - 1
    seen = spark.read.text(path).where(F.trim("value") != "").agg(F.min(tabs).alias("least"), F.max(tabs).alias("most")).first()
    return bool(seen.least) and seen.least == seen.most
