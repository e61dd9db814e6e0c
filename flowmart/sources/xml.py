"""XML records with the attributes of their ancestors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from flowmart.session import ship_package

TEXT = "_VALUE"


class _Unique(dict):
    """Columns by name; a name that is given twice fails."""

    def __setitem__(self, name, column):
        if name in self:
            raise ValueError(f"two parts of a record would share the column {name!r}")
        super().__setitem__(name, column)


def xml_reader(spark: SparkSession, tag: str) -> DataFrameReader:
    """A reader of one row per element with the tag, all values as text."""
    reader = spark.read.format("xml").option("rowTag", tag).option("ignoreNamespace", "true")
    return reader.option("inferSchema", "false")


def record_columns(record: str, kind: T.DataType, tag: str, kept: Mapping[str, Column]) -> dict[str, Column]:
    """The kept columns and those of a record: its attributes, its children's text, and ``<child>_<attribute>``."""
    columns: dict[str, Column] = _Unique(kept)
    if not isinstance(kind, T.StructType):
        columns[tag] = F.col(record)
        return columns
    for f in kind.fields:
        at = F.col(f"{record}.{f.name}")
        if f.name.startswith("_"):
            columns[tag if f.name == TEXT else f.name[1:]] = at
        elif isinstance(f.dataType, T.StructType):
            for g in f.dataType.fields:
                name = f.name if g.name == TEXT else f"{f.name}_{g.name.lstrip('_')}"
                columns[name] = at[g.name]
        else:
            columns[f.name] = at
    return columns


def read_xml_records(
    spark: SparkSession, path: str, outer_tag: str, record_path: Sequence[str] = (), schema: T.StructType | None = None
) -> DataFrame:
    """One row per record under each ``outer_tag`` element; files are split at that tag.

    ``record_path`` leads from the outer element down to the record (empty: the outer element is the record).
    Attributes of each ancestor from the outer element down become ``<tag>_<attribute>``; those above it are read by naming a
    higher outer element, or by :func:`read_split_records`, which splits at the record itself. The record gives its attributes, its children's text, and ``<child>_<attribute>``; an attribute and
    a child that would share a column fail. Namespace prefixes are ignored. Without ``schema`` the file is read once more
    to infer one.
    """
    reader = xml_reader(spark, outer_tag)
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    kept: dict[str, Column] = {}
    node, tag = df.select(F.struct(*df.columns).alias("n0")), outer_tag
    for depth, child in enumerate(record_path):
        here = f"n{depth}"
        for f in node.schema[here].dataType.fields:
            if f.name.startswith("_") and f.name != TEXT:
                kept[f"{tag}_{f.name[1:]}"] = F.col(f"{here}.{f.name}")
        kind = node.schema[here].dataType[child].dataType
        inner = F.col(f"{here}.{child}")
        records = inner if isinstance(kind, T.ArrayType) else F.array(inner)
        node, tag = node.select("*", F.explode(records).alias(f"n{depth + 1}")), child
    record = f"n{len(record_path)}"
    columns = record_columns(record, node.schema[record].dataType, tag, kept)
    return node.select(*[c.alias(n) for n, c in columns.items()])


def tag_counts(spark: SparkSession, path: str) -> DataFrame:
    """``tag, n, depth`` over all files: how often each tag opens and how deep at most, the root being 1.

    Every file is streamed once in a task of its own, which holds tag names only; comments and texts are no tags.
    """
    ship_package(spark)

    def count(batches):
        import pandas as pd

        from flowmart.streams import open_stream, tag_statistics

        for batch in batches:
            for file in batch["path"]:
                with open_stream(file) as f:
                    rows = [(tag.split("}")[-1], n, depth) for tag, (n, depth) in tag_statistics(f).items()]
                yield pd.DataFrame(rows, columns=["tag", "n", "depth"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    each = files.repartition(spark.sparkContext.defaultParallelism).mapInPandas(count, "tag STRING, n LONG, depth INT")
    return each.groupBy("tag").agg(F.sum("n").alias("n"), F.max("depth").alias("depth"))


def record_tag(spark: SparkSession, path: str) -> str | None:
    """The deepest tag that occurs more than once, which is taken for the record; the first by name on a tie, None if none."""
    best = tag_counts(spark, path).where("n > 1").orderBy(F.desc("depth"), "tag").limit(1).collect()
    return best[0].tag if best else None
