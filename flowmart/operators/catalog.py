"""Profiles of tables and a data dictionary of a folder tree."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from flowmart.schema import DICTIONARY, PREAMBLE_LINES
from flowmart.session import ship_package
from flowmart.sources.landing import FILE_TOKEN
from flowmart.streams import open_stream, tag_statistics, xml_events


def _cells(df: DataFrame) -> DataFrame:
    """One (column, value) row per cell, values as text."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in df.columns]
    )
    return df.select(F.explode(cells).alias("c")).select("c.column", "c.value")


def profile(df: DataFrame, sample_n: int = 25, approx: bool = False) -> DataFrame:
    """Distinct count per column, and its first ``sample_n`` values in text order, nulls first.

    Cells are grouped by (column, value) with map-side combining, so a value that fills a third of a column is
    one row per task before the shuffle. A column's distinct values are dealt out by their hash, each share is cut to
    ``sample_n``, and only those meet; so no task sorts a whole column, whatever ``sample_n`` is. ``approx`` takes both from
    :func:`sketch`, which shuffles no cells: counts are then estimates, samples are exact.
    """
    if approx:
        return from_sketches(sketch(df, sample_n=sample_n), sample_n)
    values = _cells(df).groupBy("column", "value").agg(F.count("*").alias("n"))
    counts = values.groupBy("column").agg(F.count("value").alias("n_unique"))
    return counts.join(_first_values(values, sample_n), "column").select("column", "n_unique", "sample_values")


def _first_values(values: DataFrame, n: int) -> DataFrame:
    """(column, sample_values): the ``n`` first of the distinct (column, value) rows, dealt out by hash and cut before they meet."""
    shares = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.asc_nulls_first("value")
    own = values.withColumn("share", F.pmod(F.xxhash64("value"), F.lit(shares)))
    least = own.withColumn("i", F.row_number().over(W.partitionBy("column", "share").orderBy(order))).where(F.col("i") <= n)
    shown = least.withColumn("i", F.row_number().over(W.partitionBy("column").orderBy(order))).where(F.col("i") <= n)
    samples = shown.groupBy("column").agg(F.array_sort(F.collect_list(F.struct("i", "value"))).alias("s"))
    return samples.select("column", F.col("s.value").alias("sample_values"))


#: Buckets of a distinct-count sketch, as a power of two: 4 KB each, standard error 1.6 %.
SKETCH_LG = 12


def _least_values(batches: Iterator, columns: int, n: int) -> Iterator:
    """One task's ``n`` first distinct values of each text column, held in a buffer of that size, and whether nulls occur."""
    import pyarrow as pa
    import pyarrow.compute as pc

    held = [pa.array([], pa.string())] * columns
    for batch in batches:
        for i in range(columns):
            # Code points and UTF-8 bytes have one order, so text sorts as Spark sorts it.
            own = pc.unique(pa.concat_arrays([held[i], pc.unique(batch.column(i))]))
            held[i] = own.take(pc.array_sort_indices(own, null_placement="at_start")).slice(0, n)
    for i, values in enumerate(held):
        yield pa.RecordBatch.from_arrays([pa.array([i] * len(values), pa.int32()), values], names=["at", "value"])


def sketch(df: DataFrame, by: Sequence[str] = (), sample_n: int = 25) -> DataFrame:
    """``by``, column, n_rows, n_filled, distinct (a sketch), least: what :func:`from_sketches` needs of each part of ``df``.

    Parts are the values of ``by`` (a partition column, ``_metadata.file_path`` under a name …), or the whole table. A part's counts
    and sketches come from one native aggregate of which each task passes on one row per part; ``least`` holds the ``sample_n`` first distinct
    values in text order, nulls first. Without ``by`` they are kept in a buffer of that size in each task, so no cell is shuffled beyond
    those; with it a part's distinct values are grouped map-side and dealt out. Stored, the sketches of any parts
    can be merged later without a look at the table.
    """
    names = [c for c in df.columns if c not in by]
    keys = [F.col(f"`{c}`") for c in by]
    text = lambda c: F.col(f"`{c}`").cast("string")
    counts = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(names):
        counts += [F.count(F.col(f"`{c}`")).alias(f"f{i}"), F.hll_sketch_agg(text(c), SKETCH_LG).alias(f"d{i}")]
    wide = df.groupBy(*keys).agg(*counts)
    cells = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(c).alias("column"), F.col(f"f{i}").alias("n_filled"), F.col(f"d{i}").alias("distinct")) for i, c in enumerate(names)])
    counted = wide.select(*keys, "n_rows", F.explode(cells).alias("c")).select(*keys, "c.at", "c.column", "n_rows", "c.n_filled", "c.distinct")
    order = lambda v: F.array_sort(v, lambda a, b: F.when(a.isNull() & b.isNull(), 0).when(a.isNull(), -1).when(b.isNull(), 1).when(a < b, -1).when(a > b, 1).otherwise(0))
    if not by:
        texts = df.select(*[text(c).alias(f"c{i}") for i, c in enumerate(names)])
        firsts = texts.mapInArrow(lambda it: _least_values(it, len(names), sample_n), "at int, value string").distinct()
        named = firsts.select(F.col("at").cast("string").alias("column"), "value")
        least = _first_values(named, sample_n).select(F.col("column").cast("int").alias("at"), F.col("sample_values").alias("least"))
        return counted.join(least, "at").select("column", "n_rows", "n_filled", "distinct", "least")
    shares = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("at"), text(c).alias("value")) for i, c in enumerate(names)]))
    values = df.select(*[k.alias(f"_by{i}") for i, k in enumerate(keys)], each.alias("c")).select(*[f"_by{i}" for i in range(len(keys))], "c.at", "c.value").distinct()
    part = [*[f"_by{i}" for i in range(len(keys))], "at"]
    values = values.withColumn("share", F.pmod(F.xxhash64("value"), F.lit(shares)))
    for within in ([*part, "share"], part):
        values = values.withColumn("i", F.row_number().over(W.partitionBy(*within).orderBy(F.asc_nulls_first("value")))).where(F.col("i") <= sample_n)
    # collect_list leaves nulls out, so they are wrapped.
    least = values.groupBy(*part).agg(F.collect_list(F.struct("value")).alias("v")).select(*part[:-1], F.col("at").alias("_at"), order(F.col("v.value")).alias("least"))
    same = F.col("at") == F.col("_at")
    for i, k in enumerate(by):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"_by{i}"))
    return counted.join(least, same).select(*keys, "column", "n_rows", "n_filled", "distinct", "least")


def from_sketches(sketches: DataFrame, sample_n: int = 25) -> DataFrame:
    """column, n_unique (an estimate), sample_values, from the sketches of any parts of a table: filter them first for a subset.

    Only sketches and first values are read. ``sample_n`` may not be larger than that of the sketches.
    """
    counts = sketches.groupBy("column").agg(F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_unique"))
    values = sketches.select("column", F.explode("least").alias("value")).distinct()
    return counts.join(_first_values(values, sample_n), "column").select("column", "n_unique", "sample_values")


def overview(df: DataFrame, n: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Row count, schema and first rows, each as a DataFrame."""
    return row_count(df), schema_table(df), df.limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def schema_table(df: DataFrame) -> DataFrame:
    """Column names and types as rows."""
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"))
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return df.sparkSession.range(1).select(F.explode(rows).alias("r")).select("r.*")


def filled_counts(df: DataFrame) -> DataFrame:
    """``ordinal, column, n_filled``: how many rows have a value in each column; one aggregate."""
    names = df.columns
    seen = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column"), F.col(f"c{i}").alias("n_filled")) for i, c in enumerate(names)])
    return seen.select(F.explode(rows).alias("r")).select("r.*")


def sample_rows(df: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    """A random preview."""
    return df.sample(fraction=fraction, seed=seed)


def layer_of_path(relative: Column) -> Column:
    """``<root>/<layer>/…`` gives the layer; a file directly under the root has none."""
    return F.coalesce(F.nullif(F.regexp_extract(relative, "^[^/]+/([^/]+)/", 1), F.lit("")), F.lit("unknown"))


def landed_preamble(path: str) -> int:
    """Lines ahead of the header: landed indicator files have the usual preamble, other files none."""
    token = unquote(path).rsplit("/", 1)[-1].split("-")[0].strip()
    return PREAMBLE_LINES if re.fullmatch(FILE_TOKEN.replace("\\z", ""), token) else 0


def _delimited_columns(path: str, sep: str, skip_lines: int, all_tabs: bool) -> list[tuple[str, str]]:
    """The header's names, all text. With ``all_tabs`` every line of the file must have the header's number of tabs."""
    import csv
    import io

    with open_stream(path) as f:
        text = io.TextIOWrapper(f, "utf-8-sig", errors="replace", newline="")
        for _ in range(skip_lines):
            text.readline()
        if not all_tabs:
            return [(c.strip(), "string") for c in next(csv.reader(text, delimiter=sep), [])]
        header = text.readline().rstrip("\r\n")
        tabs = header.count("\t")
        if not tabs or any(line.count("\t") != tabs for line in text if line.strip()):
            return []
        return [(c.strip(), "string") for c in header.split("\t")]


def _xml_columns(path: str) -> list[tuple[str, str]]:
    """Columns of the flattened record, from two streamed passes that hold tag names and depths only.

    The record is the deepest tag that occurs more than once (the first such tag in the file on a tie). Its columns are its ancestors'
    attributes prefixed by their tag, its own attributes, its children's text, and their attributes prefixed by theirs.
    """
    with open_stream(path) as f:
        repeated = {tag: depth for tag, (n, depth) in tag_statistics(f).items() if n > 1}
    if not repeated:
        return []
    deepest = max(repeated.values())
    record = next(tag for tag, depth in repeated.items() if depth == deepest)
    local = lambda tag: tag.split("}")[-1]
    found: dict[str, None] = {}
    with open_stream(path) as f:
        for event, node, above in xml_events(f, record):
            if event == "end" and node.tag == record:
                for outer in reversed(above):
                    found.update({f"{local(outer.tag)}_{k}": None for k in outer.attrib})
                found.update(dict.fromkeys(node.attrib))
                for child in node:
                    found[local(child.tag)] = None
                    found.update({f"{local(child.tag)}_{k}": None for k in child.attrib})
    return [(c, "string") for c in found]


def _columns_of(path: str, kind: str, skip_lines: int) -> list[tuple[str, str]]:
    """Column names and types of one file. Only Parquet declares types; other files are text until they are read with a schema."""
    import pyarrow.parquet as pq

    if kind == ".parquet":
        with open_stream(path, seekable=True) as f:
            return [(c.name, str(c.type)) for c in pq.read_schema(f)]
    if kind in (".csv", ".csv.gz", ".csv.bz2"):
        return _delimited_columns(path, ",", skip_lines, False)
    if kind in (".tsv", ".txt"):
        return _delimited_columns(path, "\t", skip_lines, True)
    if kind == ".xml":
        return _xml_columns(path)
    return []


def data_dictionary(
    spark: SparkSession,
    root: str,
    ignored: Sequence[str] = (),
    layer_of: Callable[[Column], Column] = layer_of_path,
    skip_lines: Callable[[str], int] = landed_preamble,
    tasks: int | None = None,
) -> DataFrame:
    """Layer, path, type, table, column and column type of every file under a folder.

    Spark lists the files and its tasks read footers and headers; XML and tab-separated text is streamed whole. Folders
    named in ``ignored`` are left out (as are names that start with ``_`` or ``.``, which Spark never lists). ``skip_lines``
    gives the preamble length of a path; by default landed indicator files have one. A file that cannot be read has
    one row without a column, which says why in ``error``.
    """
    ship_package(spark)
    top = root.rstrip("/").rsplit("/", 1)[-1]
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        .select("path")
        .withColumn("table_path", F.concat(F.lit(top), F.regexp_extract("path", f"/\\Q{top}\\E(/.*)\\z", 1)))
    )
    for name in ignored:
        files = files.where(~F.concat(F.lit("/"), F.col("table_path")).contains(f"/{name}/"))
    file_name = F.regexp_extract("table_path", r"([^/]+)\z", 1)
    files = files.withColumns(
        {
            "layer": layer_of(F.col("table_path")),
            "table_filetype": F.regexp_extract(file_name, r"^[^.]+((?:[.][^.]+)*)\z", 1),
            "table_name": F.regexp_replace(file_name, r"[.][^.]*\z", ""),
        }
    )

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                lines, error = skip_lines(r.path), None
                kinds = (r.table_filetype.lower(), "." + r.table_filetype.lower().rsplit(".", 1)[-1])
                for kind in dict.fromkeys(kinds):
                    try:
                        found = _columns_of(r.path, kind, lines)
                    except Exception as e:
                        found, error = [], f"{type(e).__name__}: {e}"
                    own = (r.layer, r.table_path, r.table_filetype, r.table_name)
                    if found:
                        rows += [(*own, c, t, None) for c, t in found]
                        error = None
                        break
                if error is not None:
                    rows.append((*own, None, None, error))
            yield pd.DataFrame(rows, columns=DICTIONARY.names)

    spread = files.repartition(tasks or spark.sparkContext.defaultParallelism)
    return spread.mapInPandas(read, DICTIONARY)
