"""Zipped CSV. A zip member cannot be split, so the unit of work is one member per task, streamed by block."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from flowmart.session import ship_package, stored_with_count
from flowmart.streams import open_stream

BLOCK_BYTES = 16 << 20


def _spread(spark: SparkSession, zip_paths: DataFrame | Sequence[str]) -> DataFrame:
    """Archive paths, one per partition when listed."""
    ship_package(spark)
    if isinstance(zip_paths, DataFrame):
        return zip_paths.select(F.col(zip_paths.columns[0]).alias("path"))
    paths = list(zip_paths)
    return spark.createDataFrame([(p,) for p in paths], "path STRING").repartition(max(len(paths), 1))


FIRST = "*first*"


def _pick(names: Sequence[str], member: str | None, path: str) -> str:
    """The named member, the first one when asked for (``FIRST``), else the only one."""
    csvs = [n for n in names if n.lower().endswith(".csv")]
    if not csvs:
        raise FileNotFoundError(f"{path}: no .csv member")
    if member == FIRST:
        return csvs[0]
    if member is not None and member not in csvs:
        raise FileNotFoundError(f"{path}: no member {member!r} among {csvs}")
    if member is None and len(csvs) > 1:
        raise ValueError(f"{path}: several .csv members, choose one: {csvs}")
    return member or csvs[0]


def _chosen(names: Sequence[str], member: str | None, path: str) -> list[str]:
    """The members to read: all that a pattern (with ``*``, ``?`` or ``[``) matches, else the one of :func:`_pick`."""
    if member is None or member == FIRST or not re.search(r"[*?\[]", member) or member in names:
        return [_pick(names, member, path)]
    found = fnmatch.filter(names, member)
    if not found:
        raise FileNotFoundError(f"{path}: no member matches {member!r}")
    return found


def _members(member: str | None, sep: str):
    """Task function over archive paths: a row for each member to read, with its bytes and its header."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import csv
        import io
        import zipfile

        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_stream(path, seekable=True) as f, zipfile.ZipFile(f) as z:
                    for name in _chosen(z.namelist(), member, path):
                        with z.open(name) as stream:
                            header = next(csv.reader(io.TextIOWrapper(stream, "utf-8-sig", newline=""), delimiter=sep), [])
                        yield pa.RecordBatch.from_pydict({"path": [path], "member": [name], "n_bytes": [z.getinfo(name).file_size], "header": [header]})
    return read


def read_zip_csv(
    spark: SparkSession,
    zip_paths: DataFrame | Sequence[str],
    schema: T.StructType | None = None,
    member: str | None = None,
    sep: str = ",",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Rows of the chosen CSV members of each archive, unchanged.

    ``member`` names one, is ``FIRST``, or is a pattern such as ``data/*.csv``, which may choose several; by default an archive must have only one.
    Archives are listed first, by their central directories, and every member is then a partition of its own, the largest first: an archive
    of 200 members uses 200 tasks. Without ``schema`` all columns of the header come as
    text, and all members must have the same header. With it the declared columns are found by name and cast; an
    absent column and a value that does not cast fail. Text is kept as it is; an empty cell is null. Quoted newlines
    are allowed. A task holds one block of text at a time.
    """
    listed, n = stored_with_count(_spread(spark, zip_paths).mapInArrow(_members(member, sep), "path STRING, member STRING, n_bytes LONG, header ARRAY<STRING>"))
    if schema is None:
        found = listed.groupBy("header").agg(F.min("path").alias("path"), F.min_by("member", "path").alias("member")).limit(2).collect()
        if len(found) != 1:
            raise ValueError(f"headers differ between {' and '.join(f'{r.member} of {r.path}' for r in found)}" if found else "no archives")
        schema = T.StructType([T.StructField(name, T.StringType()) for name in found[0].header])
    place = F.row_number().over(W.orderBy(F.desc("n_bytes"), "path", "member")) - 1
    members = listed.select("path", "member", place.alias("at")).repartitionById(max(n, 1), "at").select("path", "member")
    names = schema.names
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zipfile

        import pyarrow.csv as pc

        convert = pc.ConvertOptions(
            column_types={n: pa.string() for n in names}, include_columns=names,
            null_values=[""], strings_can_be_null=True, quoted_strings_can_be_null=True,
        )
        for batch in batches:
            for path, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_stream(path, seekable=True) as f, zipfile.ZipFile(f) as z:
                    with z.open(name) as stream:
                        reader = pc.open_csv(
                            stream, read_options=pc.ReadOptions(block_size=block_bytes),
                            parse_options=pc.ParseOptions(delimiter=sep, newlines_in_values=True), convert_options=convert,
                        )
                        yield from reader

    rows = members.mapInArrow(read, text)
    return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def zip_csv_to_parquet(
    spark: SparkSession,
    zip_paths: DataFrame | Sequence[str],
    out_dir: str,
    schema: T.StructType | None = None,
    member: str | None = None,
    sep: str = ",",
    codec: str = "snappy",
) -> DataFrame:
    """Write the archives' rows as Parquet and return the written table."""
    rows = read_zip_csv(spark, zip_paths, schema, member, sep)
    rows.write.mode("overwrite").option("compression", codec).parquet(out_dir)
    return spark.read.schema(rows.schema).parquet(out_dir)


def extract_zips(
    spark: SparkSession, zip_paths: DataFrame | Sequence[str], out_dir: str, prefix: str = ""
) -> DataFrame:
    """Extract all members, each archive in its own task and folder, with ``prefix`` ahead of the file names.

    The folder is named after the archive and a checksum of its path, so equal member names never meet. A corrupt archive fails the task before anything of it is written. Lazy: runs when the returned listing
    (``zip_path, member, path, n_bytes``) is evaluated; a repeated task overwrites its own files.
    """
    listing = "zip_path STRING, member STRING, path STRING, n_bytes LONG"

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import shutil
        import zipfile
        import zlib

        for batch in batches:
            for source in batch.column(0).to_pylist():
                stem = source.rstrip("/").rsplit("/", 1)[-1].removesuffix(".zip")
                own = f"{stem}-{zlib.crc32(source.encode()):08x}"
                with open_stream(source, seekable=True) as f, zipfile.ZipFile(f) as z:
                    bad = z.testzip()
                    if bad is not None:
                        raise zipfile.BadZipFile(f"{source}: corrupt member {bad!r}")
                    for info in z.infolist():
                        if info.is_dir():
                            continue
                        folder, _, name = info.filename.rpartition("/")
                        target = "/".join(p for p in (out_dir.rstrip("/"), own, folder, prefix + name) if p)
                        if ".." in target.split("/"):
                            raise ValueError(f"{source}: member {info.filename!r} points outside the folder")
                        with z.open(info) as member, open_stream(target, write=True) as out:
                            shutil.copyfileobj(member, out, 1 << 20)
                        yield pa.RecordBatch.from_pydict(
                            {"zip_path": [source], "member": [info.filename], "path": [target], "n_bytes": [info.file_size]}
                        )

    return _spread(spark, zip_paths).mapInArrow(extract, listing)
