"""Wide yearly CSV files with a preamble ahead of the header, as a Python data source that reads byte ranges."""

from __future__ import annotations

import csv
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from flowmart.operators.reshape import looks_like_year
from flowmart.schema import LEADING_HEADERS, MISSING_HEADER, PREAMBLE_LINES
from flowmart.session import ship_package
from flowmart.streams import open_stream

BOM = "﻿"
#: Bytes of whole lines that a task parses at once, and bytes read at once in search of a line's end.
BLOCK_BYTES, STEP_BYTES = 16 << 20, 64 << 10
#: Suffixes of files that cannot be split.
PACKED = (".gz", ".bz2", ".zst", ".lz4")


def fix_missing_headers(cols: Sequence[str]) -> list[str]:
    """Give the usual names to placeholder headers among the first columns ahead of the years."""
    names = [str(c).strip() for c in cols]
    for i, usual in enumerate(LEADING_HEADERS):
        if i >= len(names) or looks_like_year(names[i]):
            break
        if MISSING_HEADER in names[i]:
            names[i] = usual
    return names


def _heads(skip: int):
    """Task function over (path, length): each file's header line and the byte that its data begin at; no header is null."""
    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            heads, starts = [], []
            for path in batch.column("path").to_pylist():
                with open_stream(path) as f:
                    data, lines, at = b"", 0, 0
                    while lines <= skip:
                        end = data.find(b"\n", at)
                        if end < 0:
                            more = f.read(STEP_BYTES)
                            if more:
                                data += more
                                continue
                            end = len(data)
                            if at == end:
                                break
                        line, at, lines = data[at:end], min(end + 1, len(data)), lines + 1
                heads.append(line.decode("utf-8").rstrip("\r").lstrip(BOM) if lines > skip else None)
                starts.append(at)
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array(heads, pa.string()), pa.array(starts, pa.int64())],
                                             names=["path", "length", "head", "start"])
    return read


@dataclass
class Range(InputPartition):
    """Byte ranges of files: (path, first byte, byte after the last or -1 for all, whether a line begins at the first byte)."""

    parts: list[tuple[str, int, int, bool]]


def plan_ranges(files: Sequence[tuple[str, int, int]], size: int, open_cost: int, whole: bool = False) -> list[Range]:
    """Partitions of about ``size`` bytes from (path, length, start of data): large files are cut, small ones share a partition."""
    out: list[Range] = []
    held, used = [], 0
    for path, length, start in files:
        if whole or path.lower().endswith(PACKED):
            cuts = [(path, start, -1, True)]
        else:
            cuts = [(path, at, min(at + size, length), at == start) for at in range(start, length, size)]
        for cut in cuts:
            cost = open_cost + (cut[2] if cut[2] >= 0 else length) - cut[1]
            if held and used + cost > size + open_cost:
                out.append(Range(held))
                held, used = [], 0
            held.append(cut)
            used += cost
    return [*out, Range(held)] if held else out


def line_blocks(path: str, begin: int, end: int, at_line: bool, block: int = BLOCK_BYTES) -> Iterator[bytes]:
    """Blocks of whole lines: those that begin within the range; the last one may reach beyond it."""
    packed = end < 0
    with open_stream(path, seekable=not packed) as f:
        rest = b""
        if packed:
            left = begin
            while left:
                left -= len(f.read(min(left, BLOCK_BYTES)))
        elif at_line:
            f.seek(begin)
        else:
            # The line that the range begins in belongs to the range before.
            f.seek(begin - 1)
            at = begin - 1
            while True:
                data = f.read(STEP_BYTES)
                found = data.find(b"\n")
                if found >= 0 or not data:
                    break
                at += len(data)
            if not data or at + found + 1 >= end:
                return
            begin, rest = at + len(data), data[found + 1:]
            if begin > end:
                extra = begin - end
                f.seek(end)
                begin, rest = end, rest[:-extra]
        while packed or begin < end:
            data = f.read(block if packed else min(block, end - begin))
            if not data:
                break
            begin += len(data)
            data = rest + data
            cut = data.rfind(b"\n") + 1
            if cut:
                yield data[:cut]
            rest = data[cut:]
        if rest and not packed and not rest.endswith(b"\n"):
            # Ends within a line: go on to its end.
            while True:
                data = f.read(STEP_BYTES)
                found = data.find(b"\n")
                rest += data if found < 0 else data[:found + 1]
                if found >= 0 or not data:
                    break
        if rest:
            yield rest


class WideCsvReader(DataSourceReader):
    """Reads the planned ranges; every line passes Python once, in blocks that Arrow parses."""

    def __init__(self, options) -> None:
        self.plan = json.loads(options["plan"])
        self.sep, self.cells, self.keep = options["sep"], int(options["cells"]), json.loads(options["keep"])
        self.newlines = options["newlines"] == "true"
        self.size, self.open_cost = int(options["size"]), int(options["opencost"])

    def partitions(self) -> list[InputPartition]:
        return plan_ranges([tuple(f) for f in self.plan], self.size, self.open_cost, self.newlines) or [Range([])]

    def read(self, partition: Range) -> Iterator:
        import io

        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.csv as pcsv

        names = [f"c{i}" for i in range(self.cells)]
        held = [names[i] for i in self.keep]

        def odd(row):
            if row.text is not None and not row.text.strip():
                return "skip"
            return "error"

        parse = pcsv.ParseOptions(delimiter=self.sep, newlines_in_values=self.newlines, invalid_row_handler=odd)
        convert = pcsv.ConvertOptions(
            column_types={n: pa.string() for n in names}, include_columns=held, null_values=[""], strings_can_be_null=True, quoted_strings_can_be_null=False,
        )
        for path, begin, end, at_line in partition.parts:
            blocks = line_blocks(path, begin, end, at_line)
            if self.newlines:
                blocks = [b"".join(blocks)]  # a quoted line end may stand anywhere
            for data in blocks:
                if not data.strip():
                    continue
                try:
                    table = pcsv.read_csv(
                        io.BytesIO(data), read_options=pcsv.ReadOptions(column_names=names, use_threads=False, block_size=len(data) + 1),
                        parse_options=parse, convert_options=convert,
                    )
                except pa.ArrowInvalid as e:
                    raise ValueError(f"{path}: {e}") from None
                if b'"' in data and not self.newlines and any(pc.any(pc.match_substring_regex(c, "[\r\n]")).as_py() for c in table.columns):
                    raise ValueError(f"{path}: a line ends within quotes")
                yield from table.to_batches()


class WideCsvSource(DataSource):
    """The ranges, separator and columns come as options from :func:`read_wide_csv`."""

    @classmethod
    def name(cls) -> str:
        return "wide_csv"

    def schema(self) -> str:
        return ", ".join(f"c{i} string" for i in json.loads(self.options["keep"]))

    def reader(self, schema) -> WideCsvReader:
        return WideCsvReader(self.options)


def read_wide_csv(
    spark: SparkSession, path: str, skip_lines: int = PREAMBLE_LINES, repair_header: bool = True, sep: str = ",",
    quoted_newlines: bool = False,
) -> DataFrame:
    """A CSV file, or a folder of files, whose header follows ``skip_lines`` physical lines that differ from file to file.

    Every file drops its own preamble, and all headers must agree. One small job opens each file and reads its lines up to the header; the
    driver holds the listing with the place where each file's data begin. Tasks then read byte ranges of about
    ``spark.sql.files.maxPartitionBytes`` from there on, so no line is read twice; packed files are read whole. All columns are
    text, unnamed columns (from a trailing separator) are left out, and only an empty cell is null, so the code ``NA`` is kept. A line with
    too few or too many cells fails, as do bytes that are not UTF-8. ``quoted_newlines`` allows line ends within quotes; files are then
    read whole, one in a task. Files are those that Spark lists under ``path``, on any file system that pyarrow opens.
    """
    ship_package(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    found = files.mapInArrow(_heads(skip_lines), "path string, length long, head string, start long").collect()
    found.sort(key=lambda r: r.path)
    lacking = next((r.path for r in found if r["head"] is None), path if not found else None)
    if lacking is not None:
        raise ValueError(f"{lacking}: no header after {skip_lines} lines")
    other = next((r.path for r in found if r["head"] != found[0]["head"]), None)
    if other is not None:
        raise ValueError(f"headers differ between {found[0].path} and {other}")
    header = next(csv.reader([found[0]["head"]], delimiter=sep))
    names = fix_missing_headers(header) if repair_header else [h.strip() for h in header]
    keep = [i for i, name in enumerate(names) if name]
    conf = spark._jsparkSession.sessionState().conf()
    share = sum(r.length for r in found) // max(1, spark.sparkContext.defaultParallelism)
    size = max(1, min(conf.filesMaxPartitionBytes(), max(conf.filesOpenCostInBytes(), share)))
    spark.dataSource.register(WideCsvSource)
    rows = spark.read.format("wide_csv").options(
        plan=json.dumps([(r.path, r.length, r.start) for r in found]), sep=sep, cells=len(names), keep=json.dumps(keep),
        newlines=str(quoted_newlines).lower(), size=size, opencost=conf.filesOpenCostInBytes(),
    ).load()
    return rows.toDF(*[names[i] for i in keep])
