"""Large XML files split at their records, each record with the attributes of all its ancestors.

Two passes over a file. The first streams it once and writes byte ranges of about the same length that begin with a record and end behind
one, each with the elements that are open where it begins. The second reads the ranges, many tasks to a file, and follows the elements
that open and close between the records.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from itertools import islice

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flowmart.session import ship_package, stored_with_count
from flowmart.sources.xml import record_columns

_INTERVALS = "path STRING, encoding STRING, starts ARRAY<LONG>, stops ARRAY<LONG>, above ARRAY<STRING>, columns ARRAY<STRING>"
_PACKED = (".gz", ".bz2", ".zst", ".lz4", ".xz", ".zip")


#: The most intervals in a group where each is kept by itself, so that rows of their table stay small: a reader holds thousands of them.
_KEPT = 100


def _local(name: str) -> str:
    return name.rpartition(":")[2]


def _named(tag: str, attributes) -> list[tuple[str, str]]:
    """(column, attribute) of an ancestor's attributes."""
    return [(f"{_local(tag)}_{_local(name)}", name) for name in attributes if name != "xmlns" and not name.startswith("xmlns:")]


def _attributes(above) -> dict[str, str]:
    """The attributes of open elements, (name, attributes) from the root down, by column."""
    return {column: attributes[name] for tag, attributes in above for column, name in _named(tag, attributes)}


def _columns(group) -> list[str]:
    """The columns that the ancestors of a group's records have; two that would share one under the same record fail."""
    found: set[str] = set()
    for layout in {tuple((tag, *attributes) for tag, attributes in above) for _, _, above in group}:
        names: set[str] = set()
        for column, _ in (c for tag, *attributes in layout for c in _named(tag, attributes)):
            if column in names:
                raise ValueError(f"two ancestors of a record would share the column {column!r}")
            names.add(column)
        found |= names
    return sorted(found)


class RecordIntervals:
    """Collects intervals of records while a document is fed in pieces.

    An interval ends where its parent ends, where another element opens between the records, or where its group of intervals spans
    ``span`` bytes; it has the elements open above it, (name, attributes) from the root down. Memory follows the depth of the document and
    one group, not the length of the document.

    A group can be read from its first interval's elements on, unless the document has a type (``typed``): that may give attributes
    and entities which a part of the document does not show.
    """

    def __init__(self, record: str, span: int):
        from xml.parsers import expat

        self.record, self.span = record, span
        self.encoding = "utf-8"
        self.above: list[tuple[str, dict[str, str]]] = []
        self.inside = 0
        self.typed = False
        self.start: int | None = None
        self.group: list[tuple[int, int, tuple]] = []
        self.done: list[list[tuple[int, int, tuple]]] = []
        self.parser = expat.ParserCreate()
        self.parser.StartElementHandler = self._open
        self.parser.EndElementHandler = self._close
        self.parser.XmlDeclHandler = self._declared
        self.parser.EntityDeclHandler = self._entity
        self.parser.StartDoctypeDeclHandler = self._type

    def _declared(self, version, encoding, standalone):
        self.encoding = (encoding or "utf-8").lower()
        if self.encoding.replace("-", "").startswith(("utf16", "utf32", "ucs")):
            raise ValueError(f"XML in {encoding} cannot be split by bytes")

    def _entity(self, *_):
        raise ValueError("XML that declares entities cannot be split, since its records do not stand alone")

    def _type(self, *_):
        self.typed = True

    def _end_interval(self, at: int) -> None:
        if self.start is not None:
            self.group.append((self.start, at, tuple(self.above)))
            self.start = None

    def _end_group(self) -> None:
        if self.group:
            self.done.append(self.group)
            self.group = []

    def _open(self, name, attributes):
        if self.inside:
            self.inside += 1
            return
        at = self.parser.CurrentByteIndex
        if _local(name) != self.record:
            self._end_interval(at)
            self.above.append((name, attributes))
            return
        self.inside = 1
        first = self.group[0][0] if self.group else self.start
        if first is not None and (at - first >= self.span or len(self.group) >= (_KEPT if self.typed else math.inf)):
            self._end_interval(at)
            self._end_group()
        if self.start is None:
            self.start = at

    def _close(self, name):
        if self.inside:
            self.inside -= 1
            return
        self._end_interval(self.parser.CurrentByteIndex)
        self.above.pop()

    def feed(self, piece: bytes, last: bool = False) -> list[list[tuple[int, int, tuple]]]:
        """The groups of intervals that this piece ended."""
        self.parser.Parse(piece, last)
        if last:
            if self.inside or self.start is not None:
                raise ValueError("the record cannot be the root of its document")
            self._end_group()
        ready, self.done = self.done, []
        return ready


def records_below(data: bytes, encoding: str, record: str | None, above: Sequence[tuple[str, dict[str, str]]]) -> Iterator[tuple[str, dict[str, str]]]:
    """The text of each record in a byte range and the attributes of its ancestors by column, of which ``above`` are open where the range begins.

    Without a tag each top element is a record.
    """
    from xml.parsers import expat

    parser, head = expat.ParserCreate(encoding), "".join(f"<{name}>" for name, _ in above).encode(encoding)
    found: list[tuple[int, int, dict[str, str]]] = []
    open_: list[tuple[str, dict[str, str]]] = []
    held: dict[str, str] | None = None
    inside, start = 0, 0

    def opened(name, attributes):
        nonlocal inside, start, held
        if inside:
            inside += 1
            return
        at = parser.CurrentByteIndex - len(head)
        if at >= 0 and (record is None or _local(name) == record):
            inside, start = 1, at
            return
        open_.append((name, attributes) if at >= 0 else above[len(open_)])
        held = None

    def closed(name):
        nonlocal inside, held
        if not inside:
            open_.pop()
            held = None
            return
        inside -= 1
        if not inside:
            # At an end tag the index is its beginning, at an element without one it is behind the element, where no end tag can follow.
            at = parser.CurrentByteIndex - len(head)
            held = _attributes(open_) if held is None else held
            found.append((start, data.index(b">", at) + 1 if data[at:at + 2] == b"</" else at, held))

    parser.StartElementHandler, parser.EndElementHandler = opened, closed
    parser.Parse(head, False)
    parser.Parse(data, False)
    parser.Parse("".join(f"</{name}>" for name, _ in reversed(open_)).encode(encoding), True)
    for a, b, attributes in found:
        yield data[a:b].decode(encoding), attributes


def cut_records(data: bytes, encoding: str) -> Iterator[str]:
    """The text of each top element of a byte range that holds nothing else but white space, comments and instructions."""
    return (text for text, _ in records_below(data, encoding, None, [("r", {})]))


def record_intervals(spark: SparkSession, path: str, record: str, span: int = 8 << 20) -> tuple[DataFrame, int]:
    """The stored table of interval groups of all files, and its row count.

    One row per group of intervals that together span about ``span`` bytes, as one range from the first to the last, or for a document with a
    type as the intervals themselves; ``above`` holds the elements open where each begins as JSON, ``columns`` the names of all that the
    group's ancestors give. Every file is streamed once in a task of its own.
    """
    ship_package(spark)

    def find(batches):
        import pandas as pd

        from flowmart.streams import open_stream

        for batch in batches:
            for file in batch["path"]:
                if file.lower().endswith(_PACKED):
                    raise ValueError(f"{file}: a compressed file cannot be split")
                intervals = RecordIntervals(record, span)
                with open_stream(file, seekable=True) as f:
                    while True:
                        piece = f.read(1 << 20)
                        try:
                            groups = [(g, _columns(g)) for g in intervals.feed(piece, not piece)]
                        except Exception as e:
                            raise ValueError(f"{file}: {e}") from e
                        if groups:
                            rows = []
                            for g, columns in groups:
                                starts, stops, above = zip(*(g if intervals.typed else [(g[0][0], g[-1][1], g[0][2])]))
                                rows.append((file, intervals.encoding, [*starts], [*stops], [json.dumps(x) for x in above], columns))
                            yield pd.DataFrame(rows, columns=["path", "encoding", "starts", "stops", "above", "columns"])
                        if not piece:
                            break

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    found = files.repartition(spark.sparkContext.defaultParallelism).mapInPandas(find, _INTERVALS)
    return stored_with_count(found, "xml_intervals")


def read_split_records(
    spark: SparkSession, path: str, record: str, ancestors: Sequence[str] | None = None, schema: T.StructType | None = None, span: int = 8 << 20
) -> DataFrame:
    """One row per ``record`` element, wherever it lies; the files are split between records, so one huge root is read by many tasks.

    Each attribute of an ancestor, the root included, becomes the column ``<tag>_<attribute>``, null for records that lie outside such an
    element; the record's own columns are those of :func:`read_xml_records`. ``ancestors`` names the ancestor columns wanted (else all that occur, found
    from the intervals), ``schema`` the record's structure with attributes as ``_name`` (else the files are read once more to infer it).
    Records within a record belong to the outer one. Namespace prefixes are ignored. Compressed files, UTF-16, declared
    entities, a record as root, malformed files and two ancestors that share a column fail. Without records there are no rows; files of no byte are
    skipped, as Spark does. A task holds about ``span``
    bytes, or one longer record.
    """
    from flowmart.sources.xml import xml_reader

    intervals, n = record_intervals(spark, path, record, span)
    if ancestors is None:
        ancestors = sorted(r.name for r in intervals.select(F.explode("columns").alias("name")).distinct().collect())
    ancestors = list(ancestors)
    if schema is None:
        schema = xml_reader(spark, record).load(path).schema

    def read(batches):
        import pandas as pd

        from flowmart.streams import open_stream

        columns = ["record", *[f"a{i}" for i in range(len(ancestors))]]
        for batch in batches:
            for row in batch.itertuples(index=False):
                with open_stream(row.path, seekable=True) as f:
                    first = int(row.starts[0])
                    f.seek(first)
                    data = f.read(int(row.stops[-1]) - first)
                for a, b, above in zip(row.starts, row.stops, row.above):
                    found = records_below(data[a - first:b - first], row.encoding, record, json.loads(above))
                    while rows := [(text, *map(held.get, ancestors)) for text, held in islice(found, 10_000)]:
                        yield pd.DataFrame(rows, columns=columns)

    # 16 spans, 128 MB by default, to a task, but no core without work.
    size = intervals.agg(F.sum(F.element_at("stops", -1) - F.get("starts", F.lit(0)))).first()[0] or 0
    tasks = max(1, min(n, max(spark.sparkContext.defaultParallelism, size // (16 * span))))
    out = T.StructType([T.StructField("record", T.StringType()), *[T.StructField(f"a{i}", T.StringType()) for i in range(len(ancestors))]])
    texts = intervals.repartition(tasks).mapInPandas(read, out)
    parsed = texts.select(
        *[f"a{i}" for i in range(len(ancestors))],
        # A row of its own, so that the optimizer does not repeat the parse for every column.
        F.explode(F.array(F.from_xml("record", schema, {"mode": "FAILFAST", "ignoreNamespace": "true"}))).alias("n"),
    )
    columns = record_columns("n", schema, record, {c: F.col(f"a{i}") for i, c in enumerate(ancestors)})
    return parsed.select(*[c.alias(name) for name, c in columns.items()])
