"""Large SDMX-JSON 2.0 documents, streamed: a task holds the code lists and one block of text, whatever the document's size."""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowmart.session import ship_package
from flowmart.streams import open_stream

BLOCK_BYTES = 1 << 20
_JSON = json.JSONDecoder()
_BLANKS = re.compile(r"\s*")


class _Text:
    """A JSON text read by blocks. What is behind the current place is let go when a block is added."""

    def __init__(self, stream, block: int):
        self.stream, self.block, self.buffer, self.at, self.ended = stream, block, "", 0, False
        self.decode = codecs.getincrementaldecoder("utf-8-sig")().decode

    def more(self) -> None:
        if self.ended:
            raise ValueError("SDMX document: it ends too early")
        # As much again as is held, so that a long value is tried few times.
        data = self.stream.read(max(self.block, len(self.buffer) - self.at))
        self.ended = not data
        self.buffer, self.at = self.buffer[self.at:] + self.decode(data, self.ended), 0

    def peek(self) -> str:
        """The next sign that is not blank."""
        while True:
            while self.at < len(self.buffer):
                if not self.buffer[self.at].isspace():
                    return self.buffer[self.at]
                self.at += 1
            self.more()

    def take(self, signs: str) -> str:
        sign = self.peek()
        if sign not in signs:
            raise ValueError(f"SDMX document: {sign!r} where one of {signs!r} is expected")
        self.at += 1
        return sign

    def value(self):
        """The next value, whole."""
        self.peek()
        while True:
            try:
                found, end = _JSON.raw_decode(self.buffer, self.at)
                if self.ended or end < len(self.buffer) and self.buffer[end] not in ".eE+-0123456789":  # a number may go on
                    self.at = end
                    return found
            except ValueError:
                if self.ended:
                    raise
            self.more()

    def skip(self) -> None:
        """Past the next value, of which no more than a block or a string is held."""
        depth = 0
        while True:
            sign = self.peek()
            if sign in "{[":
                depth += 1
            elif sign in "}]":
                depth -= 1
            elif sign not in ",:":
                self.value()
                self.at -= 1
            self.at += 1
            if not depth:
                return

    def within(self, kind: str) -> Iterator:
        """The keys of the next object (``{}``) or a None per item of the next array (``[]``); the caller takes or skips each value."""
        self.take(kind[0])
        if self.peek() == kind[1]:
            self.at += 1
            return
        while True:
            if kind == "{}":
                key = self.value()
                self.take(":")
                yield key
            else:
                yield None
            if self.take("," + kind[1]) == kind[1]:
                return

    def given(self) -> bool:
        """Whether the next value is not null; a null is passed over."""
        return self.peek() != "n" or self.value() is not None

    def items(self) -> Iterator[list]:
        """The items of the next array, in lists of those that are held whole."""
        self.take("[")
        if self.peek() == "]":
            self.at += 1
            return
        while True:
            found, sign = [], ","
            while sign == ",":
                try:
                    item, end = _JSON.raw_decode(self.buffer, _BLANKS.match(self.buffer, self.at).end())
                except ValueError:
                    break
                end = _BLANKS.match(self.buffer, end).end()
                sign = self.buffer[end:end + 1]
                if sign in ".eE+-":  # none, or a number goes on
                    break
                if sign not in ",]":
                    raise ValueError(f"SDMX document: {sign!r} behind an item")
                found.append(item)
                self.at = end + 1
            if found:
                yield found
            if sign == "]":
                return
            self.more()

    def codes(self) -> tuple[pa.Array, pa.Array]:
        """The ids and the names in the next code list, as columns, which take far less than its entries."""
        ids, names = [], []
        for found in self.items():
            entries = [e or {} for e in found]
            ids.append(_texts([e.get("id") for e in entries]))
            names.append(_texts([e.get("name") for e in entries]))
        return _joined(ids), _joined(names)

    def pass_cells(self) -> None:
        """Past the members of an object that ``cells`` can read."""
        self.take("{")
        while (end := self.buffer.find("}", self.at)) < 0:
            self.at = len(self.buffer)
            self.more()
        self.at = end + 1

    def cells(self) -> Iterator[list]:
        """The members of the next object, whose values are lists of numbers and nulls, as lists of pairs."""
        self.take("{")
        while True:
            end = self.buffer.find("}", self.at)
            cut = end if end >= 0 else self.buffer.rfind("]", self.at) + 1
            part = self.buffer[self.at:cut].strip() if cut else ""
            if part:
                found = json.loads("{" + part.removeprefix(",") + "}", object_pairs_hook=list)
                if any(type(cell) is not list for _, cell in found):
                    raise ValueError("SDMX document: an observation is no list")
                self.at = cut
                yield found
            if end >= 0:
                self.at = end + 1
                return
            self.more()


def _texts(values: list) -> pa.Array:
    """A column of texts, or of the type null where there are none; other values are given as JSON."""
    if all(v is None for v in values):
        return pa.nulls(len(values))
    try:
        return pa.array(values, pa.string())
    except (pa.ArrowInvalid, pa.ArrowTypeError):
        return pa.array([v if v is None or isinstance(v, str) else json.dumps(v) for v in values], pa.string())


def _joined(parts: list[pa.Array]) -> pa.Array:
    if any(p.type != pa.null() for p in parts):
        parts = [p.cast(pa.string()) for p in parts]
    return pa.concat_arrays(parts) if parts else pa.nulls(0)


def _structure(text: _Text) -> dict[str, list[dict]]:
    """What the next structure tells of the observations: dimensions and attributes, each with its codes as columns of ids and names."""
    out: dict[str, list[dict]] = {"dimensions": [], "attributes": []}
    for kind in text.within("{}"):
        if kind not in out:
            text.value()
            continue
        out[kind] = []
        for part in text.within("{}") if text.given() else ():
            if part != "observation":
                text.value()
                continue
            out[kind] = []
            for _ in text.within("[]") if text.given() else ():
                entry: dict = {}
                out[kind].append(entry)
                for key in text.within("{}"):
                    if key in ("id", "keyPosition"):
                        entry[key] = text.value()
                    elif key != "values":
                        text.value()
                    elif text.given():
                        entry[key] = text.codes()
    return out


def _walk(text: _Text, structure: dict | None) -> Iterator:
    """First the structure, when it is met, then lists of observations. Without a known structure those ahead of it are passed over
    and a None tells so; with one, from such a walk, the walk ends behind the observations."""
    known = structure is not None
    structures = sets = observed = 0
    for top in text.within("{}"):
        if top != "data":
            text.skip()
            continue
        for key in text.within("{}"):
            if key == "structures":
                for _ in text.within("[]"):
                    structures += 1
                    if structure is None:
                        structure = _structure(text)
                        yield structure
                    else:
                        text.skip()
            elif key == "dataSets":
                for _ in text.within("[]"):
                    sets += 1
                    for part in text.within("{}"):
                        if part != "observations":
                            text.skip()
                            continue
                        observed += 1
                        if structure is None:
                            text.pass_cells()
                            yield None
                        else:
                            yield from text.cells()
                            if known:
                                return
            else:
                text.skip()
    if structures != 1 or sets != 1 or observed != 1:
        raise ValueError("SDMX document: no observations, or several structures or data sets")


def observations(path: str, block: int = BLOCK_BYTES) -> Iterator:
    """The structure of one document, then its observations in lists of (key, cell).

    Where the structure follows the observations, as is usual, the document is streamed a second time for them; they are decoded once.
    """
    with open_stream(path) as f:
        ahead = False
        structure = None
        for found in _walk(_Text(f, block), None):
            ahead |= found is None
            structure = found if isinstance(found, dict) else structure
            if found is not None:
                yield found
    if ahead:
        with open_stream(path) as f:
            yield from _walk(_Text(f, block), structure)


_NO_CODES = (_joined([]), _joined([]))


def _entry(entries: list, name: str) -> dict:
    return next((e for e in entries if e["id"] == name), {})


def _rows(found: list, dims: list, named: int | None, status_at: int, status: pa.Array) -> list[pa.Array]:
    """The columns of decoded observations; a place outside a code list gives null."""
    def places(given: list, n: int) -> pa.Array:
        return pa.array([int(at) if at is not None and 0 <= int(at) < n else None for at in given], pa.int64())

    keys = [key.split(":") for key, _ in found]
    chosen = [places([k[at] if at is not None and at < len(k) else None for k in keys], len(ids)) for at, (ids, _) in dims]
    out = [ids.take(at).cast(pa.string()) for at, (_, (ids, _)) in zip(chosen, dims)]
    if named is not None:
        out.append(pc.coalesce(dims[named][1][1].take(chosen[named]).cast(pa.string()), out[named]))
    out.append(pa.array([cell[0] if cell else None for _, cell in found], pa.float64()))
    if status_at:
        out.append(status.take(places([cell[status_at] if status_at < len(cell) else None for _, cell in found], len(status))).cast(pa.string()))
    return out


def stream_sdmx_json(
    spark: SparkSession, path: str, dims: Sequence[str], name_dim: str | None = None, name_out: str = "counterpart_country",
    value_out: str = "value", status: str | None = "OBS_STATUS", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of :func:`decode_sdmx` from document files, each streamed by one task in the memory that its code lists take.

    For documents too large to be a row. Documents fail on the same faults: no JSON, cut off, without observations or a dimension, or with
    several structures or data sets.
    """
    ship_package(spark)
    dims = list(dims)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").orderBy("path")
    paths = [r["path"] for r in files.collect()]  # names only, as any reader lists them
    if not paths:
        raise FileNotFoundError(f"{path}: no documents")
    names = [*dims, *([name_out] if name_dim is not None else []), value_out]
    ddl = ", ".join([*[f"`{n}` string" for n in names[:-1]], f"`{value_out}` double"])
    if status is not None:
        names, ddl = [*names, "obs_status", "status_reported"], ddl + ", obs_status string, status_reported boolean"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                found = observations(file, block_bytes)
                structure = next((s for s in found if s is not None), None)
                if structure is None:
                    raise ValueError(f"SDMX document {file}: no structure")
                lists = [_entry(structure["dimensions"], d) for d in dims]
                if not all(lists):
                    raise ValueError(f"SDMX document {file}: a dimension is missing")
                places = [(e.get("keyPosition"), e.get("values", _NO_CODES)) for e in lists]
                attributes = structure["attributes"]
                status_at = 1 + next((i for i, a in enumerate(attributes) if a["id"] == status), -1)
                codes, _ = attributes[status_at - 1].get("values", _NO_CODES) if status_at else _NO_CODES
                named = dims.index(name_dim) if name_dim is not None else None
                for part in found:
                    if not part:
                        continue
                    columns = _rows(part, places, named, status_at if status is not None else 0, codes)
                    if status is not None:
                        columns += [pa.nulls(len(part), pa.string())] * (not status_at) + [pa.array([status_at > 0] * len(part), pa.bool_())]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    tasks = min(len(paths), 16 * spark.sparkContext.defaultParallelism)
    listed = spark.createDataFrame([(i % tasks, p) for i, p in enumerate(paths)], "at int, path string").repartitionById(tasks, "at")
    return listed.select("path").mapInArrow(read, ddl)
