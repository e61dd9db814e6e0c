"""WARC archives as a Python data source: written and read as files of records, each a gzip member of its own."""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, Not,
    WriterCommitMessage,
)

from flowmart.llm.common import shared_dir, small_batches, stored
from flowmart.streams import file_system, list_files, open_stream

#: Columns of a record. ``payload`` comes last and is the only one that needs the record's body decoded.
SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, payload_digest string, refers_to string, page_id long, "
    "content_length long, payload_bytes long, payload binary"
)
#: Headers behind the columns that predicates may name.
HEADERS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
    "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to",
}
MANIFEST = "_manifest"
#: A task reads files of about so many bytes together; a writer starts a new file beyond it.
FILE_BYTES = 128 << 20
#: Bytes of a body that are inflated or skipped at a time.
STEP = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def page_uri(page_id: int) -> str:
    return f"<urn:page:{page_id}>"


def page_of(uri: str | None) -> int | None:
    return int(uri[len("<urn:page:"):-1]) if uri and uri.startswith("<urn:page:") else None


def base32_sha1(payload: bytes) -> str:
    import base64
    import hashlib

    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A header value in one line; bytes that would end the line are percent-encoded."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in value or "\n" in value else value


def record_bytes(kind: str, uri: str | None, payload: bytes, page_id: int | None, refers_to: int | None, date: str) -> bytes:
    """One record. A revisit has the HTTP headers of its payload but not the payload."""
    name = page_uri(page_id) if page_id is not None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{uri} {base32_sha1(payload)}')}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
    ]
    if uri is not None:
        head.append(f"WARC-Target-URI: {_clean(uri)}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {page_uri(refers_to)}"]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """A gzip member whose extra field ``sl`` tells its packed and plain length, so that a reader can step over it."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    packed = packer.compress(data) + packer.flush()
    total = 12 + 12 + len(packed) + 8
    extra = b"sl" + (8).to_bytes(2, "little") + (total & 0xFFFFFFFF).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little")
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + len(extra).to_bytes(2, "little") + extra
    return head + packed + zlib.crc32(data).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little")


class _Source:
    """Bytes of one archive in order: what is asked for is read, what is skipped is stepped over."""

    def __init__(self, file) -> None:
        self.file, self.held, self.at = file, b"", 0

    def take(self, n: int) -> bytes:
        while len(self.held) - self.at < n:
            more = self.file.read(max(STEP // 16, n))
            if not more:
                break
            self.held, self.at = self.held[self.at:] + more, 0
        got = self.held[self.at:self.at + n]
        self.at += len(got)
        return got

    def back(self, data: bytes) -> None:
        self.held, self.at = data + self.held[self.at:], 0

    def skip(self, n: int) -> None:
        here = min(n, len(self.held) - self.at)
        self.at += here
        if n > here:
            self.file.seek(self.file.tell() + n - here)


class _Plain:
    """A record's bytes in an archive that is not packed."""

    def __init__(self, source: _Source) -> None:
        self.source = source
        self.read, self.skip = source.take, source.skip

    def until(self, mark: bytes) -> bytes:
        got = b""
        while mark not in got:
            more = self.source.take(4096)
            if not more:
                return got
            got += more
        head, _, rest = got.partition(mark)
        self.source.back(rest)
        return head + mark

    def close(self) -> None:
        """Nothing to do: the next record follows."""


class _Member:
    """A record's bytes in a gzip member; the rest of a member with known length is stepped over unpacked."""

    def __init__(self, source: _Source) -> None:
        self.source, self.out, self.left = source, b"", None
        head = source.take(10)
        if head[3] & 4:
            size = int.from_bytes(source.take(2), "little")
            extra = source.take(size)
            if extra[:2] == b"sl":
                self.left = int.from_bytes(extra[4:8], "little") - 12 - size
        for flag in (8, 16):
            while head[3] & flag and source.take(1) not in (b"\0", b""):
                pass
        if head[3] & 2:
            source.take(2)
        self.inflate = zlib.decompressobj(-15)

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        data = self.source.take(STEP // 16 if self.left is None else min(STEP // 16, self.left))
        if not data:
            raise ValueError("an archive ends within a record")
        if self.left is not None:
            self.left -= len(data)
        self.out += self.inflate.decompress(data)
        return True

    def read(self, n: int) -> bytes:
        parts, have = [self.out], len(self.out)
        while have < n:
            self.out = b""
            if not self._more():
                break
            parts.append(self.out)
            have += len(self.out)
        data = b"".join(parts)
        self.out = data[n:]
        return data[:n]

    def until(self, mark: bytes) -> bytes:
        while mark not in self.out and self._more():
            pass
        head, found, self.out = self.out.partition(mark)
        return head + found

    def close(self) -> None:
        if self.left is not None:
            self.source.skip(self.left)
            return
        while not self.inflate.eof:
            self._more()
            self.out = b""
        self.source.back(self.inflate.unused_data)
        self.source.take(8)


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if v or k}


def wanted(headers: dict[str, str], filters: list[Filter]) -> bool:
    """Whether a record's headers pass the predicates; a predicate on an absent header fails, but for null-safe ones."""
    for f in filters:
        negated = isinstance(f, Not)
        inner = f.child if negated else f
        value = headers.get(HEADERS[inner.attribute[0]])
        if inner.attribute[0] == "payload_digest" and value:
            value = value.partition(":")[2] or value
        if isinstance(inner, IsNotNull):
            passed = value is not None
        elif isinstance(inner, EqualNullSafe):
            passed = value == inner.value
        elif value is None:
            return False
        else:
            passed = value in inner.value if isinstance(inner, In) else value == inner.value
        if passed == negated:
            return False
    return True


def records(file, filters: list[Filter], payload: bool) -> Iterator[tuple]:
    """The records of one open archive, packed or plain, as tuples of the schema.

    Headers are parsed first. Only for a record that passes and only if ``payload`` is asked for is the body decoded.
    """
    source = _Source(file)
    while True:
        start = source.take(2)
        while start in (b"\r\n", b"\n"):
            start = source.take(2)
        if len(start) < 2:
            return
        source.back(start)
        part = _Member(source) if start == b"\x1f\x8b" else _Plain(source)
        block = part.until(b"\r\n\r\n")
        if not block.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one should start: {block[:40]!r}")
        head = _headers(block)
        length = int(head["content-length"])
        if not wanted(head, filters):
            if isinstance(part, _Plain):
                part.skip(length)
            part.close()
            continue
        http, size, body = b"", None, None
        if "application/http" in head.get("content-type", ""):
            http = part.until(b"\r\n\r\n")
            size = int(_headers(http).get("content-length", length - len(http)))
        kind = head.get("warc-type")
        left = length - len(http)
        if payload and kind != "revisit":
            body = part.read(left)
            size = len(body) if size is None else size
        elif isinstance(part, _Plain):
            part.skip(left)
        part.close()
        digest = head.get("warc-payload-digest")
        yield (
            kind, head.get("warc-record-id"), head.get("warc-target-uri"), head.get("warc-date"),
            digest.partition(":")[2] if digest else None, head.get("warc-refers-to"), page_of(head.get("warc-record-id")), length, size, body,
        )


@dataclass
class _Files(InputPartition):
    paths: list[str]

    def __init__(self, paths: list[str]) -> None:
        super().__init__(paths)
        self.paths = paths


class WarcReader(DataSourceReader):
    """Plans partitions of whole files, takes predicates on record type and headers, and reads record by record."""

    def __init__(self, options: dict) -> None:
        self.options = options
        self.payload = options.get("payload", "true").lower() != "false"
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            inner = f.child if isinstance(f, Not) else f
            simple = isinstance(inner, (EqualTo, EqualNullSafe, In, IsNotNull)) and len(inner.attribute) == 1
            if simple and inner.attribute[0] in HEADERS:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        root = self.options["path"].rstrip("/")
        found = list_files(root)
        manifests = [name for name, _ in found if name.startswith(MANIFEST)]
        # Archives that this source did not write have no manifest: then every archive of the folder counts.
        files = [(name, size) for name, size in found if name.lower().endswith((".warc", ".warc.gz"))] if not manifests else []
        for name in manifests:
            with open_stream(f"{root}/{name}") as manifest:
                files += json.loads(manifest.read())
        groups: list[list[str]] = []
        room = 0
        for name, size in sorted(files, key=lambda x: (-x[1], x[0])):
            if not groups or size > room:
                groups.append([])
                room = FILE_BYTES
            groups[-1].append(f"{root}/{name}")
            room -= size
        return [_Files(g) for g in groups] or [_Files([])]

    def read(self, partition: _Files) -> Iterator:
        import pyarrow as pa

        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in SCHEMA.split(", ")]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        rows, size = [], 0
        for path in partition.paths:
            with open_stream(path, seekable=True) as file:
                for row in records(file, self.filters, self.payload):
                    rows.append(row)
                    size += len(row[-1] or b"") + 300
                    if size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    """Each task attempt writes files of its own; a manifest of the write names those of the attempts that count."""

    def __init__(self, options: dict, overwrite: bool = False) -> None:
        self.options, self.overwrite = options, overwrite

    def write(self, iterator: Iterator) -> _Written:
        from pyspark import TaskContext

        root = self.options["path"].rstrip("/")
        packed = self.options.get("compression", "gzip") == "gzip"
        date = self.options.get("date", "1970-01-01T00:00:00Z")
        task = TaskContext.get()
        stem = f"part-{task.partitionId():05d}-{uuid.uuid4().hex}"
        files: list[tuple[str, int]] = []
        out, size = None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                data = record_bytes(row["record_type"], row["url"], row["payload"] or b"", row["page_id"], row["refers_to"], date)
                data = gzip_member(data) if packed else data
                if out is None or size + len(data) > FILE_BYTES:
                    if out is not None:
                        out.close()
                        files[-1] = (files[-1][0], size)
                    name = f"{stem}-{len(files)}.warc{'.gz' if packed else ''}"
                    out, size = open_stream(f"{root}/{name}", write=True), 0
                    files.append((name, 0))
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
            files[-1] = (files[-1][0], size)
        return _Written(files)

    def commit(self, messages: list) -> None:
        files = [f for m in messages if m is not None for f in m.files]
        root, own = self.options["path"].rstrip("/"), f"{MANIFEST}-{uuid.uuid4().hex}.json"
        older = [name for name, _ in list_files(root) if name.startswith(MANIFEST)] if self.overwrite else []
        with open_stream(f"{root}/{own}", write=True) as out:
            out.write(json.dumps(files).encode())
        for name in older:
            system, where = file_system(f"{root}/{name}")
            system.delete_file(where)

    def abort(self, messages: list) -> None:
        """Nothing counts without a manifest."""


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)`` and ``df.write.format("warc").mode("append").save(folder)``.

    Every write adds a manifest of its own, so appending adds records; ``mode("overwrite")`` makes those before it count no more. A folder without
    a manifest is read as a listing of its ``.warc`` and ``.warc.gz`` files. Reading: ``payload=false`` leaves bodies undecoded. Writing takes page_id long, url string, record_type string,
    refers_to long, payload binary; options ``compression`` (gzip or none) and ``date``.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make the ``warc`` format known to the session, with predicates pushed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def archive(pages: DataFrame, folder: str, min_bytes: int = 0, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write one record per row of ``pages``, the payload being the page in UTF-8 (null: empty).

    Of records with equal payloads of at least ``min_bytes`` bytes, that with the largest key is a response (all of them, if
    several rows have that key; null keys rank lowest, and are responses where all are null) and the others revisit it;
    smaller payloads are all responses. Only groups that have copies meet the pages, as a table that Spark broadcasts or
    merges by its size, so a payload that very many pages share is never gathered.
    """
    spark = pages.sparkSession
    register(spark)
    small_batches(spark)
    data = F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), data.alias("payload"))
    digest = F.when(F.octet_length("payload") >= min_bytes, F.unhex(F.sha2("payload", 256))).alias("digest")
    groups = stored(
        rows.select("page_id", digest).where("digest is not null").groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("top")).where("n > 1 and top is not null").select("digest", "top")
    )
    revisits = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    rows.withColumn("digest", digest).join(groups, "digest", "left").select(
        "page_id", "url", F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("top")).alias("refers_to"), "payload",
    ).write.format("warc").mode("append").save(folder)


def read(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """The records of a folder of archives.

    Spark keeps one set of pushed predicates for each loaded DataFrame, so call this anew for each selection of records
    rather than filter one result in two ways.
    """
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)


@F.arrow_udf(T.StringType())
def _payload_digest(payload):
    import pyarrow as pa

    return pa.array([None if p is None else base32_sha1(p) for p in payload.to_pylist()], pa.string())


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Archive ``pages`` and read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Of responses the payload is decoded and measured, of revisits only headers are read. A response whose payload
    does not have the digest of its header raises. A null page_id stays null; an empty table gives no rows.
    """
    spark = pages.sparkSession
    folder = shared_dir(spark, "warc")
    archive(pages, folder, min_bytes)
    responses = read(spark, folder).where(F.col("record_type") == "response").select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), _payload_digest("payload").alias("found"), "payload_digest",
        "record_type", F.lit(None).cast("long").alias("refers_to"),
    )
    sure = F.when(F.col("found") == F.col("payload_digest"), F.col("found")).otherwise(F.raise_error(F.lit("a payload does not have its digest")))
    responses = responses.withColumn("payload_digest", sure).drop("found")
    revisits = read(spark, folder, payload=False).where(F.col("record_type") == "revisit").select(
        "page_id", "payload_bytes", "payload_digest", "record_type",
        F.regexp_extract("refers_to", "(-?[0-9]+)>$", 1).cast("long").alias("refers_to"),
    )
    return responses.select(revisits.columns).unionByName(revisits)
