"""Marts that are replaced at once: each write is a version of its own, and one small file names the current one.

Layout: ``<mart>/_versions/<id>/…`` holds Parquet, ``<mart>/_current.json`` says which version counts. Readers that follow it see the old
version until the file is replaced, and the new one from then on. A failed task, a failed check or a lost
driver leaves at most a version that nobody reads. Names begin with ``_``, so that a plain read of the folder finds nothing rather than
all versions together.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from flowmart.sinks.content import Content, Observed, content_of

VERSIONS, CURRENT = "_versions", "_current.json"


@dataclass(frozen=True)
class Published:
    """The version that a write made current."""

    path: str
    content: Content

    @property
    def rows(self) -> int:
        return self.content.rows


def _place(spark: SparkSession, path: str):
    """(JVM, Hadoop path, its file system)."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _read_text(spark: SparkSession, path: str) -> str | None:
    jvm, where, system = _place(spark, path)
    if not system.exists(where):
        return None
    stream = system.open(where)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file beside the place and move it there in one step of the file system, over what is there."""
    jvm, where, system = _place(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = system.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(beside), context.makeQualified(where), options)


def current(spark: SparkSession, path: str) -> dict | None:
    """The mart's manifest: id, folder, schema, rows, fingerprint and the ids before it, newest first; None if nothing was published."""
    text = _read_text(spark, f"{path.rstrip('/')}/{CURRENT}")
    return None if text is None else json.loads(text)


def read_mart(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The current version of a published mart, or an older one by its id; a folder without a manifest is read as it is."""
    known = current(spark, path)
    if known is None:
        if version is not None:
            raise ValueError(f"{path}: no version was published")
        return spark.read.parquet(path)
    if version is not None and version not in [known["id"], *known["before"]]:
        raise ValueError(f"{path}: version {version} is not kept")
    schema = T.StructType.fromJson(known["schema"]) if version in (None, known["id"]) else None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    found = reader.parquet(f"{path.rstrip('/')}/{VERSIONS}/{version or known['id']}")
    return found if schema is None else found.select(*[f"`{c}`" for c in schema.names])


def publish(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), contract: T.StructType | None = None, keep: int = 2,
    rows_per_file: int = 0, verify: bool = True,
) -> Published:
    """Write ``df`` as a new version, check that the files hold what was written, make it current, and delete versions beyond ``keep``.

    With a contract, columns and types are its own and an empty result is an error. The content is summed while the rows are
    written and again over the files (``verify=False`` leaves that second scan out); any difference is an error, and the old version stays
    current, as it does for every error before the last step. If another write published meanwhile, this one fails.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    before = current(spark, root)
    if contract is not None:
        df = df.to(contract)
    schema = df.schema
    name = f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"
    folder = f"{root}/{VERSIONS}/{name}"
    seen = Observed(df)
    rows = seen.df.hint("rebalance", *partition_by) if partition_by else seen.df
    writer = rows.write.mode("error").option("compression", "snappy").partitionBy(*partition_by)
    try:
        (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).parquet(folder)
    except Exception:
        _delete(spark, folder)
        raise
    content = seen.content()
    if contract is not None and not content.rows:
        _delete(spark, folder)
        raise ValueError(f"{path}: nothing was written")
    if verify:
        found = content_of(spark.read.schema(schema).parquet(folder).select(*[f"`{c}`" for c in schema.names]))
        if found != content:
            raise ValueError(f"{folder}: {found.rows} rows found, {content.rows} written; differing: {', '.join(content.differing(found)) or 'the count'}")
    if (current(spark, root) or {}).get("id") != (before or {}).get("id"):
        raise RuntimeError(f"{path}: another version was published meanwhile; this one is left in {folder}")
    older = [before["id"], *before["before"]] if before else []
    manifest = {
        "id": name, "folder": f"{VERSIONS}/{name}", "schema": json.loads(schema.json()), "rows": content.rows, "fingerprint": content.fingerprint,
        "before": older[:max(0, keep - 1)],
    }
    _replace_text(spark, f"{root}/{CURRENT}", json.dumps(manifest))
    for gone in older[max(0, keep - 1):]:
        _delete(spark, f"{root}/{VERSIONS}/{gone}")
    return Published(folder, content)


def _delete(spark: SparkSession, path: str) -> bool:
    _, where, system = _place(spark, path)
    return system.delete(where, True)


def expire(spark: SparkSession, path: str, hours: float = 24) -> list[str]:
    """Delete versions that the manifest does not name and that were last touched more than ``hours`` ago; returns their ids.

    These are left by writes that failed; a write that is still running has a younger folder.
    """
    root = path.rstrip("/")
    known = current(spark, root) or {"id": None, "before": []}
    _, where, system = _place(spark, f"{root}/{VERSIONS}")
    if not system.exists(where):
        return []
    limit = (time.time() - hours * 3600) * 1000
    found = [s for s in system.listStatus(where) if s.getModificationTime() < limit]
    gone = sorted(s.getPath().getName() for s in found if s.getPath().getName() not in (known["id"], *known["before"]))
    for name in gone:
        _delete(spark, f"{root}/{VERSIONS}/{name}")
    return gone
