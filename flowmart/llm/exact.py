"""Exact duplicates: frequent digests are found with Misra-Gries counters and removed map-side, the rest by a shuffle."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F, types as T

from flowmart.llm.common import hash_map, map_bits, map_has, small_batches, stored, stored_with_count

#: Counters that each task keeps, and so the most digests that are ever broadcast (about 60 bytes each).
COUNTERS = 1024


def _digests(text) -> list[bytes]:
    import hashlib

    return [hashlib.sha256((t or "").encode().lower()).digest() for t in text.to_pylist()]


@F.arrow_udf(T.BinaryType())
def _digest(text):
    import pyarrow as pa

    return pa.array(_digests(text), pa.binary())


def text_digest(text) -> F.Column:
    """SHA-256 of the text in UTF-8 after lower-casing A-Z only; null counts as empty."""
    return _digest(text)


def _frequent(batches: Iterator, counters: int) -> Iterator:
    """Misra-Gries over one task's digests: at most ``counters`` remain, each count too low by at most rows / counters."""
    from collections import Counter

    import pyarrow as pa

    held: Counter = Counter()
    for batch in batches:
        held.update(batch.column(0).to_pylist())
        if len(held) > counters:
            cut = sorted(held.values(), reverse=True)[counters]
            held = Counter({d: n - cut for d, n in held.items() if n > cut})
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["digest", "n"]
        )


def heavy_digests(slim: DataFrame, rows: int, counters: int = COUNTERS) -> DataFrame:
    """(digest, n, top): the exact group of every digest that more than ``2 * rows / counters`` rows share.

    The summaries of all tasks are summed; a digest that frequent keeps more than ``rows / counters`` of its count, and
    at most ``counters`` digests can. An exact count then verifies them, so a wrong candidate costs nothing.
    """
    summary = slim.select("digest").mapInArrow(lambda it: _frequent(it, counters), "digest binary, n long")
    found = summary.groupBy("digest").agg(F.sum("n").alias("n")).where(F.col("n") * counters > rows).select("digest")
    return stored(
        slim.join(F.broadcast(found), "digest").groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "rid")).alias("top"))
        .where("n > 1")
    )


def duplicate_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the row with the largest
    key stays (null keys rank lowest); of rows that repeat key and text exactly one stays. ``keep_id`` is that row's key.
    An empty table gives no rows; other columns of ``docs`` are not read, so their names cannot clash.
    """
    small_batches(docs.sparkSession)
    slim, rows = stored_with_count(
        docs.select(F.col(key).alias("doc_id"), text_digest(F.col(text)).alias("digest"), F.monotonically_increasing_id().alias("rid"))
    )
    heavy = heavy_digests(slim, rows, counters)
    hot = slim.join(F.broadcast(heavy), "digest")
    rest = slim.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").repartition("digest")
    groups = (
        rest.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "rid")).alias("top")).where("n > 1")
    )
    one = F.struct("doc_id", "rid")
    ordinary = rest.join(groups, "digest", "left").withColumns({"n": F.coalesce("n", F.lit(1)), "top": F.coalesce("top", one)})
    return hot.select(*slim.columns, "n", "top").unionByName(ordinary.select(*slim.columns, "n", "top")).select(
        "doc_id",
        F.col("top.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("rid") == F.col("top.rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """``docs`` with all its columns, less the rows that :func:`duplicate_groups` does not keep.

    Copies of frequent texts go map-side. Of the others, the pairs of digest and key that go are known as a table and as a map of
    bits (8 MB at most): a row that is not in the map stays where it is, and only rows that may have to go meet the table.
    Where a kept key occurs on several equal rows, those rows are in the table as well and meet once more.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows_of = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    keyed = rows_of.select("row", F.col(f"row.`{key}`").alias("doc_id"), F.col(f"row.`{text}`").alias("text"))
    slim, rows = stored_with_count(keyed.select("doc_id", text_digest("text").alias("digest"), F.monotonically_increasing_id().alias("rid")))
    heavy = heavy_digests(slim, rows, counters)
    top = heavy.select("digest", F.col("top.doc_id").alias("top_id"))
    is_top = F.col("doc_id").eqNullSafe(F.col("top_id"))
    hot = stored(slim.join(F.broadcast(top), "digest").where(is_top).groupBy("digest").agg(F.first("doc_id").alias("top_id"), F.count(F.lit(1)).alias("ties")))
    rest = slim.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").repartition("digest")
    pairs = rest.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("ties"))
    best = pairs.groupBy("digest").agg(F.max(F.struct("doc_id")).alias("best"), F.sum("ties").alias("n")).where("n > 1").select("digest", "best.doc_id")
    best = best.withColumnRenamed("doc_id", "best_id")
    key_hash = F.xxhash64("doc_id")
    pair_hash = F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long").bitwiseXOR(key_hash)
    listed, n = stored_with_count(
        pairs.join(best, "digest").withColumn("stays", F.col("doc_id").eqNullSafe(F.col("best_id"))).where("not stays or ties > 1")
        .select("digest", "doc_id", "stays", pair_hash.alias("hash"))
    )
    sent = spark.sparkContext.broadcast(hash_map(listed, "hash", map_bits(n)))

    @F.arrow_udf(T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("maybe", T.BooleanType())]))
    def looked_up(text, key_hashes):
        import numpy as np
        import pyarrow as pa

        found = _digests(text)
        own = np.array([int.from_bytes(d[:8], "big") for d in found], np.uint64) ^ key_hashes.to_numpy(zero_copy_only=False).view(np.uint64)
        return pa.StructArray.from_arrays([pa.array(found, pa.binary()), pa.array(map_has(sent.value, own))], names=["digest", "maybe"])

    left = keyed.select("row", "doc_id", looked_up("text", key_hash).alias("f")).select("row", "doc_id", "f.digest", "f.maybe")
    left = left.join(F.broadcast(hot), "digest", "left").where(F.col("top_id").isNull() & F.col("ties").isNull() | is_top)
    sure = left.where(~F.col("maybe") & (F.coalesce("ties", F.lit(1)) == 1)).select("row.*")
    there = listed.select(F.col("digest").alias("d"), F.col("doc_id").alias("k"), "stays")
    unsure = left.where(F.col("maybe") | (F.coalesce("ties", F.lit(1)) > 1)).join(
        there, (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("k")), "left"
    ).where(F.coalesce("stays", F.lit(True)))
    if hot.where("ties > 1").isEmpty() and listed.where("stays").isEmpty():
        return sure.unionByName(unsure.select("row.*"))
    several = F.col("stays").isNotNull() | (F.coalesce("ties", F.lit(1)) > 1)
    once = unsure.where(several).groupBy("digest").agg(F.first("row").alias("row")).select("row.*")
    return sure.unionByName(unsure.where(~several).select("row.*")).unionByName(once)
