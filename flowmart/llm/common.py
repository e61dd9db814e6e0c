"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowmart.session import shared_dir, stored, stored_with_count

__all__ = ["hash_map", "map_bits", "map_has", "read_table", "shared_dir", "small_batches", "stored", "stored_with_count", "text_batches", "write_out"]

#: Rows and bytes that one Arrow batch hands to Python: long texts must not pile up in a worker.
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough that a batch of long texts fits a Python worker beside its results."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bits of a map of hashes, which every task holds: 2 MB, however many hashes are in it.
MAP_BITS = 24


def map_bits(rows: int, least: int = 16, most: int = 26) -> int:
    """Bits for a map of ``rows`` hashes: 16 times as many as hashes, between 8 KB and 8 MB in all."""
    return min(most, max(least, (16 * rows).bit_length()))


def hash_map(hashes: DataFrame, column: str, bits: int = MAP_BITS):
    """A numpy map of ``2 ** bits`` bits with the upper bits of every hash set; at most ``2 ** (bits - 6)`` words are gathered."""
    import numpy as np

    bit = f"shiftrightunsigned(`{column}`, {64 - bits})"
    words = hashes.groupBy(F.expr(f"shiftright({bit}, 6)").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({bit} & 63 as int))")).alias("bits")
    ).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def map_has(known, hashes):
    """Which of the unsigned ``hashes`` may be in the map: never false for one that is."""
    import numpy as np

    bit = hashes >> np.uint64(64 - 6 - (len(known) - 1).bit_length())
    return (known[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) > 0


def write_out(df: DataFrame, *parts: str) -> str:
    """Write ``df`` to a new folder of the shared place and return its path."""
    path = shared_dir(df.sparkSession, *parts)
    df.write.mode("error").parquet(path)
    return path


def text_batches(texts: list[str | None], most: int = 500_000) -> Iterator[tuple[list[int], list[str]]]:
    """Runs of (document number, piece of text), each of about ``most`` characters; null counts as empty.

    A longer text is cut into several pieces, always after white space (or, in a run without any that is longer than
    ``most``, anywhere), so that no word is cut and memory does not follow the longest text.
    """
    owners: list[int] = []
    pieces: list[str] = []
    size = 0
    for i, text in enumerate(texts):
        rest, at = text or "", 0
        while True:
            end = len(rest)
            if end - at > most:
                end = at + most
                back = end
                while back > at and not rest[back - 1].isspace():
                    back -= 1
                end = back if back > at else end
            owners.append(i)
            pieces.append(rest[at:end])
            size += end - at
            at = end
            if size >= most:
                yield owners, pieces
                owners, pieces, size = [], [], 0
            if at >= len(rest):
                break
    if owners:
        yield owners, pieces
