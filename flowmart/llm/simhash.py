"""Near duplicates: SimHash fingerprints with pigeonring candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from flowmart.llm.common import hash_map, map_bits, map_has, small_batches, stored, stored_with_count
from flowmart.llm.components import components

#: Bits in which linked fingerprints may differ, and words to a shingle.
DISTANCE, SHINGLE = 3, 3
#: The ring: segments of 16 bits. With a budget of 3 over 4 segments, l consecutive ones may differ in 3l/4 bits.
SEGMENTS, WIDTH = 4, 16


def _shingles(text: str | None, shingle: int) -> list[int]:
    """The XXH64 (seed 42) of each shingle of one text, in order.

    Words are runs of other than blank, tab, LF, VT, FF, CR, after lower-casing A-Z; shingles are joined by one blank. Fewer
    words than a shingle make one shingle of all; no word (or null) gives none.
    """
    import re

    import numpy as np
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(line, 42)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-shingle]]).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(line[i:j], 42) for i, j in zip(starts, (ends[shingle - 1:] - 1).tolist())]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text: a bit is set where over half of its shingles' hashes have it; zero without a word."""
    import numpy as np

    hashes = _shingles(text, shingle)
    if not hashes:
        return 0
    seen = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):  # long texts in pieces
        part = np.array(hashes[i:i + 65536], "<u8").view(np.uint8).reshape(-1, 8)
        seen += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * seen > len(hashes), bitorder="little").view("<u8")[0])


@F.arrow_udf(T.LongType())
def _fingerprint(text):
    import numpy as np
    import pyarrow as pa

    return pa.array(np.array([fingerprint(t) for t in text.to_pylist()], np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): fingerprints as signed longs."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(key).alias("doc_id"), _fingerprint(F.col(text)).alias("fp"))


def _segment(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, WIDTH * (k % SEGMENTS)).bitwiseAND((1 << WIDTH) - 1)


def ring_start(a: Column, b: Column, distance: int = DISTANCE) -> Column:
    """The first segment from which every chain of consecutive segments keeps its proportional budget; -1 if none does.

    By the pigeonring principle two fingerprints that differ in at most ``distance`` bits have such a start: chains of
    1, 2, 3, 4 segments from it differ in at most 0, 1, 2, 3 bits.
    """
    diff = [F.bit_count(_segment(a.bitwiseXOR(b), k)) for k in range(SEGMENTS)]
    found = F.lit(-1)
    for start in reversed(range(SEGMENTS)):
        chain, held = F.lit(0), F.lit(True)
        for length in range(1, SEGMENTS + 1):
            chain = chain + diff[(start + length - 1) % SEGMENTS]
            held = held & (chain <= length * distance // SEGMENTS)
        found = F.when(held, start).otherwise(found)
    return found


def _entries(prints: DataFrame) -> DataFrame:
    """(fp, part): one row per start of a chain and left-out quarter of the segment after it.

    A chain that keeps its budget has an equal first segment and at most one differing bit in the second, which
    therefore agrees outside one of its quarters: 28 bits must be equal. ``part`` numbers start and quarter above those bits.
    Longer keys would need many more rows each (one per flipped bit for 32); with these the rows cost, by estimate, about as much as the
    chance pairs at 10^10 fingerprints, and either is a small part of reading the texts.
    """
    quarter = WIDTH // 4
    keys = []
    for k in range(SEGMENTS):
        after = _segment(F.col("fp"), k + 1)
        for q in range(4):
            low = after.bitwiseAND((1 << quarter * q) - 1)
            rest = F.shiftleft(F.shiftright(after, quarter * (q + 1)), quarter * q) + low
            keys.append(F.lit(4 * k + q << WIDTH + 3 * quarter).cast("long") + F.shiftleft(_segment(F.col("fp"), k), 3 * quarter) + rest)
    return prints.select("fp", F.explode(F.array(*keys)).alias("part"))


def linked_fingerprints(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links between distinct fingerprints that give the same components as all pairs within ``distance`` bits.

    ``prints`` holds distinct ``fp``. Entries that share a key are candidates. Each is first held against one
    representative of its key, which already joins most of a dense group. Pairs of a key are compared only
    where one of the two is not yet in the representative's component, so the pairs of a dense group are never emitted.
    """
    if distance != 3:
        raise ValueError("the keys are laid out for 3 differing bits")
    entries = _entries(prints).repartition("part")  # dealt once, for the representatives and for the join
    reps = entries.groupBy("part").agg(F.min("fp").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1").select("part", "rep")
    shared = stored(entries.join(reps, "part"))

    def near(a: Column, b: Column) -> Column:
        return (ring_start(a, b) >= 0) & (F.bit_count(a.bitwiseXOR(b)) <= distance)

    star = stored(shared.where((F.col("fp") != F.col("rep")) & near(F.col("fp"), F.col("rep"))).select(F.col("rep").alias("a"), F.col("fp").alias("b")).distinct())
    label = components(star)
    named = shared.join(label.select(F.col("node").alias("fp"), F.col("label").alias("mine")), "fp", "left").select(
        "part", "fp", "rep", F.coalesce("mine", "fp").alias("mine")
    )
    named = stored(
        named.join(label.select(F.col("node").alias("rep"), F.col("label").alias("its")), "rep", "left").select(
            "part", "fp", "mine", F.coalesce("its", "rep").alias("its")
        )
    )
    apart = stored(named.where("mine != its").select("part", F.col("fp").alias("a"), F.col("mine").alias("of_a")))
    others = named.select("part", F.col("fp").alias("b"), F.col("mine").alias("of_b"))
    rest = apart.join(others, "part").where((F.col("of_a") != F.col("of_b")) & near(F.col("a"), F.col("b"))).select("a", "b")
    return star.unionByName(rest.distinct())


def _with_roots(prints: DataFrame, order: Column) -> DataFrame:
    """(fp, first, n) for every fingerprint: the least ``order`` over all rows of its component, and how many rows that has."""
    distinct = stored(prints.groupBy("fp").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")))
    label = components(linked_fingerprints(distinct.select("fp")))
    named = stored(distinct.join(label, distinct["fp"] == label["node"], "left").select("fp", "first", "n", F.coalesce("label", "fp").alias("label")))
    least = stored(named.groupBy("label").agg(F.min("first").alias("first"), F.sum("n").alias("n")))
    return stored(named.select("fp", "label").join(least, "label").select("fp", "first", "n"))


def near_duplicate_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints link at 3 or fewer differing bits; ``component_id`` is the smallest key reachable over links, itself
    included (null only if all keys of a component are null). Texts without words share fingerprint zero and link like any
    other. Repeated rows give repeated rows; an empty table gives none; other columns are not read.
    """
    prints = stored(fingerprints(docs, key, text))
    roots = _with_roots(prints, F.col("doc_id")).select("fp", F.col("first").alias("component_id"))
    return prints.join(roots, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all its columns, one row of each component of :func:`near_duplicate_groups`: the one with the smallest key.

    Null keys come last, and of rows that repeat the smallest key the first written stays: it is rows that are decided on, so
    rows of one key with unrelated texts stay or go apart. Rows are written once with their fingerprints; of those only the ones
    that may go meet the table of rows that go.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    held = stored(rows.select("row", F.col(f"row.`{key}`").alias("doc_id"), _fingerprint(F.col(f"row.`{text}`")).alias("fp"), F.monotonically_increasing_id().alias("rid")))
    prints = held.select("doc_id", "fp", "rid")
    roots = _with_roots(prints, F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).where("n > 1").select("fp", F.col("first.rid").alias("stays"))
    gone, n = stored_with_count(prints.join(roots, "fp").where("rid != stays").select("rid", F.xxhash64("rid").alias("hash")))
    known = spark.sparkContext.broadcast(hash_map(gone, "hash", map_bits(n)))

    @F.arrow_udf(T.BooleanType())
    def maybe(hashes):
        import numpy as np
        import pyarrow as pa

        return pa.array(map_has(known.value, hashes.to_numpy(zero_copy_only=False).view(np.uint64)))

    tagged = held.select("row", "rid", maybe(F.xxhash64("rid")).alias("maybe"))
    unsure = tagged.where("maybe").join(gone.select("rid"), "rid", "left_anti")
    return tagged.where("not maybe").select("row.*").unionByName(unsure.select("row.*"))
