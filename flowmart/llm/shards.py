"""Sharding by jump consistent hashing, in DataFrame functions only."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from flowmart.llm.common import stored

#: The multiplier of the published generator.
MULTIPLIER = 2862933555777941757
WORD = Decimal(1 << 64)
#: Jumps after which an unfinished key raises: the expected number is the logarithm of the shard count plus one, and
#: a key with so many has a chance under 1e-60 for any count that an int holds.
JUMPS = 200


def stable_key(df: DataFrame, column: str) -> Column:
    """The 64-bit key as an unsigned decimal: whole numbers as they are, other kinds by their XXH64; null is the largest key."""
    kind = df.select(df[f"`{column}`"]).schema[0].dataType
    whole = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    key = (F.col(f"`{column}`") if whole else F.xxhash64(F.col(f"`{column}`"))).cast("decimal(20,0)")
    wrapped = F.when(key < 0, key + F.lit(WORD)).otherwise(key)
    value = F.when(F.col(f"`{column}`").isNotNull(), wrapped)
    return F.coalesce(value, F.lit(WORD - 1)).cast("decimal(38,0)")


def jump_hash(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of an unsigned 64-bit ``key`` given as decimal.

    Each jump draws the key's next number r of the generator and leads from shard b to floor((b + 1) / r); the last
    shard below ``shards`` is the key's own. More shards only add jumps, so a key stays or goes to an added shard.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    state = F.struct(key.alias("k"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def jump(s, _):
        k = ((s["k"] * F.lit(Decimal(MULTIPLIER)) + 1).cast("decimal(38,0)") % F.lit(WORD)).cast("decimal(38,0)")
        r = F.floor(k / F.lit(Decimal(1 << 33))).cast("double") + 1
        over = s["j"] >= shards
        to = F.floor((s["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / r)).cast("long")
        return F.when(over, s).otherwise(F.struct(k.alias("k"), s["j"].alias("b"), to.alias("j")))

    def end(s):
        return F.when(s["j"] >= shards, s["b"].cast("int")).otherwise(F.raise_error(F.lit("a key needs more jumps")).cast("int"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, JUMPS))), state, jump, end)


def place(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per input row.

    ``shard`` follows from key and shard count alone; ``grown_shard`` is the shard with one more. ``size`` is the text's
    UTF-8 bytes plus 1; a null text has none and the checksum of nothing. ``slot`` numbers the rows of a shard without gaps from 0, by
    key (null first), size and checksum; equal rows share out the slots. A null key is the largest key. An empty table gives no rows.

    Rows are sorted by ranges, so a shard is numbered by many tasks; only a count for each shard and range is gathered.
    """
    data = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    number = stable_key(docs, key)
    slim = stored(docs.select(
        F.col(f"`{key}`").alias("doc_id"), (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
        jump_hash(number, shards).alias("shard"), jump_hash(number, shards + 1).alias("grown_shard"),
    ))
    order = ["shard", "doc_id", "size", "text_crc32"]
    parts = int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = slim.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id()
    sorted_ = stored(ranged.select("*", F.shiftrightunsigned(row, 33).alias("part"), row.alias("row")))
    runs = sorted_.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = runs.select("shard", "part", (before - F.col("first")).alias("shift"))
    return sorted_.join(offsets, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("row") + F.col("shift")).alias("slot"), "grown_shard"
    )
