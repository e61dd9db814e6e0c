"""Importance resampling towards a target distribution: hashed features, Gumbel scores, an exact cutoff by bisection."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, types as T

from flowmart.llm.common import stored
from flowmart.operators.ordering import number_rows

#: Buckets of features, least and most words of a feature, words a drawable document has, per cent drawn, seed of the draw.
BUCKETS, LOW, HIGH, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 1, 20, 10, 2024
#: Levels of bisection that one count job decides: it counts below each of ``2 ** LEVELS - 1`` midpoints.
LEVELS = 4

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text: runs of letters a-z (after lower-casing A-Z), digits and anything beyond ASCII; null has none."""
    cut = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(cut, lambda w: w != "")


def _features(of: Column, low: int, high: int) -> Column:
    """All runs of ``low`` to ``high`` consecutive words, joined by one blank."""
    def runs(n: int) -> Column:
        if n == 1:
            return of
        starts = F.when(F.size(of) >= n, F.sequence(F.lit(1), F.size(of) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(of, i, n), " "))

    return runs(low) if low == high else F.concat(*[runs(n) for n in range(low, high + 1)])


def _bucket(feature: Column, buckets: int) -> Column:
    return (F.crc32(feature.cast("binary")) % buckets).cast("int")


def bucket_counts(table: DataFrame, text: str, buckets: int, low: int, high: int) -> list[int]:
    """How many features of all texts fall into each bucket; counted per task, so ``buckets`` rows leave it at most."""
    of = table.select(words(F.col(f"`{text}`")).alias("w")).select(F.explode(_features(F.col("w"), low, high)).alias("f"))
    out = [0] * buckets
    for row in of.groupBy(_bucket(F.col("f"), buckets).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect():
        out[row.b] = row.n
    return out


def gains(raw: list[int], target: list[int]) -> list[int]:
    """Thousandths of the log ratio of smoothed shares in the target and in the raw corpus, rounded down."""
    buckets = len(raw)
    all_raw, all_target = float(sum(raw) + buckets), float(sum(target) + buckets)
    return [math.floor(1000 * math.log(float(t + 1) * all_raw / (float(s + 1) * all_target))) for s, t in zip(raw, target)]


def scored(
    docs: DataFrame, gain: list[int], key: str = "doc_id", text: str = "text", low: int = LOW, high: int = HIGH, seed: int = SEED,
) -> DataFrame:
    """(doc_id, rid, n_words, n_features, weight, score) of each document; ``rid`` tells repeated rows apart."""
    of_bucket = F.split(F.lit(",".join(map(str, gain))), ",").cast("array<bigint>")  # folded to one constant array
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), words(F.col(f"`{text}`")).alias("w"))
    rows = rows.select("doc_id", F.size("w").cast("long").alias("n_words"), _features(F.col("w"), low, high).alias("f"))
    add = lambda total, f: total + F.get(of_bucket, _bucket(f, len(gain)))
    rows = rows.select(
        "doc_id", F.monotonically_increasing_id().alias("rid"), "n_words", F.size("f").cast("long").alias("n_features"),
        F.aggregate("f", F.lit(0).cast("long"), add).alias("weight"),
    )
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return rows.withColumn("score", F.col("weight") + gumbel)


def least_value(rows: DataFrame, value: Column, need: int, low: int, high: int) -> int:
    """The least integer v in [low, high] with at least ``need`` rows of ``value`` <= v, by bisection with exact count jobs."""
    while low < high:
        parts = 1 << LEVELS
        points = sorted({low + (high - low) * i // parts for i in range(1, parts)} - {high})
        counts = rows.agg(*[F.count_if(value <= p).alias(f"n{i}") for i, p in enumerate(points)]).first()
        for point, n in zip(points, counts):
            if n >= need:
                high = point
                break
            low = point + 1
    return low


def cutoff(rows: DataFrame, order: list[Column], need: int) -> Column:
    """A condition that exactly ``need`` of the stored ``rows`` meet: the first by the integer columns ``order``.

    The first column's cutoff is found by bisection; only rows that tie on it are counted for the next column. Rows that tie on all
    columns are taken together, so the last column should be unique.
    """
    taken, tied = F.lit(False), F.lit(True)
    for value in order:
        if need <= 0:
            return taken
        these = rows.where(tied)
        low, high, n = these.agg(F.min(value), F.max(value), F.count(F.lit(1))).first()
        if n <= need:
            break
        cut = least_value(these, value, need, low, high)
        need -= these.where(value < cut).count()
        taken, tied = taken | (tied & (value < cut)), tied & (value == cut)
    return taken | tied if need > 0 else taken


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = PERCENT,
    least_words: int = LEAST_WORDS, buckets: int = BUCKETS, low: int = LOW, high: int = HIGH, seed: int = SEED,
) -> DataFrame:
    """One row per input row: doc_id, n_features, weight, score, rank (null if not drawn), all long but the key.

    A document's weight is the sum of its features' gains, its score adds Gumbel noise that a hash of key and seed gives. Of the
    documents with ``least_words`` words the ``percent`` per cent with the highest scores are drawn, rounded down; ties go to the smaller
    key, null keys last, and rows that repeat a key in the order of the scored table. A null text has no words. Keys are whole numbers. Empty
    tables give no rows, or gains from smoothing alone. Other columns are not read.

    Gains are ``buckets`` numbers. Scores are written once; the cutoff comes from count jobs over that table, and only drawn rows
    are sorted, in ranges, for their ranks.
    """
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        raise TypeError(f"{key} is {docs.schema[key].dataType.simpleString()}; ties are broken by whole numbers")
    gain = gains(bucket_counts(docs, text, buckets, low, high), bucket_counts(target, target_text, buckets, low, high))
    table = stored(scored(docs, gain, key, text, low, high, seed))
    fits = table.where(F.col("n_words") >= least_words)
    need = fits.count() * percent // 100
    order = [-F.col("score"), F.col("doc_id").isNull().cast("int"), F.coalesce("doc_id", F.lit(0)).cast("long"), F.col("rid")]
    drawn = (F.col("n_words") >= least_words) & cutoff(fits, order, need)
    out = ["doc_id", "n_features", "weight", "score"]
    ranked = number_rows(table.where(drawn), "rank", [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("rid")], store=False)
    rest = table.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*out, F.col("rank").cast("long").alias("rank")).unionByName(rest)
