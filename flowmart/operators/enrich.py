"""Joins to dimensions, unions, de-duplication and set comparison.

No join here carries a broadcast hint. Spark broadcasts a side only when its known size is under
``spark.sql.autoBroadcastJoinThreshold`` (file statistics when planning, real shuffle sizes under adaptive
execution) and otherwise sorts and merges, splitting skewed partitions. It can split them only when both sides
come to the join straight from a shuffle, which a side grouped by the join key does not. Such a side is
therefore written first (``stored``), which also tells the planner its real size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from flowmart import functions as fx
from flowmart.schema import LABELLED_CLASS_TYPES
from flowmart.session import shared_dir, stored


def _pairs(on) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(c, c) for c in on]


def dedupe(df: DataFrame, keys: Sequence[str] | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Whole-row distinct or, with ``keys``, the first row per key by ``order`` and then by the other columns.

    The survivor is an aggregate (combined before the shuffle), not a window over the key's rows.
    """
    if keys is None:
        return df.distinct()
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ranked = [*order, *[c for c in rest if c not in order]]
    parts = [p for i, c in enumerate(ranked) for p in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))]
    best = df.groupBy(*keys).agg(F.min(F.struct(*parts)).alias("_best"))
    taken = {c: F.col(f"_best.v{i}") for i, c in enumerate(ranked)}
    return best.select(*[taken[c].alias(c) if c in taken else F.col(c) for c in df.columns])


def unique_dim(dim: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per key. With ``order`` the last row wins; without it a key with differing rows fails the job."""
    keys = list(keys)
    rest = [c for c in dim.columns if c not in keys and c != order]
    row = F.struct(*[F.col(c) for c in rest])
    if order is not None:
        best = F.max_by(row, F.struct(F.col(order).alias("o"), row.alias("r")))
    else:
        key_text = F.concat_ws(", ", *[F.col(c).cast("string") for c in keys])
        fail = F.raise_error(F.concat(F.lit("dimension key is not unique: "), key_text))
        best = F.when(F.min(row) == F.max(row), F.min(row)).otherwise(fail)
    return dim.groupBy(*keys).agg(best.alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def lookup_side(dim: DataFrame, key: str, value: str, order: str | None = None) -> DataFrame:
    """A dimension as a stored table of one ``_value`` per ``_key``, the last by ``order``."""
    columns = [F.col(key).alias("_key"), F.col(value).alias("_value")] + ([F.col(order).alias("_order")] if order else [])
    return stored(unique_dim(dim.select(*columns), ["_key"], "_order" if order else None))


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    value: str,
    out: str,
    default: str | None = None,
    key: str | None = None,
    order: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Add ``out`` = the dimension's ``value`` for ``on``; skipped when ``out`` is already there.

    ``unique`` is for a dimension made by :func:`lookup_side`, which serves several lookups.
    """
    if out in df.columns:
        return df
    side = dim if unique else lookup_side(dim, key or on, value, order)
    side = side.select(F.col("_key"), F.col("_value").alias(out))
    joined = df.join(side, F.col(on) == F.col("_key"), "left").drop("_key")
    return joined if default is None else joined.withColumn(out, F.coalesce(out, F.lit(default)))


def add_counts(
    df: DataFrame, extra: DataFrame, keys: Sequence[str], value: str = "count", extra_value: str = "extra"
) -> DataFrame:
    """Add supplementary counts by key. A null base stays null unless the total is above zero."""
    side = extra.select(*keys, F.col(extra_value).alias("_extra")).distinct()
    total = fx.nullable_sum(value, "_extra")
    summed = F.when(F.col(value).isNotNull() | (total > 0), total)
    return df.join(side, list(keys), "left").withColumn(value, summed).select(*df.columns).distinct()


def class_label_dim(
    df: DataFrame, class_type: str, code: str = "class", name: str = "industry", pad: bool = False,
    match: str = "prefix",
) -> DataFrame:
    """Class labels: ``class_type, class_code_short, class_code_labeled`` from a code and a name column.

    Headers are compared trimmed and lower-cased; both must be present. Rows without a class are dropped.
    """
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    missing = [c for c in (code, name) if c not in df.columns]
    if missing:
        raise ValueError(f"label table lacks columns: {missing}")
    short = fx.class_code(F.col(code).cast("string"), pad, match)
    return (
        df.select(F.lit(class_type).alias("class_type"), short.alias("class_code_short"), F.trim(name).alias("_name"))
        .where(F.col("class_code_short").isNotNull())
        .select(
            "class_type",
            "class_code_short",
            F.concat("class_code_short", F.lit(" - "), "_name").alias("class_code_labeled"),
        )
    )


def label_classes(
    df: DataFrame,
    dim: DataFrame,
    labelled: Sequence[str] = LABELLED_CLASS_TYPES,
    pad: bool = False,
    match: str = "prefix",
    fallback: str = "raw",
    order: str | None = None,
) -> DataFrame:
    """Class codes to labels for the labelled class types; other types keep their text.

    A code without a label keeps its raw text or, with ``fallback="code"``, its normalized code.
    """
    short = F.when(F.col("class_type").isin(*labelled), fx.class_code("class_code", pad, match))
    side = stored(unique_dim(dim, ["class_type", "class_code_short"], order)).withColumnRenamed("class_type", "_type")
    on = (F.col("class_type") == F.col("_type")) & (F.col("_short") == F.col("class_code_short"))
    raw = F.col("class_code") if fallback == "raw" else F.col("_short")
    label = (
        F.when(F.col("_short").isNull() | F.col("_short").isin("Other", "Unknown"), F.col("_short"))
        .otherwise(F.coalesce("class_code_labeled", raw))
    )
    keep = F.when(F.col("class_type").isin(*labelled), label).otherwise(F.col("class_code"))
    return df.withColumn("_short", short).join(side, on, "left").withColumn("class_code", keep).select(*df.columns)


def unmatched(df: DataFrame, dim: DataFrame, on) -> DataFrame:
    """Distinct keys of ``df`` that the dimension lacks; a null key counts as unmatched."""
    pairs = _pairs(on)
    keys = df.select(*[F.col(a) for a, _ in pairs]).distinct()
    side = dim.select(*[F.col(b).alias(f"_{b}") for _, b in pairs])
    return keys.join(side, [F.col(a) == F.col(f"_{b}") for a, b in pairs], "left_anti")


def require_matched(df: DataFrame, dim: DataFrame, on) -> None:
    """Raise when keys are unmatched. All of them are written to a table, which the message names with their count."""
    path = shared_dir(df.sparkSession, "unmatched")
    seen = Observation()
    unmatched(df, dim, on).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    if seen.get["n"]:
        raise ValueError(f"{seen.get['n']} unmatched keys, load aborted; they are listed in {path}")


def guarded_join(df: DataFrame, dim: DataFrame, on) -> DataFrame:
    """Join that can neither multiply nor lose rows: a repeated dimension key or an unmatched row fails the job.

    The check is a filter, so it holds whatever columns are read, and for ``count()``.
    """
    pairs = _pairs(on)
    rest = [c for c in dim.columns if c not in [b for _, b in pairs]]
    side = stored(unique_dim(dim, [b for _, b in pairs]))
    side = side.select(*[F.col(b).alias(f"_{b}") for _, b in pairs], F.lit(True).alias("_there"), *[F.col(c).alias(f"_dim_{c}") for c in rest])
    joined = df.join(side, [F.col(a) == F.col(f"_{b}") for a, b in pairs], "left")
    key_text = F.concat_ws(", ", *[F.coalesce(F.col(a).cast("string"), F.lit("null")) for a, _ in pairs])
    fail = F.raise_error(F.concat(F.lit("unmatched key: "), key_text)).cast("boolean")
    return joined.where(F.coalesce(F.col("_there"), fail)).select(*df.columns, *[F.col(f"_dim_{c}").alias(c) for c in rest])


def attach(
    df: DataFrame, dim: DataFrame, on, how: str = "left", null_safe: bool = False,
    default: Mapping[str, object] | None = None,
) -> DataFrame:
    """Join dimension columns; ``null_safe`` matches null keys with null keys, ``default`` fills missing values."""
    pairs = _pairs(on)
    rest = [c for c in dim.columns if c not in [b for _, b in pairs]]
    side = dim.select(*[F.col(f"`{b}`").alias(f"_k{i}") for i, (_, b) in enumerate(pairs)], *[F.col(f"`{c}`") for c in rest])
    tests = [
        F.col(a).eqNullSafe(F.col(f"_k{i}")) if null_safe else F.col(a) == F.col(f"_k{i}")
        for i, (a, _) in enumerate(pairs)
    ]
    joined = df.join(side, reduce(lambda x, y: x & y, tests), how)
    keys = {a: F.coalesce(F.col(a), F.col(f"_k{i}")) for i, (a, _) in enumerate(pairs)}
    columns = [keys[c].alias(c) if c in keys and how in ("full", "outer", "right") else F.col(c) for c in df.columns]
    for c in rest:
        fill = (default or {}).get(c)
        columns.append(F.col(c) if fill is None else F.coalesce(F.col(c), F.lit(fill)).alias(c))
    return joined.select(*columns)


def region_map(
    economies: DataFrame, regions: DataFrame, key: str = "region_code", name: str = "region_name",
    code_in_regions: str = "region_code", name_in_regions: str = "region_name",
    economy: Sequence[str] = ("wb_economy_code", "wb_economy_name"),
) -> DataFrame:
    """Economies with the name of their region (or, by ``key``, their administrative region)."""
    side = regions.select(F.col(code_in_regions).alias(key), F.col(name_in_regions).alias(name)).distinct()
    return economies.select(*economy, key).join(side, key).select(key, name, *economy)


def two_path_match(
    names: DataFrame, dim: DataFrame, name_col: str, first: str, second: str, order: Sequence[str] = ()
) -> DataFrame:
    """Match names by the dimension's ``first`` name column, then by ``second``; values are merged per column."""
    out = names
    for path, column in enumerate((first, second)):
        side = stored(dedupe(dim.where(F.col(column).isNotNull()), [column], order))
        side = side.select(F.col(column).alias(f"_on{path}"), *[F.col(c).alias(f"_{path}_{c}") for c in dim.columns])
        out = out.join(side, F.col(name_col) == F.col(f"_on{path}"), "left")
    return out.select(*names.columns, *[F.coalesce(f"_0_{c}", f"_1_{c}").alias(c) for c in dim.columns])


def _conflict(a: str, b: str) -> Column:
    return F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))


def merge_conflicts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows in which both columns have values that differ."""
    return df.where(_conflict(a, b))


def merge_columns(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """One column from two; a row in which both have differing values fails the job, whatever columns are read."""
    text = F.concat(F.lit("conflicting values: "), F.col(a).cast("string"), F.lit(" / "), F.col(b).cast("string"))
    agree = F.when(_conflict(a, b), F.raise_error(text).cast("boolean")).otherwise(F.lit(True))
    return df.where(agree).withColumn(out, F.coalesce(a, b)).drop(*[c for c in (a, b) if c != out])


def union_indicators(frames: Mapping[str, DataFrame], name: str = "indicator") -> DataFrame:
    """Union by column name; the mapping key becomes a column and absent columns are null."""
    tagged = [df.withColumn(name, F.lit(key)) for key, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def union_flows(frames: Sequence[DataFrame], distinct: bool = True) -> DataFrame:
    out = reduce(lambda a, b: a.unionByName(b), frames)
    return out.distinct() if distinct else out


def set_difference(a: DataFrame, b: DataFrame, col: str, col_b: str | None = None) -> DataFrame:
    """Values found on one side only: ``value, side`` with ``left_only`` or ``right_only``; nulls are skipped."""
    left = a.select(F.col(col).alias("value"), F.lit(1).alias("l"), F.lit(0).alias("r"))
    right = b.select(F.col(col_b or col).alias("value"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    sides = left.unionByName(right).where(F.col("value").isNotNull()).groupBy("value").agg(
        F.max("l").alias("l"), F.max("r").alias("r")
    )
    one_sided = sides.where(F.col("l") != F.col("r"))
    return one_sided.select("value", F.when(F.col("l") == 1, "left_only").otherwise("right_only").alias("side"))


def set_counts(a: DataFrame, b: DataFrame, col: str, col_b: str | None = None) -> DataFrame:
    """How many distinct values each side has alone."""
    return set_difference(a, b, col, col_b).groupBy("side").agg(F.count("*").alias("n_values"))


