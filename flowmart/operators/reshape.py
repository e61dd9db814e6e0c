"""Wide to long and long to wide."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from flowmart import functions as fx
from flowmart.schema import FIRST_YEAR, LAST_YEAR, TOTAL


def looks_like_year(name: str, lo: int = FIRST_YEAR, hi: int = LAST_YEAR) -> bool:
    text = str(name).strip()
    return re.fullmatch("[0-9]+", text) is not None and lo <= int(text) <= hi


def year_columns(columns: Sequence[str], lo: int = FIRST_YEAR, hi: int = LAST_YEAR, prefix: str = "") -> list[str]:
    """Year columns: headers in range or, failing that, everything from the first all-digit header on."""
    if prefix:
        return [c for c in columns if c.startswith(prefix)]
    years = [c for c in columns if looks_like_year(c, lo, hi)]
    if years:
        return years
    digits = [i for i, c in enumerate(columns) if str(c).isdigit()]
    if not digits:
        raise ValueError("no year columns found")
    return list(columns[digits[0]:])


def _melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str, value: str) -> DataFrame:
    """Unpivot; columns of differing types meet as double, since they must share one type."""
    kinds = {df.schema[c].dataType for c in values}
    if len(kinds) > 1:
        df = df.withColumns({c: fx.to_number(F.col(f"`{c}`")) for c in values})
    quoted = lambda names: [F.col(f"`{c}`") for c in names]
    return df.unpivot(quoted(ids), quoted(values), var, value)


def unpivot_years(
    df: DataFrame,
    ids: Sequence[str] | None = None,
    lo: int = FIRST_YEAR,
    hi: int = LAST_YEAR,
    prefix: str = "",
    drop_nulls: bool = False,
    year: str = "year",
    value: str = "count",
) -> DataFrame:
    """One row per year column. Null values are kept unless ``drop_nulls``."""
    df = df.toDF(*[c.strip() for c in df.columns])
    years = year_columns(df.columns, lo, hi, prefix)
    ids = [c for c in df.columns if c not in years] if ids is None else list(ids)
    long = _melt(df, ids, years, year, value)
    if drop_nulls:
        long = long.where(F.col(value).isNotNull())
    return long.withColumn(year, fx.year_of(year, prefix))


def unpivot_rest(df: DataFrame, ids: Sequence[str], var: str = "year", value: str = "count") -> DataFrame:
    """Unpivot every column that is not an id."""
    ids = list(ids)
    return _melt(df, ids, [c for c in df.columns if c not in ids], var, value)


def residency_long(df: DataFrame, side: str, total: str = TOTAL, drop_nulls: bool = True) -> DataFrame:
    """Residency file of one side (``office`` or ``origin``) to long rows; the absent side is ``total``."""
    if side not in ("office", "origin"):
        raise ValueError(f"side must be 'office' or 'origin', not {side!r}")
    ids = [c for c in df.columns if not c.isdigit()]
    long = unpivot_rest(df, ids)
    long = long.toDF(*[c.lower() for c in long.columns])
    out = long.select(
        fx.to_whole("year").alias("year"),
        (F.col("office") if side == "office" else F.lit(total)).alias("office"),
        (F.col("origin") if side == "origin" else F.lit(total)).alias("origin"),
        "type",
        fx.to_number("count").alias("count"),
    )
    return out.where(F.col("count").isNotNull()) if drop_nulls else out


def hierarchy_members(
    df: DataFrame, pairs: Sequence[tuple[str, str]], code: str = "m49_code", name: str = "m49_name"
) -> DataFrame:
    """Distinct (code, name) members of all levels; levels without a code are skipped."""
    levels = F.array(
        *[F.struct(F.col(f"`{c}`").cast("string").alias(code), F.col(f"`{n}`").alias(name)) for c, n in pairs]
    )
    members = df.select(F.explode(levels).alias("m")).select(f"m.{code}", f"m.{name}")
    return members.where(F.col(code).isNotNull()).distinct()


def series_to_columns(
    df: DataFrame, key: Sequence[str], specs: Mapping[str, Column], value: str = "count", empty: float | None = None
) -> DataFrame:
    """One summed column per named predicate, all in a single pass over the rows."""
    sums = {}
    for name, predicate in specs.items():
        total = F.sum(F.when(predicate, F.col(value)))
        sums[name] = total if empty is None else F.coalesce(total, F.lit(empty))
    return df.groupBy(*key).agg(*[c.alias(name) for name, c in sums.items()])
