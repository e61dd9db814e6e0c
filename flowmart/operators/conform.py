"""Column conforming: renames, cleaning, casting, harmonizing, relabelling, staging filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from flowmart import functions as fx
from flowmart.operators.ordering import ascending, number_rows
from flowmart.schema import ACTUAL_STATUS, CHARGES_MEASURE, WORLD, WORLD_CODE


def normalize_headers(df: DataFrame, lower: bool = True) -> DataFrame:
    """Strip header names and, by default, lower their case."""
    names = [c.strip() for c in df.columns]
    return df.toDF(*[c.lower() for c in names] if lower else names)


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def _cast(name: str, kind: T.DataType, null_tokens: Sequence[str]) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        return fx.blank_to_null(column.cast("string"), null_tokens)
    if isinstance(kind, T.IntegralType):
        return fx.to_whole(column, kind.simpleString())
    if isinstance(kind, T.FractionalType):
        return fx.to_number(column).cast(kind)
    return column.cast(kind)


def to_contract(
    df: DataFrame,
    contract: T.StructType,
    rename: Mapping[str, str] | None = None,
    strict: bool = False,
    null_tokens: Sequence[str] = ("", " "),
) -> DataFrame:
    """Rename, clean, cast and order columns to a contract; absent columns become null unless ``strict``.

    Columns that already have the contract's numeric type are passed through, so no text round trip is made.
    """
    df = df.toDF(*[c.strip() for c in df.columns]).withColumnsRenamed(dict(rename or {}))
    if strict:
        require_columns(df, contract.names)
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for f in contract.fields:
        if f.name not in types:
            value = F.lit(None).cast(f.dataType)
        elif types[f.name] == f.dataType and not isinstance(f.dataType, T.StringType):
            value = F.col(f"`{f.name}`")
        else:
            value = _cast(f.name, f.dataType, null_tokens)
        columns.append(value.alias(f.name))
    return df.select(*columns)


@dataclass(frozen=True)
class Layout:
    """Leading columns of a wide file by position; ``None`` drops that column. ``constants`` fill or replace."""

    names: tuple[str | None, ...]
    constants: Mapping[str, str] = field(default_factory=dict)


LAYOUTS = {
    "bilateral": Layout(("Office", None, "Origin")),
    "unilateral": Layout(("Office", None, "Origin"), {"Origin": WORLD}),
    "unilateral_typed": Layout(("Office", None, "Origin", None), {"Origin": WORLD}),
    "by_class": Layout(("Office", None, "Origin", "class_code")),
    "by_office": Layout(("Office", None, None, "Type")),
    "by_origin": Layout(("Origin", None, None, "Type")),
}


def apply_layout(df: DataFrame, layout: Layout | str, base_year: int | None = None) -> DataFrame:
    """Name the leading columns by position; with ``base_year`` the rest become years counted from it."""
    layout = LAYOUTS[layout] if isinstance(layout, str) else layout
    lead, rest = df.columns[: len(layout.names)], df.columns[len(layout.names):]
    columns = []
    for source, name in zip(lead, layout.names):
        if name is None:
            continue
        value = F.lit(layout.constants[name]) if name in layout.constants else F.col(f"`{source}`")
        columns.append(value.alias(name))
    for i, source in enumerate(rest):
        columns.append(F.col(f"`{source}`").alias(source if base_year is None else str(base_year + i)))
    return df.select(*columns)


def trim_trailing_years(df: DataFrame, year_cols: Sequence[str]) -> DataFrame:
    """Drop wholly null year columns from the right, stopping at the first that has a value.

    One aggregate over the year columns; only its single row reaches the driver.
    """
    counts = df.agg(*[F.count(f"`{c}`").alias(str(i)) for i, c in enumerate(year_cols)]).first()
    empty = []
    for i in reversed(range(len(year_cols))):
        if counts[i]:
            break
        empty.append(year_cols[i])
    return df.drop(*empty)


def trim_trailing_years_long(df: DataFrame, value: str = "count", year: str = "year") -> DataFrame:
    """The same trim on long rows, lazily: keep years up to the last one with a value."""
    last = df.where(F.col(value).isNotNull()).agg(F.max(year)).scalar()
    return df.where(F.col(year) <= last)


def with_constants(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def with_surrogate_key(df: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """Row numbers from 1 in natural key order, as the first column."""
    numbered = number_rows(df, name, [part for c in order for part in ascending(c)])
    return numbered.select(name, *df.columns)


def harmonize(
    df: DataFrame, cols: Sequence[str], mapping: Mapping[str, str], ignore_case: bool = False
) -> DataFrame:
    """Replace member names by exact value or, with ``ignore_case``, after trimming and lower-casing."""
    if not ignore_case:
        return df.replace(dict(mapping), subset=list(cols))

    def renamed(c: str) -> Column:
        text = F.trim(c)
        result = text
        for old, new in mapping.items():
            result = F.when(F.lower(text) == old.lower(), new).otherwise(result)
        return result

    return df.withColumns({c: renamed(c) for c in cols})


def fill_code(
    df: DataFrame, name_col: str, code_col: str, member: str = WORLD, code: str = WORLD_CODE
) -> DataFrame:
    """Give one member its code where the code is null."""
    missing = (F.col(name_col) == member) & F.col(code_col).isNull()
    return df.withColumn(code_col, F.when(missing, code).otherwise(F.col(code_col)))


def _pick(column: Column, mapping: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.create_map(*pairs)[column]


def rename_by_code(df: DataFrame, code: str, name: str, mapping: Mapping[str, str]) -> DataFrame:
    """Name by code; codes not in the mapping keep the source name."""
    return df.withColumn(name, F.coalesce(_pick(F.col(code), mapping), F.col(name)))


def relabel(df: DataFrame, col: str, mapping: Mapping[str, str], out: str, normalize_dashes: bool = True) -> DataFrame:
    """Category to label; unmatched categories become null."""
    source = fx.plain_dashes(col) if normalize_dashes else F.col(col)
    return df.withColumn(out, _pick(source, mapping))


def parse_industry(df: DataFrame, col: str) -> DataFrame:
    """Replace industry text by ``naics_code`` and ``naics_name``."""
    return df.withColumns({"naics_code": fx.industry_code(col), "naics_name": fx.industry_name(col)}).drop(col)


def keep_industry_groups(df: DataFrame, col: str) -> DataFrame:
    return df.where(fx.is_industry_group(col))


def drop_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def observation_gate(
    df: DataFrame,
    measure: str = CHARGES_MEASURE,
    status: str = ACTUAL_STATUS,
    measure_col: str = "MEASURE",
    status_col: str = "obs_status",
    value_col: str = "value",
) -> DataFrame:
    """Rows of one measure with a value and, when a status column exists, with one status."""
    keep = (F.col(measure_col) == measure) & F.col(value_col).isNotNull()
    if status_col in df.columns:
        keep = keep & (F.col(status_col) == status)
    return df.where(keep)


@dataclass(frozen=True)
class StageTable:
    """How one macro table is staged: geography, categories, scaling and final names."""

    category: str
    categories: tuple[str, ...]
    rename: Mapping[str, str]
    geo: str = "GEO"
    geo_value: str = "Canada"
    scalar: str = "SCALAR_ID"
    value: str = "VALUE"


def stage_table(df: DataFrame, config: StageTable) -> DataFrame:
    """Filter by geography and category, undo the scaling, rename, and cast ``year`` and ``dollar_value``.

    Categories are compared with dashes normalized on both sides, so either spelling is found.
    """
    # Only a category that has a dash can be spelled in two ways; the others are compared as they are, so the scan can filter.
    dashed = [c.replace("–", "-").replace("—", "-") for c in config.categories if any(d in c for d in "-–—")]
    category = F.col(f"`{config.category}`").isin(*[c for c in config.categories if not any(d in c for d in "-–—")])
    if dashed:
        category = category | fx.plain_dashes(F.col(f"`{config.category}`")).isin(*dashed)
    kept = df.where((F.col(config.geo) == config.geo_value) & category)
    value = fx.unscale(fx.to_number(config.value), fx.to_number(config.scalar))
    columns = []
    for source, name in config.rename.items():
        column = value if source == config.value else F.col(f"`{source}`")
        columns.append((fx.to_whole(column) if name == "year" else column).alias(name))
    return kept.select(*columns)
