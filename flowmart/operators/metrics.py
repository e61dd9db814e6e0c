"""Flow metrics: volumes, shares, changes, series, rankings.

Every metric is one conditional aggregate over one scan of the fact, instead of one scan per number. A total that
is joined back to the rows it sums is written first, so a group with a large share of the rows can be split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from flowmart import functions as fx
from flowmart.operators import ordering
from flowmart.schema import APPLICATIONS
from flowmart.session import stored


@dataclass(frozen=True)
class Fields:
    """Column names of a flow fact."""

    year: str = "year"
    origin: str = "origin"
    dest: str = "destination_office"
    indicator: str = "indicator"
    value: str = "count"


FIELDS = Fields()


def _among(col: str, values: Sequence) -> Column:
    return F.col(col).isin(*values) if len(values) else F.lit(False)


def _not_member(col: str, members: Sequence[str]) -> Column:
    return ~F.coalesce(F.col(col).isin(*members), F.lit(False))


def _all(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests) if tests else F.lit(True)


def flow_filter(
    df: DataFrame,
    origins: Sequence[str] | None = None,
    dests: Sequence[str] | None = None,
    indicators: Sequence[str] | None = None,
    years: Sequence[int] | None = None,
    between: tuple[int, int] | None = None,
    exclude_members: Sequence[str] = (),
    fields: Fields = FIELDS,
) -> DataFrame:
    """Rows of the listed origins, destinations, indicators and years. ``None`` means all, an empty list none.

    ``exclude_members`` removes aggregate members from each side that is not listed explicitly.
    """
    for col, values in ((fields.origin, origins), (fields.dest, dests), (fields.indicator, indicators), (fields.year, years)):
        if values is not None:
            df = df.where(_among(col, values))
    if between is not None:
        df = df.where(F.col(fields.year).between(*between))
    if exclude_members:
        for col, values in ((fields.origin, origins), (fields.dest, dests)):
            if values is None and col in df.columns:
                df = df.where(_not_member(col, exclude_members))
    return df


def nonzero(df: DataFrame, value: str = "count") -> DataFrame:
    return df.where(F.col(value) != 0)


def exclude(df: DataFrame, col: str, members: Sequence[str]) -> DataFrame:
    """Rows whose member is not listed; null members stay."""
    return df.where(_not_member(col, members))


def year_window(df: DataFrame, lo, hi, year: str = "year") -> DataFrame:
    return df.where(F.col(year).between(lo, hi))


def volume(df: DataFrame, by: Sequence[str] = ("year", "indicator"), value: str = "count", out: str = "volume") -> DataFrame:
    return df.groupBy(*by).agg(F.sum(value).alias(out))


def total(df: DataFrame, value: str = "count", out: str = "total") -> DataFrame:
    """One row; zero when there is nothing to sum."""
    return df.agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(out))


def pct_change(df: DataFrame, y0: int, y1: int, by: Sequence[str] = (), fields: Fields = FIELDS) -> DataFrame:
    """Percent change between two years; an absent year counts as zero and a zero base gives null."""
    at = lambda y: F.coalesce(F.sum(F.when(F.col(fields.year) == y, F.col(fields.value))), F.lit(0.0))
    sums = df.where(F.col(fields.year).isin(y0, y1)).groupBy(*by).agg(
        at(y0).alias("volume_from"), at(y1).alias("volume_to")
    )
    change = F.when(F.col("volume_from") != 0, (F.col("volume_to") - F.col("volume_from")) / F.col("volume_from") * 100.0)
    return sums.withColumn("pct_change", change)


def share_of_total(
    df: DataFrame,
    origins: Sequence[str],
    dests: Sequence[str],
    indicators: Sequence[str] | None = None,
    by: Sequence[str] = ("year",),
    exclude_members: Sequence[str] = (),
    fields: Fields = FIELDS,
) -> DataFrame:
    """Percent of the origins' volume that goes to the destinations; zero when there is no volume."""
    rows = flow_filter(df, origins, None, indicators, exclude_members=exclude_members, fields=fields)
    part = F.sum(F.when(_among(fields.dest, dests), F.col(fields.value)))
    sums = rows.groupBy(*by).agg(
        F.coalesce(part, F.lit(0.0)).alias("volume"), F.coalesce(F.sum(fields.value), F.lit(0.0)).alias("total")
    )
    return sums.withColumn("share", fx.percent("volume", "total", zero=0))


def rank_of_group(
    df: DataFrame,
    origins: Sequence[str],
    dests: Sequence[str],
    indicators: Sequence[str] | None = None,
    by: Sequence[str] = ("year",),
    exclude_members: Sequence[str] = (),
    fields: Fields = FIELDS,
) -> DataFrame:
    """Rank of a destination group: 1 + the single destinations whose volume beats the group's combined volume.

    The fact is summed once, to a stored table of one row per group and destination; rows with a null key make a group.
    """
    rows = flow_filter(df, origins, None, indicators, exclude_members=exclude_members, fields=fields)
    each = stored(volume(rows, [*by, fields.dest], fields.value, "_vol"))
    group = each.groupBy(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]).agg(
        F.coalesce(F.sum(F.when(_among(fields.dest, dests), F.col("_vol"))), F.lit(0.0)).alias("group_volume")
    )
    same = _all([F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)])
    return each.join(group, same).groupBy(*by, "group_volume").agg(
        (F.count_if(F.col("_vol") > F.col("group_volume")) + 1).alias("group_rank")
    )


def fill_years(
    df: DataFrame, lo: int, hi: int, values: Sequence[str], keys: Sequence[str] = (), year: str = "year", fill: float = 0.0
) -> DataFrame:
    """Yearly series without gaps: for each key every year in the range, years with no row get ``fill``.

    ``df`` has one row per key and year (a repeated year fails). A key's points are folded into one map, at most
    one entry per year, so the input is read once and no spine is joined.
    """
    point = F.struct(F.col(year), F.struct(*[F.col(f"`{v}`").alias(f"v{i}") for i, v in enumerate(values)]))
    inside = F.col(year).between(lo, hi)
    if not keys:
        df = df.where(inside)
    folded = df.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.when(inside, point))).alias("_at"))
    every = folded.select(*keys, "_at", F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias(year))
    here = F.try_element_at("_at", F.col(year))
    return every.select(*keys, year, *[F.coalesce(here[f"v{i}"], F.lit(fill)).alias(v) for i, v in enumerate(values)])


def timeseries(
    df: DataFrame, origins: Sequence[str], dests: Sequence[str], indicators: Sequence[str], lo: int, hi: int,
    keys: Sequence[str] = (), fields: Fields = FIELDS,
) -> DataFrame:
    """Gap-filled volume per year."""
    rows = flow_filter(df, origins, dests, indicators, between=(lo, hi), fields=fields)
    return fill_years(volume(rows, [*keys, fields.year], fields.value), lo, hi, ["volume"], keys, fields.year)


def bilateral_table(
    df: DataFrame,
    side_a: Sequence[str],
    side_b: Sequence[str],
    lo: int,
    hi: int,
    label_a: str = "A",
    label_b: str = "B",
    rights: Mapping[str, Sequence[str]] = APPLICATIONS,
    fields: Fields = FIELDS,
) -> DataFrame:
    """Yearly volumes of each right in both directions, rounded to whole numbers."""
    f = fields
    ways = {(label_a, label_b): (side_a, side_b), (label_b, label_a): (side_b, side_a)}
    tests = {way: _among(f.origin, o) & _among(f.dest, d) for way, (o, d) in ways.items()}
    wanted = [code for codes in rights.values() for code in codes]
    rows = flow_filter(df, indicators=wanted, between=(lo, hi), fields=f).where(reduce(lambda x, y: x | y, tests.values()))
    specs = {
        f"{right} From {a} to {b}": F.sum(F.when(test & _among(f.indicator, codes), F.col(f.value)))
        for (a, b), test in tests.items()
        for right, codes in rights.items()
    }
    sums = rows.groupBy(f.year).agg(*[c.alias(name) for name, c in specs.items()])
    filled = fill_years(sums, lo, hi, list(specs), year=f.year)
    return filled.select(f.year, *[F.bround(F.col(f"`{n}`"), 0).cast("long").alias(n) for n in specs])


def global_share(
    df: DataFrame,
    origins: Sequence[str],
    lo: int,
    hi: int,
    rights: Mapping[str, Sequence[str]] = APPLICATIONS,
    exclude_members: Sequence[str] = (),
    fields: Fields = FIELDS,
) -> DataFrame:
    """Percent of all filings that come from the origins, per year and right; missing years give zero."""
    f = fields
    wanted = [code for codes in rights.values() for code in codes]
    rows = flow_filter(df, indicators=wanted, between=(lo, hi), exclude_members=exclude_members, fields=f)
    shares = {}
    for right, codes in rights.items():
        inside = _among(f.indicator, codes)
        part = F.sum(F.when(inside & _among(f.origin, origins), F.col(f.value)))
        shares[f"pct_global_{right}_from_origin_total"] = fx.percent(part, F.sum(F.when(inside, F.col(f.value))))
    sums = rows.groupBy(f.year).agg(*[c.alias(name) for name, c in shares.items()])
    return fill_years(sums, lo, hi, list(shares), year=f.year)


def with_share(
    df: DataFrame, value: str, by: Sequence[str] = (), out: str = "pct_share", digits: int | None = None, store: bool = False
) -> DataFrame:
    """Percent of the group total beside each row; the total is a pre-aggregated side, not a window.

    The rows are read twice; ``store=True`` writes them first, where making them costs more than that. Rows with a null
    key make a group.
    """
    df = stored(df) if store else df
    if by:
        totals = stored(df.groupBy(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]).agg(F.sum(value).alias("_total")))
        joined = df.join(totals, _all([F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)]))
    else:
        joined = df.withColumn("_total", df.agg(F.sum(value)).scalar())
    share = fx.percent(value, "_total")
    return joined.withColumn(out, share if digits is None else F.bround(share, digits)).select(*df.columns, out)


def with_shares(
    df: DataFrame, value: str, shares: Mapping[str, Sequence[str]], digits: int | None = None, store: bool = False
) -> DataFrame:
    """Percents of several group totals beside each row: ``shares`` names each new column's group, an empty one being all rows.

    One aggregate over grouping sets gives all totals in one scan; they are stored once and joined null-safe, so rows with a null
    key make a group, which is not the total over that key. The rows are read twice; ``store=True`` writes them first.
    """
    df = stored(df) if store else df
    keys = list(dict.fromkeys(c for by in shares.values() for c in by))
    if not keys:
        return reduce(lambda out, name: with_share(out, value, out=name, digits=digits), shares, df)
    named = {c: f"_by{i}" for i, c in enumerate(keys)}
    sets = list(dict.fromkeys(tuple(sorted(named[c] for c in by)) for by in shares.values()))
    cells = df.select(*[F.col(c).alias(n) for c, n in named.items()], F.col(value).alias("_part"))
    sums = cells.groupingSets([[F.col(c) for c in s] for s in sets], *named.values())
    totals = stored(sums.agg(F.grouping_id().alias("_set"), F.sum("_part").alias("_total")))

    out = df
    for name, by in shares.items():
        # A bit of the set's number, the first key's being the highest, says that the key is summed over.
        number = int("".join("0" if c in by else "1" for c in keys), 2)
        mine = totals.where(F.col("_set") == number)
        if by:
            side = mine.select(*[F.col(named[c]) for c in by], "_total")
            joined = out.join(side, _all([F.col(c).eqNullSafe(F.col(named[c])) for c in by]))
        else:
            joined = out.withColumn("_total", mine.select("_total").scalar())
        share = fx.percent(value, "_total")
        joined = joined.withColumn(name, share if digits is None else F.bround(share, digits))
        out = joined.select(*out.columns, name)
    return out


def top_n(df: DataFrame, value: str, n: int, tie: Sequence[str]) -> DataFrame:
    """The ``n`` rows with the largest value; ties by key."""
    return df.orderBy(F.desc_nulls_last(value), *tie).limit(n)


def top_classes(
    df: DataFrame,
    origins: Sequence[str] | None,
    dests: Sequence[str] | None,
    year: int,
    indicators: Sequence[str] | None = None,
    n: int = 10,
    class_col: str = "class_code",
    fields: Fields = Fields(indicator="ip_indicator"),
) -> DataFrame:
    """The ``n`` largest classes of a flow in one year, with their percent of all its classes."""
    rows = flow_filter(df, origins, dests, indicators, [year], fields=fields)
    volumes = volume(rows, [class_col], fields.value, "vol").where(F.col("vol").isNotNull())
    return top_n(with_share(volumes, "vol", digits=2, store=True), "vol", n, [class_col])


def rank_by_year(
    df: DataFrame,
    entity: str,
    value: str = "count",
    year: str = "year",
    drop_null_values: bool = True,
    exclude_members: Sequence[str] = (),
    store: bool = True,
) -> DataFrame:
    """``rank`` within each year, largest first (ties share the smallest), and unique ``position`` (ties by entity).

    Values of any ordered type are ranked. The rows are written, and once more in ranges of their order, so they are computed once;
    ``store=False`` leaves the first copy out and computes them twice.
    """
    if drop_null_values:
        df = df.where(F.col(value).isNotNull())
    if exclude_members:
        df = exclude(df, entity, exclude_members)
    return ordering.rank_rows(df, "rank", "position", value, [entity], [year], store)


def overlap_years(df: DataFrame, side: str, a: str, b: str, year: str = "year") -> DataFrame:
    """First and last year that both sides cover: one row, null when a side has no rows."""
    at = lambda s: F.when(F.col(side) == s, F.col(year))
    ends = df.where(F.col(side).isin(a, b)).agg(
        F.min(at(a)).alias("a0"), F.max(at(a)).alias("a1"), F.min(at(b)).alias("b0"), F.max(at(b)).alias("b1")
    )
    both = F.col("a0").isNotNull() & F.col("b0").isNotNull()
    return ends.select(
        F.when(both, F.greatest("a0", "b0")).alias("first_year"), F.when(both, F.least("a1", "b1")).alias("last_year")
    )


def overlap_window(df: DataFrame, side: str, a: str, b: str, year: str = "year") -> DataFrame:
    """Rows of both sides within their shared years (two numbers, found first so the filter reaches the scan)."""
    ends = overlap_years(df, side, a, b, year).first()
    return year_window(df.where(F.col(side).isin(a, b)), ends.first_year, ends.last_year, year)


def min_points(
    df: DataFrame, entity: str, n: int = 2, out: str = "years", store: bool = False, store_counts: bool = True
) -> DataFrame:
    """Rows of entities with at least ``n`` rows; the count is a pre-aggregated side, not a window.

    The rows are read twice; ``store=True`` writes them first. The counts are written, so that an entity with very many
    rows can be split; ``store_counts=False`` is for rows that an entity has few of, such as one for each year.
    """
    df = stored(df) if store else df
    counts = df.groupBy(F.col(entity).alias("_entity")).agg(F.count("*").alias(out)).where(F.col(out) >= n)
    counts = stored(counts) if store_counts else counts
    return df.join(counts, F.col(entity).eqNullSafe(F.col("_entity"))).select(*df.columns, out)


def cohort_pin(
    ranked: DataFrame, entity: str, k: int, first_year: int | None = None, last_year: int | None = None,
    year: str = "year", position: str = "position", store: bool = False,
) -> DataFrame:
    """Pin each entity to a cohort for all its years.

    ``last_top`` with ``slot`` = its position in the last year; ``first_top`` for entities in the first year's
    top ``k`` that are not pinned yet, with ``slot`` counted from the lowest placed; ``other`` otherwise.
    Each pinned list has at most ``k`` rows. ``ranked`` is read four times; ``store=True`` writes it first.
    """
    ranked = stored(ranked) if store else ranked
    if first_year is None or last_year is None:
        ends = ranked.agg(F.min(year).alias("lo"), F.max(year).alias("hi")).first()
        first_year = ends.lo if first_year is None else first_year
        last_year = ends.hi if last_year is None else last_year

    def top_of(which: int | None) -> DataFrame:
        return ranked.where((F.col(year) == which) & (F.col(position) <= k)).select(
            F.col(entity).alias("_entity"), F.col(position).cast("long").alias("_slot")
        )

    last = top_of(last_year)
    first = top_of(first_year).join(last.select("_entity"), "_entity", "left_anti")
    lowest_first = F.array_sort(F.collect_list(F.struct((-F.col("_slot")).alias("at"), F.col("_entity").alias("e"))))
    numbered = first.agg(lowest_first.alias("a")).select(F.posexplode("a").alias("i", "s")).select(
        F.col("s.e").alias("_entity"), (F.col("i") + 1).cast("long").alias("_slot"), F.lit("first_top").alias("_cohort")
    )
    pins = last.withColumn("_cohort", F.lit("last_top")).unionByName(numbered)
    return ranked.join(pins, F.col(entity) == F.col("_entity"), "left").select(
        *ranked.columns, F.coalesce("_cohort", F.lit("other")).alias("cohort"), F.col("_slot").alias("slot")
    )


def ranking_table(
    df: DataFrame, entity: str, value: str = "count", k: int = 10, side: str | None = None,
    sides: tuple[str, str] | None = None, show: str | None = None, drop_zero: bool = False,
    exclude_members: Sequence[str] = (), year: str = "year", first_year: int | None = None, last_year: int | None = None,
) -> DataFrame:
    """The table behind a ranking chart: rank and position per year, shared years, minimum points, cohorts.

    With ``side`` and ``sides`` the years are cut to those both sides cover, and ``show`` is the side ranked.
    Ranks are taken per year over all entities before the cut. The ranked rows are written before they are read several times.
    """
    df = df if side is None else stored(df)
    rows = df if side is None else df.where(F.col(side) == show)
    ranked = rank_by_year(rows, entity, value, year, exclude_members=exclude_members, store=side is None)
    if side is not None:
        ends = overlap_years(df, side, *sides, year=year).first()
        ranked = year_window(ranked, ends.first_year, ends.last_year, year)
    if drop_zero:
        ranked = nonzero(ranked, value)
    pointed = min_points(ranked, entity, store=True, store_counts=False)
    return cohort_pin(pointed, entity, k, first_year, last_year, year, store=True)


def sort_mart(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Global sort, nulls last."""
    return df.orderBy(*[F.asc_nulls_last(k) for k in keys])
