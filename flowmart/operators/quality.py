"""Data-quality checks: one aggregate pass per table, reported as rows, and a gate that blocks a write."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, functions as F, types as T


@dataclass(frozen=True)
class Check:
    """A named verdict over aggregates; ``measures`` are computed together with those of the other checks."""

    name: str
    passed: Column
    observed: Column
    measures: Mapping[str, Column] = field(default_factory=dict)


Rule = Callable[[DataFrame], Check]


_serial = count()


def _fresh(name: str) -> str:
    """A measure name of its own, so that rules of one kind can be given several times."""
    return f"{name}_{next(_serial)}"


def _text(value) -> str:
    return "[" + ", ".join(str(v) for v in value) + "]"


def columns_are(expected: Sequence[str]) -> Rule:
    """Exactly these columns in this order."""
    return lambda df: Check("columns", F.lit(df.columns == list(expected)), F.lit(_text(df.columns)))


def row_count_is(expected: int) -> Rule:
    n = _fresh("rows")
    return lambda df: Check("row_count", F.col(n) == expected, F.col(n), {n: F.count("*")})


def no_nulls(cols: Sequence[str]) -> Rule:
    n = _fresh("nulls")

    def rule(df: DataFrame) -> Check:
        any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
        return Check("no_nulls", F.col(n) == 0, F.col(n), {n: F.count_if(any_null)})

    return rule


def no_blanks(cols: Sequence[str]) -> Rule:
    n = _fresh("blanks")

    def rule(df: DataFrame) -> Check:
        any_blank = reduce(lambda a, b: a | b, [F.coalesce(F.trim(c) == "", F.lit(False)) for c in cols])
        return Check("no_blanks", F.col(n) == 0, F.col(n), {n: F.count_if(any_blank)})

    return rule


def type_is(col: str, kind: str) -> Rule:
    """``integer`` or ``numeric``."""
    family = {"integer": T.IntegralType, "numeric": T.NumericType}[kind]

    def rule(df: DataFrame) -> Check:
        found = df.schema[col].dataType
        return Check(f"{kind}:{col}", F.lit(isinstance(found, family)), F.lit(found.simpleString()))
    return rule


def in_range(col: str, lo, hi) -> Rule:
    low, high = _fresh("min"), _fresh("max")

    def rule(df: DataFrame) -> Check:
        span = F.concat_ws("..", F.col(low).cast("string"), F.col(high).cast("string"))
        inside = (F.col(low) >= lo) & (F.col(high) <= hi)
        return Check(f"range:{col}", inside, span, {low: F.min(col), high: F.max(col)})
    return rule


def only_value(col: str, value) -> Rule:
    low, high, nulls = _fresh("min"), _fresh("max"), _fresh("nulls")

    def rule(df: DataFrame) -> Check:
        same = (F.col(low) == value) & (F.col(high) == value) & (F.col(nulls) == 0)
        span = F.concat_ws("..", F.col(low).cast("string"), F.col(high).cast("string"))
        return Check(f"only:{col}", same, span, {low: F.min(col), high: F.max(col), nulls: F.count_if(F.col(col).isNull())})
    return rule


def some(name: str, predicate: Column) -> Rule:
    """At least one row satisfies the predicate (some negative value, not all zero …)."""
    n = _fresh("some")
    return lambda df: Check(name, F.col(n) > 0, F.col(n), {n: F.count_if(predicate)})


def spot(name: str, rows: Column, holds: Column, expected: int = 1) -> Rule:
    """Exactly ``expected`` rows match, and each of them satisfies ``holds``."""
    matched, good = _fresh("spot"), _fresh("good")
    return lambda df: Check(
        name,
        (F.col(matched) == expected) & (F.col(good) == expected),
        F.col(matched),
        {matched: F.count_if(rows), good: F.count_if(rows & holds)},
    )


def without_members(col: str, banned: Sequence[str]) -> Rule:
    n = _fresh("banned")
    return lambda df: Check(f"banned:{col}", F.col(n) == 0, F.col(n), {n: F.count_if(F.col(col).isin(*banned))})


def with_members(col: str, required: Sequence[str]) -> Rule:
    names = [_fresh("has") for _ in required]

    def rule(df: DataFrame) -> Check:
        measures = {n: F.coalesce(F.bool_or(F.col(col) == m), F.lit(False)) for n, m in zip(names, required)}
        absent = reduce(lambda a, b: a + b, [(~F.col(n)).cast("int") for n in names])
        return Check(f"required:{col}", absent == 0, absent, measures)
    return rule


@dataclass(frozen=True)
class UniqueKey:
    """No two rows share the key; needs its own grouping, so it is a second pass."""

    keys: tuple[str, ...]


def report(df: DataFrame, rules: Sequence[Rule | UniqueKey]) -> DataFrame:
    """``check, passed, observed`` — one row per rule, all simple rules in one aggregate."""
    checks = [r(df) for r in rules if not isinstance(r, UniqueKey)]
    measures = {name: agg for c in checks for name, agg in c.measures.items()}
    rows = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("check"),
                F.coalesce(c.passed, F.lit(False)).alias("passed"),
                F.coalesce(c.observed.cast("string"), F.lit("null")).alias("observed"),
            )
            for c in checks
        ]
    )
    one = df.agg(F.count("*").alias("_all"), *[agg.alias(name) for name, agg in measures.items()])
    parts = [one.select(F.explode(rows).alias("r")).select("r.*")] if checks else []
    for r in rules:
        if isinstance(r, UniqueKey):
            repeated = duplicates(df, r.keys).agg(F.count("*").alias("n"))
            parts.append(
                repeated.select(
                    F.lit("unique:" + ",".join(r.keys)).alias("check"),
                    (F.col("n") == 0).alias("passed"),
                    F.col("n").cast("string").alias("observed"),
                )
            )
    return reduce(lambda a, b: a.unionByName(b), parts)


def members(df: DataFrame, col: str, banned: DataFrame, required: DataFrame, rule_col: str = "member") -> DataFrame:
    """Violations against rule tables: banned members that appear and required members that do not."""
    present = df.select(F.col(col).alias("member")).distinct()
    ban = banned.select(F.col(rule_col).alias("member")).distinct()
    need = required.select(F.col(rule_col).alias("member")).distinct()
    return (
        present.join(ban, "member", "left_semi").withColumn("violation", F.lit("banned"))
        .unionByName(need.join(present, "member", "left_anti").withColumn("violation", F.lit("missing")))
    )


def duplicates(df: DataFrame, keys: Sequence[str], out: str = "n_rows") -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias(out)).where(F.col(out) > 1)


def constants(df: DataFrame, expected: Mapping[str, object]) -> DataFrame:
    """Per column: is its only value the expected one, and which values bound it."""
    stats = df.agg(
        *[
            agg.alias(f"{kind}{i}")
            for i, c in enumerate(expected)
            for kind, agg in (
                ("lo", F.min(c).cast("string")), ("hi", F.max(c).cast("string")), ("nulls", F.count_if(F.col(c).isNull()))
            )
        ]
    )
    rows = []
    for i, (c, value) in enumerate(expected.items()):
        same = (F.col(f"lo{i}") == str(value)) & (F.col(f"hi{i}") == str(value)) & (F.col(f"nulls{i}") == 0)
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.lit(str(value)).alias("expected"),
                F.col(f"lo{i}").alias("lowest"),
                F.col(f"hi{i}").alias("highest"),
                F.coalesce(same, F.lit(False)).alias("passed"),
            )
        )
    return stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def gate(checked: DataFrame) -> None:
    """Raise when a check failed, before anything is written. Only the failed checks reach the driver."""
    failed = checked.where(~F.col("passed")).collect()
    if failed:
        raise ValueError("quality gate failed: " + "; ".join(str(r.asDict()) for r in failed))
