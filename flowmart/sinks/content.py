"""What a table holds, as numbers that do not depend on the order of its rows."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, functions as F

#: Seeds of the two hashes of a row; both sums would have to agree by chance.
SEEDS = (1, 2)


@dataclass(frozen=True)
class Content:
    """Row count and, for each group of columns, the sums of two row hashes over all rows."""

    rows: int
    sums: dict[str, tuple[Decimal, ...]]

    @property
    def fingerprint(self) -> str:
        """One short text for the whole content."""
        parts = [str(self.rows), *[f"{name}={':'.join(str(int(v)) for v in self.sums[name])}" for name in sorted(self.sums)]]
        return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:32]

    def differing(self, other: Content) -> list[str]:
        """The groups whose rows differ as multisets."""
        return sorted(name for name in self.sums.keys() | other.sums.keys() if self.sums.get(name) != other.sums.get(name))


def by_column(df: DataFrame) -> dict[str, list[str]]:
    """A group for each column, and ``*`` for all together (by name, as partition columns move), which tells rows whose values were exchanged."""
    return {**{c: [c] for c in df.columns}, "*": sorted(df.columns)}


def content_sums(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> list[Column]:
    """The aggregates behind :class:`Content`: native hashes, nulls told from their neighbours, summed without overflow."""
    out = [F.count(F.lit(1)).alias("n")]
    for i, columns in enumerate(groups.values()):
        cells = [part for c in columns for part in (F.isnull(df[f"`{c}`"]), df[f"`{c}`"])]
        for seed in SEEDS:
            out.append(F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(20,0)")).alias(f"s{i}_{seed}"))
    return out


def _content(found: Mapping, groups: Mapping[str, Sequence[str]]) -> Content:
    sums = {name: tuple(Decimal(found[f"s{i}_{seed}"] or 0) for seed in SEEDS) for i, name in enumerate(groups)}
    return Content(found["n"], sums)


def content_of(df: DataFrame, groups: Mapping[str, Sequence[str]] | None = None) -> Content:
    """The content of ``df``: one aggregate over one scan, of which a row per task is shuffled."""
    groups = by_column(df) if groups is None else groups
    return _content(df.agg(*content_sums(df, groups)).first().asDict(), groups)


class Observed:
    """``df`` with its content observed while an action runs over it; ``content()`` afterwards."""

    def __init__(self, df: DataFrame, groups: Mapping[str, Sequence[str]] | None = None) -> None:
        self.groups, self.seen = by_column(df) if groups is None else groups, Observation()
        self.df = df.observe(self.seen, *content_sums(df, self.groups))

    def content(self) -> Content:
        return _content(self.seen.get, self.groups)
