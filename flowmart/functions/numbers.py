"""Numeric column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\z"

DIGITS = r"^[+-]?[0-9]+\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_number(c) -> Column:
    """True where the text is a plain decimal number; type suffixes, ``nan`` and ``inf`` are not."""
    return F.trim(_col(c).cast("string")).rlike(NUMBER)


def is_digits(c) -> Column:
    return _col(c).rlike(r"^[0-9]+\z")


def to_number(c) -> Column:
    """Text to double; what is not a number becomes null."""
    text = F.trim(_col(c).cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def to_whole(c, kind: str = "int") -> Column:
    """Text to a whole number: ``12.0`` gives 12, ``12.5`` and non-numbers give null.

    Plain digits, the usual case, are cast directly; only other text goes through the general number test.
    """
    text = F.trim(_col(c).cast("string"))
    number = to_number(c)
    general = F.when(number == F.floor(number), number.try_cast(kind))
    return F.when(text.rlike(DIGITS), text.try_cast(kind)).otherwise(general)


def unscale(value, exponent) -> Column:
    """``value × 10^exponent``; a null exponent gives null."""
    return _col(value) * F.pow(F.lit(10.0), _col(exponent))


def null_to_zero_int(c) -> Column:
    return F.coalesce(to_number(c), F.lit(0.0)).cast("int")


def nullable_sum(*cols) -> Column:
    """Row-wise sum that is null only when every part is null."""
    parts = [_col(c) for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in parts])
    return F.when(F.coalesce(*parts).isNotNull(), total)


def percent(part, whole, zero=None) -> Column:
    """``part / whole × 100``; ``zero`` is the result for an empty or zero whole."""
    p, w = _col(part), _col(whole)
    ratio = F.when(w != 0, p / w * F.lit(100.0))
    return ratio if zero is None else F.coalesce(ratio, F.lit(float(zero)))


def year_of(c, prefix: str = "") -> Column:
    """Year from ``1990``, ``2019-05`` or, with a prefix, ``YR1990``."""
    text = F.trim(_col(c).cast("string"))
    if prefix:
        text = F.replace(text, F.lit(prefix), F.lit(""))
    return to_whole(F.left(text, F.lit(4)))
