"""Text column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from flowmart.functions.numbers import _col
from flowmart.schema import INDUSTRY_TOTAL

INDUSTRY_CODE = r"\[([0-9]{4})\]\z"
INDUSTRY_SUFFIX = r"\s*\[[^\]]+\]\z"


def blank_to_null(c, tokens: Sequence[str] = ("",)) -> Column:
    """Trimmed text; blanks and placeholder tokens become null."""
    text = F.trim(_col(c))
    marks = sorted({t.strip() for t in tokens} | {""})
    return F.when(~text.isin(marks), text)


def class_code(c, pad: bool = False, match: str = "prefix") -> Column:
    """Class text to its code: ``Class 07`` → ``7`` (``07`` when padded), ``Other…`` and ``Unknown…`` kept.

    ``match`` tells how the two words are found: at the start (``prefix``) or anywhere (``contains``).
    """
    if match not in ("prefix", "contains"):
        raise ValueError(f"match must be 'prefix' or 'contains', not {match!r}")
    text = F.trim(_col(c))
    low = F.lower(text)
    found = (lambda word: low.startswith(word)) if match == "prefix" else (lambda word: low.contains(word))
    digits = F.regexp_extract(text, "([0-9]+)", 1)
    number = F.regexp_replace(digits, "^0+([0-9])", "$1")
    if pad:
        number = F.when(F.length(number) < 2, F.lpad(number, 2, "0")).otherwise(number)
    return (
        F.when(found("other"), "Other")
        .when(found("unknown"), "Unknown")
        .when(digits != "", number)
        .otherwise(text)
    )


def is_industry_group(c, total: str = INDUSTRY_TOTAL) -> Column:
    """The all-industries row, or a row whose text ends in a four-digit code in brackets."""
    return (_col(c) == total) | _col(c).rlike(INDUSTRY_CODE)


def industry_code(c) -> Column:
    return F.nullif(F.regexp_extract(_col(c), INDUSTRY_CODE, 1), F.lit("")).try_cast("int")


def industry_name(c, total: str = INDUSTRY_TOTAL) -> Column:
    return F.when(_col(c) == total, "Total").otherwise(F.trim(F.regexp_replace(_col(c), INDUSTRY_SUFFIX, "")))


def shorten(c, old: str, new: str) -> Column:
    """Replace the first occurrence of ``old``."""
    text = _col(c)
    at = F.locate(old, text)
    return F.when(
        at > 0, F.concat(F.substring(text, F.lit(1), at - 1), F.lit(new), F.substring(text, at + len(old), F.length(text)))
    ).otherwise(text)


def plain_dashes(c) -> Column:
    """En and em dashes to hyphens, so labels typed either way compare equal."""
    return F.translate(_col(c), "–—", "--")
