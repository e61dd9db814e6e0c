"""Column expressions shared by operators; all run inside generated code, none in Python."""

from flowmart.functions.numbers import (
    has_number, is_digits, null_to_zero_int, nullable_sum, percent, to_number, to_whole, unscale, year_of,
)
from flowmart.functions.text import (
    blank_to_null, class_code, industry_code, industry_name, is_industry_group, plain_dashes, shorten,
)

__all__ = [
    "blank_to_null", "class_code", "has_number", "industry_code", "industry_name", "is_digits",
    "is_industry_group", "null_to_zero_int", "nullable_sum", "percent", "plain_dashes", "shorten",
    "to_number", "to_whole", "unscale", "year_of",
]
