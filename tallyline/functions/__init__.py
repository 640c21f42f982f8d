"""Column builders: every function takes Columns (or names) and returns a Column."""

from tallyline.functions.calendar import completed_years, is_under_age, month_of
from tallyline.functions.money import exact_avg, exact_sum, round_half_away, safe_ratio
from tallyline.functions.parsing import (
    parse_cast_date,
    parse_date,
    parse_integer,
    parse_number,
    parse_timestamp,
)
from tallyline.functions.text import (
    blank_to_null,
    document_code,
    fold_prefix,
    fold_values,
    name_key,
    phone_digits,
    trim_spaces,
    upper_code,
    whole_number,
)

__all__ = [
    "blank_to_null", "completed_years", "document_code", "exact_avg", "exact_sum", "fold_prefix",
    "fold_values", "is_under_age", "month_of", "name_key", "parse_cast_date", "parse_date",
    "parse_integer", "parse_number", "parse_timestamp", "phone_digits", "round_half_away",
    "safe_ratio", "trim_spaces", "upper_code", "whole_number",
]
