"""Column functions: each takes columns or literals and returns a ``Column``."""

from rowforge.functions.conditions import decode_value, first_match, starts_with_any
from rowforge.functions.dates import (
    MONTH_NAMES,
    age_in_years,
    day_of,
    month_code,
    month_end,
    month_name,
    parse_date,
    weekday_name,
)
from rowforge.functions.fingerprints import fingerprint
from rowforge.functions.numbers import parse_integer
from rowforge.functions.units import LENGTH_FACTORS, convert_unit, is_at_least

__all__ = [
    "LENGTH_FACTORS",
    "MONTH_NAMES",
    "age_in_years",
    "convert_unit",
    "day_of",
    "decode_value",
    "fingerprint",
    "first_match",
    "is_at_least",
    "month_code",
    "month_end",
    "month_name",
    "parse_date",
    "parse_integer",
    "starts_with_any",
    "weekday_name",
]
