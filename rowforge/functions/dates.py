"""Dates held as text, month codes, weekday names.

Unreadable text becomes null or a caller-given default; nothing here raises on
a bad value, and nothing depends on the session time zone or on the clock.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowforge.functions.conditions import decode_value

# Date spellings tried in this order. One-letter months and days
# also read two digits.
DATE_FORMATS = ("yyyy-M-d", "yyyy M d", "yyyy MMM d")

# Month code to name.
MONTH_NAMES = {
    "00": "UNKNOWN",
    "01": "JANUARY",
    "02": "FEBRUARY",
    "03": "MARCH",
    "04": "APRIL",
    "05": "MAY",
    "06": "JUNE",
    "07": "JULY",
    "08": "AUGUST",
    "09": "SEPTEMBER",
    "10": "OCTOBER",
    "11": "NOVEMBER",
    "12": "DECEMBER",
}

# Stand-ins for unreadable dates.
EPOCH = dt.date(1970, 1, 1)
DEFAULT_DATE = dt.date(1900, 1, 1)


def _col(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# What a run of pattern letters can match; other letters match anything.
_SHAPES = {
    "yyyy": "[0-9]{4}",
    "MMM": "[A-Za-z]{3}",
    "MM": "[0-9]{2}",
    "M": "[0-9]{1,2}",
    "dd": "[0-9]{2}",
    "d": "[0-9]{1,2}",
}


def _shape(fmt: str) -> str:
    runs = re.findall(r"([A-Za-z])(\1*)|([^A-Za-z]+)", fmt)
    parts = [re.escape(other) if other else _SHAPES.get(a + more, ".+") for a, more, other in runs]
    return "^" + "".join(parts) + "$"


def parse_date(
    col: str | Column,
    formats: Sequence[str] = DATE_FORMATS,
    default: dt.date | None = None,
) -> Column:
    """Date from text, by the first format that fits; ``default`` when none does.

    A format is tried only on text of its shape, as every failed attempt costs
    an exception.
    """
    text = _col(col)
    attempts = [F.when(text.rlike(_shape(fmt)), F.try_to_date(text, fmt)) for fmt in formats]
    if default is not None:
        attempts.append(F.lit(default))
    return F.coalesce(*attempts)


def age_in_years(since: str | Column, as_of: dt.date) -> Column:
    """Whole years of 365 days between a date and ``as_of``, cut toward zero."""
    days = F.datediff(F.lit(as_of), _col(since))
    return (days / F.lit(365)).cast("int")


def day_of(col: str | Column) -> Column:
    """Day of a date, a time, or ISO text; null for unreadable text."""
    return _col(col).try_cast("date")


def month_end(col: str | Column) -> Column:
    """Last day of the month of a date, a time, or ISO text."""
    return F.last_day(day_of(col))


def month_code(col: str | Column) -> Column:
    """Second part of ``year-month-day`` text, ``00`` when there is none."""
    return F.coalesce(F.get(F.split(_col(col), "-"), F.lit(1)), F.lit("00"))


def month_name(code: str | Column) -> Column:
    return decode_value(code, MONTH_NAMES, "unknown")


def weekday_name(epoch_seconds: str | Column, default: str = "na") -> Column:
    """Upper-case English weekday (UTC) of a time in epoch seconds."""
    days = F.floor(_col(epoch_seconds) / F.lit(86400)).cast("int")
    name = F.upper(F.date_format(F.date_from_unix_date(days), "EEEE"))
    return F.coalesce(name, F.lit(default))
