"""Numbers held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGER_TYPES = ("tinyint", "smallint", "int", "bigint")


def parse_integer(col: str | Column, type: str = "int") -> Column:
    """Integer from text; null when it is not one or does not fit the type.

    The pattern goes first: a cast that fails costs an exception per row, some
    ten times the price of the test, and mostly-text columns fail mostly.
    """
    if type not in INTEGER_TYPES:
        raise ValueError(f"type must be one of {INTEGER_TYPES}, got {type!r}")
    text = F.col(col) if isinstance(col, str) else col
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast(type))
