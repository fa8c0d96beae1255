"""Unit conversion by factor."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metres in one unit, and the length from which a value is large.
LENGTH_FACTORS = {"cm": 0.01, "m": 1.0, "km": 1000.0}
LARGE_LENGTH = 1.80


def _factor(unit: Column, factors: Mapping[str, float]) -> Column:
    if any(factor <= 0 for factor in factors.values()):
        raise ValueError("every factor must be positive")
    pairs = [F.lit(item) for pair in factors.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), unit)


def convert_unit(value: str, unit: str, to: str, factors: Mapping[str, float] = LENGTH_FACTORS) -> Column:
    """Value in unit ``to``, rounded to a whole number; null for an unknown unit.

    A value already in ``to`` is left as it is, not rounded.
    """
    if to not in factors:
        raise ValueError(f"unknown target unit {to!r}")
    factor = _factor(F.col(unit), factors)
    converted = F.round(F.col(value) * factor / F.lit(factors[to]))
    return F.when(factor == F.lit(factors[to]), F.col(value).cast("double")).otherwise(converted)


def is_at_least(
    value: str,
    unit: str,
    threshold: float = LARGE_LENGTH,
    factors: Mapping[str, float] = LENGTH_FACTORS,
) -> Column:
    """Whether the value, normalised to the factor-1 unit, reaches ``threshold``."""
    return F.col(value) * _factor(F.col(unit), factors) >= F.lit(threshold)
