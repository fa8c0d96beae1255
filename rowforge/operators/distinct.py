"""Distinct counts that merge: sketches per key and day kept as a table, exact counts where it matters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH, ESTIMATE = "sketch", "estimate"
# 2^12 registers: a standard error of about 1.6 %; six of them are taken as certain.
LG_K, MARGIN = 12, 0.1


def distinct_sketches(df: DataFrame, keys: Sequence[str], day: str, value: str, *, lg_k: int = LG_K) -> DataFrame:
    """One HyperLogLog sketch of ``value`` for each key and day: keys, day, sketch.

    Sketches of days not yet seen can be appended to a stored table; a day is never read again.
    Null values do not count.
    """
    return df.groupBy(*keys, day).agg(F.hll_sketch_agg(value, F.lit(lg_k)).alias(SKETCH))


def distinct_estimates(sketches: DataFrame, keys: Sequence[str], within: Column | None = None) -> DataFrame:
    """keys and the estimated distinct values over all days ``within`` holds for, each value counted once."""
    chosen = sketches if within is None else sketches.where(within)
    return chosen.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias(ESTIMATE))


def keys_with_distinct(
    sketches: DataFrame,
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    at_least: int,
    within: Column | None = None,
    *,
    margin: float = MARGIN,
) -> DataFrame:
    """Keys with at least ``at_least`` distinct values, as an exact count would find them.

    Merged sketches decide where the estimate is farther from the threshold than ``margin``; only rows of the
    other keys are read from ``df`` and counted exactly. Sketches of 2^12 registers err by more than
    six standard errors, the default margin, about twice in a thousand million keys.
    """
    if at_least < 1:
        raise ValueError("at_least must be at least 1")
    estimates = distinct_estimates(sketches, keys, within)
    low, high = at_least * (1 - margin) - 1, at_least * (1 + margin) + 1
    sure = estimates.where(F.col(ESTIMATE) > high).select(*keys)
    near = estimates.where(F.col(ESTIMATE).between(low, high)).select(*keys)
    rows = df if within is None else df.where(within)
    same = [F.col(f"rows.{k}").eqNullSafe(F.col(f"near.{k}")) for k in keys]
    asked = rows.select(*keys, value).alias("rows").join(near.alias("near"), same, "left_semi").distinct()
    exact = asked.groupBy(*keys).agg(F.count(value).alias(ESTIMATE)).where(F.col(ESTIMATE) >= at_least)
    return sure.unionByName(exact.select(*keys))
