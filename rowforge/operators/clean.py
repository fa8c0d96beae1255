"""Null handling, text cleaning, casts and duplicate removal."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowforge.functions.dates import DEFAULT_DATE, parse_date
from rowforge.functions.numbers import INTEGER_TYPES, parse_integer


def clean(
    df: DataFrame,
    *,
    required: Sequence[str] = (),
    fallback: Mapping[str, str] | None = None,
    fill: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Drop rows lacking a required value, then fill the remaining nulls.

    ``fallback`` fills a column from another one and comes before ``fill``, so
    it copies the other column as it was, not its fill value. As in
    ``DataFrame.na.fill``, a value only fills columns of its own kind.
    """
    if required:
        df = df.na.drop(subset=list(required))
    if fallback:
        df = df.withColumns({c: F.coalesce(F.col(c), F.col(other)) for c, other in fallback.items()})
    if fill:
        df = df.na.fill(dict(fill))
    return df


def project_filled(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Select the named columns, each null replaced by the column's default."""
    return df.select(*(F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()))


def replace_pattern(df: DataFrame, col: str, pattern: str, replacement: str = "") -> DataFrame:
    """Replace every match of a regular expression in one column."""
    return df.withColumn(col, F.regexp_replace(F.col(col), pattern, replacement))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; a value that does not fit its new type becomes null."""
    text = {name for name, kind in df.dtypes if kind == "string"}
    return df.withColumns(
        {
            c: parse_integer(F.trim(c), t) if c in text and t in INTEGER_TYPES else F.col(c).try_cast(t)
            for c, t in types.items()
        }
    )


def dates_after(
    df: DataFrame,
    col: str,
    after: dt.date,
    formats: Sequence[str] = ("yyyy-M-d",),
    default: dt.date = DEFAULT_DATE,
) -> DataFrame:
    """Rows whose text date is strictly after ``after``; unreadable text counts as ``default``."""
    return df.where(parse_date(col, formats, default) > F.lit(after))


def dedup_by_key(
    df: DataFrame,
    key: str | Column,
    order_by: Sequence[str],
    *,
    key_name: str | None = None,
    keep_null_keys: bool = True,
) -> DataFrame:
    """One row per key: the first by ``order_by``, then by the whole row.

    A minimum over row structs rather than a window, so copies of one key are
    reduced on the map side and never gathered whole in a task. Rows without a
    key are all kept unless ``keep_null_keys`` is off, when they are one group: each
    forms a group of its own with its exact copies, which are counted and repeated
    afterwards, so that one scan and one aggregate serve both kinds.
    A derived ``key`` is kept as a column if ``key_name`` names it.
    """
    if not order_by:
        raise ValueError("order_by must not be empty")
    columns = df.columns
    label = key_name or "dedup_key"
    if label in columns:
        raise ValueError(f"column {label} already exists")
    keyed = df.withColumn(label, F.col(key) if isinstance(key, str) else key)
    output = [*columns, *([key_name] if key_name else [])]
    row = F.struct(*columns)
    ranked = F.struct(F.struct(*order_by).alias("rank"), row.alias("row"))
    if not keep_null_keys:
        kept = keyed.groupBy(label).agg(F.min(ranked)["row"].alias("kept"))
        return kept.select("kept.*", label).select(*output)
    no_key = F.col(label).isNull()
    grouped = keyed.groupBy(label, F.when(no_key, row).alias("own")).agg(
        F.min(F.when(~no_key, ranked))["row"].alias("kept"), F.count(F.lit(1)).alias("rows")
    )
    copies = F.when(no_key, F.col("rows")).otherwise(1)
    chosen = grouped.select(F.coalesce("own", "kept").alias("kept"), label, copies.alias("rows"))
    return repeat_rows(chosen, "rows").select("kept.*", label).select(*output)


def repeat_rows(df: DataFrame, times: str, block: int = 1 << 16) -> DataFrame:
    """Each row as often as its column ``times`` says, without that column; null or below 1: never.

    In two steps, so that no array of more than ``block`` entries is made for any number.
    """
    n = F.col(times).cast("long")
    start, step = f"{times}_from", f"{times}_step"
    starts = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1, F.lit(block).cast("long")))
    here = F.least(n - F.col(start), F.lit(block).cast("long")).cast("int")
    blocks = df.withColumn(start, F.explode(starts))
    return blocks.withColumn(step, F.explode(F.array_repeat(F.lit(0), here))).drop(times, start, step)
