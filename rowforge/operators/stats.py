"""Grouped, extreme-value and top-k statistics as aggregates with map-side partials."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowforge.functions.dates import month_code, month_name


def count_per_key(df: DataFrame, keys: Sequence[str], name: str = "rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_counts(df: DataFrame, key: str | Column, k: int, *, key_name: str, name: str = "rows") -> DataFrame:
    """The ``k`` most frequent values, ties by value."""
    counts = df.groupBy((F.col(key) if isinstance(key, str) else key).alias(key_name)).agg(
        F.count(F.lit(1)).alias(name)
    )
    return counts.orderBy(F.desc(name), F.asc(key_name)).limit(k)


def most_frequent_month(df: DataFrame, date_text: str) -> DataFrame:
    """Name and count of the month most rows fall in, the earlier month on a tie."""
    top = top_counts(df, month_code(date_text), 1, key_name="month_code")
    return top.select(month_name("month_code").alias("month"), "rows")


def field_stats(df: DataFrame, col: str, sentinel: Any = None) -> DataFrame:
    """Sum, least, greatest, average and count of a field in one pass, sentinel values aside."""
    if sentinel is not None:
        df = df.where(F.col(col) != F.lit(sentinel))
    return df.agg(
        F.sum(col).alias("total"),
        F.min(col).alias("least"),
        F.max(col).alias("greatest"),
        F.try_divide(F.sum(col).cast("double"), F.count(col)).alias("average"),
        F.count(col).alias("rows"),
    )


def read_quality(df: DataFrame, sentinels: Mapping[str, Any]) -> DataFrame:
    """Rows with a sentinel in any field, and the others, counted in one pass."""
    bad = F.lit(False)
    for col, sentinel in sentinels.items():
        bad = bad | F.col(col).eqNullSafe(F.lit(sentinel))
    return df.agg(F.count_if(bad).alias("incorrect"), F.count_if(~bad).alias("correct"))


def with_average(df: DataFrame, col: str, name: str) -> DataFrame:
    """Attach the average over all rows, a null counting as 0, to every row.

    The average is a scalar subquery: one value sent with the plan.
    """
    average = df.agg(
        F.try_divide(F.sum(col).cast("double"), F.count(F.lit(1)))
    )
    return df.withColumn(name, F.coalesce(average.scalar(), F.lit(0.0)))


@dataclass(frozen=True)
class ExtremeOf:
    """Look for the extreme group of ``key`` within ``location``, labelled ``kind``."""

    kind: str
    key: str
    location: str
    extreme: str

    def __post_init__(self) -> None:
        if self.extreme not in ("max", "min"):
            raise ValueError(f"extreme must be max or min, got {self.extreme!r}")


def extreme_groups(df: DataFrame, value: str, wanted: Sequence[ExtremeOf]) -> DataFrame:
    """The group with the greatest (least) value, one row per ``wanted`` entry.

    The highest of the group maxima is the highest value overall, so no groups
    are formed. A pass over ``value`` alone finds the extremes; each then
    filters a scan, which skips all files and row groups that cannot hold it,
    and decides between the few rows left: the least key and location wins.
    Null values do not take part.
    """
    if not wanted:
        raise ValueError("wanted must not be empty")
    # The two subqueries differ by a filter: Spark merges equal ones into a
    # struct, and a comparison with a struct's field does not reach the scan.
    ends = {
        "max": df.agg(F.max(value)),
        "min": df.where(F.col(value).isNotNull()).agg(F.min(value)),
    }
    found = []
    for extreme, end in ends.items():
        entries = [entry for entry in wanted if entry.extreme == extreme]
        if entries:
            reaching = df.where(F.col(value) == end.scalar())
            found.append(_least_groups(reaching, value, entries))
    return reduce(DataFrame.unionByName, found)


def _least_groups(df: DataFrame, value: str, entries: Sequence[ExtremeOf]) -> DataFrame:
    """The least key and location of each entry, from rows that all hold the same value."""
    picks, rows = [], []
    for i, entry in enumerate(entries):
        group = F.struct(
            F.col(entry.key).cast("string").alias("name"),
            F.col(entry.location).cast("string").alias("location"),
        )
        picks.append(F.min(group).alias(f"group{i}"))
        rows.append(
            F.struct(
                F.col(f"group{i}.name").alias("name"),
                F.lit(entry.kind).alias("stats_type"),
                F.col(f"group{i}.location").alias("location"),
                F.col("value"),
                F.lit(entry.extreme).alias("value_type"),
            )
        )
    least = df.agg(F.first(value).alias("value"), *picks).where(F.col("value").isNotNull())
    return least.select(F.inline(F.array(*rows)))
