"""Selecting what an incremental load still has to process."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rowforge.functions.dates import day_of, month_end

# Fixed value: number of latest periods compared.
LATEST_PERIODS = 6


def latest_values(df: DataFrame, col: str, n: int = LATEST_PERIODS) -> DataFrame:
    """The ``n`` greatest distinct values of a column, nulls aside."""
    distinct = df.select(col).where(F.col(col).isNotNull()).distinct()
    return distinct.orderBy(F.desc(col)).limit(n)


def missing_periods(
    source: DataFrame,
    target: DataFrame,
    source_date: str,
    target_period: str,
    n: int = LATEST_PERIODS,
) -> DataFrame:
    """Source rows of recent months that the target does not hold yet.

    Of the source's ``n`` latest months, those absent from the target's ``n``
    latest period dates (month ends) are wanted. An empty target wants all
    source rows; finding that out is the one small job run here.

    At most ``n`` periods are wanted, so they are broadcast. The first day of
    the earliest one also bounds the source scan from below, which lets old
    files and row groups be skipped; not so for dates held as text, which need
    not sort by time.
    """
    if target.isEmpty():
        return source
    sent = source.select(month_end(source_date).alias("period"))
    reported = target.select(day_of(target_period).alias("period"))
    wanted = latest_values(sent, "period", n).join(
        F.broadcast(latest_values(reported, "period", n)), "period", "left_anti"
    )
    kind = source.schema[source_date].dataType
    if not isinstance(kind, StringType):
        first_day = wanted.agg(F.min(F.trunc("period", "MM")).cast(kind)).scalar()
        source = source.where(F.col(source_date) >= first_day)
    wanted = wanted.withColumnRenamed("period", "wanted_period")
    return source.join(
        F.broadcast(wanted), month_end(source_date) == F.col("wanted_period"), "left_semi"
    )


def flag_load_batches(
    df: DataFrame, load_day: str, period: str, as_of: dt.date, flag: str = "flag"
) -> DataFrame:
    """Flag 0 for rows of load days that hold the current month's end and nothing else, else 1.

    A day qualifies when both the least and the greatest of its periods equal
    the end of the month of ``as_of``, so a day is reduced to two dates on the
    map side and never gathered. One row per calendar day remains; the date
    type allows 3.7 million of them, which bounds the broadcast. Rows without
    a readable load day count as one batch.
    """
    current = F.last_day(F.lit(as_of))
    days = df.groupBy(day_of(load_day).alias("batch_day")).agg(
        F.min(day_of(period)).alias("first"), F.max(day_of(period)).alias("last")
    )
    days = days.where((F.col("first") == current) & (F.col("last") == current))
    days = days.select("batch_day", F.lit(0).alias(flag))
    same_day = day_of(load_day).eqNullSafe(F.col("batch_day"))
    joined = df.join(F.broadcast(days), same_day, "left").drop("batch_day")
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(1)))


def late_rows(
    df: DataFrame, load_day: str, period: str, as_of: dt.date, flag: str = "flag"
) -> DataFrame:
    """Rows of the previous month's end that did not arrive in a current-month-only batch."""
    previous = F.last_day(F.add_months(F.lit(as_of), -1))
    flagged = flag_load_batches(df, load_day, period, as_of, flag)
    return flagged.where((F.col(flag) == 1) & (day_of(period) == previous))
