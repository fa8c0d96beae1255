"""Where queries and their SQL register themselves."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Table = Callable[[str], DataFrame]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable:
    """Register a function from a table loader to a frame, with its equivalent SQL."""

    def register(build: Callable[[Table], DataFrame]) -> Callable[[Table], DataFrame]:
        label = name or build.__name__

        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[label] = run
        if sql is not None:
            ORACLES[label] = sql
        return build

    return register


def money(col: str) -> Column:
    """Exact decimal, so that sums do not depend on the order of rows."""
    return F.col(col).cast("decimal(18,2)")


def average(total: Column, count: Column) -> Column:
    """Quotient of an exact sum and a count."""
    return total.cast("double") / count


def epoch_seconds(col: str) -> Column:
    """Seconds since 1970 of a time without zone, whatever the session's zone."""
    days = F.unix_date(F.col(col).cast("date")).cast("long")
    return days * 86400 + F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)
