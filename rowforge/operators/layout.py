"""Partitioning and reuse as the caller sees them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_constants(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Add constant columns in one projection."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def co_partition(
    left: DataFrame, right: DataFrame, on: Sequence[str], partitions: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Hash both sides by the join key, so joins on that key share one exchange.

    Worth it when several joins or aggregates use the same key; a single join
    arranges this by itself. Spark does not split skewed partitions of an
    exchange asked for by name, so a key with hot values wants ``salted_join``.
    """
    count = [] if partitions is None else [partitions]
    return left.repartition(*count, *on), right.repartition(*count, *on)


def partition_balance(df: DataFrame) -> DataFrame:
    """Rows per partition; empty partitions do not show."""
    partition = F.spark_partition_id().alias("partition")
    return df.select(partition).groupBy("partition").agg(F.count(F.lit(1)).alias("rows"))


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a frame for several actions inside a ``with`` block, then release it.

    Only this frame is released, never the cache of the whole session. Blocks
    lost with an executor are recomputed from lineage.
    """
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
