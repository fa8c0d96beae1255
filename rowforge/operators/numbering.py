"""Dense row numbers over a whole table, and samples that any partitioning gives alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowforge.staging import staged

PART, PLACE, BEFORE, TIE, ORIGIN = "number_part", "number_place", "number_before", "number_tie", "number_origin"
MARK = "sample_mark"


def dense_row_numbers(
    df: DataFrame, order_by: Sequence[str | Column], name: str = "row_number", *, start: int = 1, partitions: int | None = None
) -> DataFrame:
    """Number all rows from ``start`` by ``order_by`` without gaps, and without a window over the whole table.

    Rows are dealt by range, numbered within their partition and written once, so that ranges cannot shift
    between the passes or when an executor is lost; counts per partition, summed up from the
    first on, are then joined back. Only these counts, a row for each partition, meet in one task.
    Rows with equal order are numbered in an order of their own that does not depend on how many there are:
    they are dealt on by a hash of the whole row and, exact copies, by where they were read, so a
    value that many rows share fills several partitions.
    ``partitions`` defaults to ``spark.sql.shuffle.partitions``.
    """
    if not order_by:
        raise ValueError("order_by must not be empty")
    taken = {name, PART, PLACE, BEFORE, TIE, ORIGIN} & set(df.columns)
    if taken:
        raise ValueError(f"columns already exist: {sorted(taken)}")
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumns({TIE: F.xxhash64(*df.columns), ORIGIN: F.spark_partition_id()})
    order = [*order_by, TIE, ORIGIN]
    dealt = tied.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    # the upper 31 bits of this id are the partition, the lower 33 the place in it
    place = F.monotonically_increasing_id()
    numbered = dealt.withColumn(PLACE, place).drop(TIE, ORIGIN)
    low = F.lit((1 << 33) - 1)
    held = staged(
        numbered.withColumns({PART: F.shiftright(PLACE, 33), PLACE: F.col(PLACE).bitwiseAND(low)}), "row-numbers"
    )
    counts = held.groupBy(PART).agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(PART, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(BEFORE))
    joined = held.join(F.broadcast(offsets), PART)
    return joined.select(*df.columns, (F.col(BEFORE) + F.col(PLACE) + start).cast("long").alias(name))


def hash_sample(
    df: DataFrame, key: str | Column, k: int, *, by: Sequence[str] = (), seed: str = ""
) -> DataFrame:
    """``k`` rows (of each group of ``by``) whose keys have the least md5 of ``seed`` and key.

    The same rows whatever the partitioning or order; a greater ``k`` adds rows and takes none
    away, and samples of parts merge into the sample of the whole. Keys are compared as text;
    rows without a key take no part. Rows that share a key are ordered by the whole row. Each task hands on
    ``k`` rows (of each group) at most.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if MARK in df.columns:
        raise ValueError(f"column {MARK} already exists")
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    marked = df.withColumn(MARK, F.md5(F.concat(F.lit(seed), text).cast("binary"))).where(F.col(MARK).isNotNull())
    order = [F.asc(MARK), *(F.asc(c) for c in df.columns)]
    if not by:
        return marked.orderBy(*order).limit(k).drop(MARK)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return marked.withColumn("sample_rank", rank).where(F.col("sample_rank") <= k).drop(MARK, "sample_rank")
