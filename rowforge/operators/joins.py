"""Joins beyond the basic types: skew-salted, band, array membership.

The basic types (inner, full, left, right, semi, anti, USING) are Spark's own
``DataFrame.join`` and are used as such.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALT = "join_salt"
CELL = "band_cell"
HOT = "hot_key"
HASH = "key_hash"
EDGES = "band_edges"
MEMBER = "array_member"
FOUND, HERE, PLACE, ANY = "member_found", "member_row", "member_place", "member_any"
# Fixed value: number of salts when the caller gives none.
SALTS = 20
LEAST_HOT_SHARE = 1e-4
SKETCHES = 64
DENSE_SHARE, CELLS = 0.01, 64

_ONE_SIDED = ("inner", "left", "left_semi", "left_anti")


def _disjoint(left: DataFrame, right: DataFrame, on: Sequence[str]) -> None:
    shared = (set(left.columns) & set(right.columns)) - set(on)
    if shared:
        raise ValueError(f"columns on both sides, rename them first: {sorted(shared)}")


def _join_on(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, residual: Column | None
) -> DataFrame:
    """Equi-join on same-named columns plus a residual condition, left keys kept."""
    names = {c: f"{c}_of_right" for c in on}
    conditions = [F.col(c) == F.col(r) for c, r in names.items()]
    if residual is not None:
        conditions.append(residual)
    joined = left.join(right.withColumnsRenamed(names), reduce(lambda a, b: a & b, conditions), how)
    return joined.drop(*names.values())


def hot_keys(df: DataFrame, on: Sequence[str], min_share: float) -> DataFrame:
    """Keys that each hold at least ``min_share`` of all rows, with their counts.

    There are at most ``1 / min_share`` of them, whatever the size of ``df``. A first pass over
    the key columns fills frequent-items sketches of the key's hash; a second counts only the rows
    of the candidates they name, so that no key column is grouped in full. A sketch that
    tracks ``6 / min_share`` items names each one above 7/8 of the share, and those from half the
    share up are at most ``2 / min_share``: no hot key is missed, and the counts are exact.
    Rows with a null in ``on`` count as rows, but are no key.
    """
    if not LEAST_HOT_SHARE / 10 <= min_share <= 1:
        raise ValueError(f"min_share must be in [{LEAST_HOT_SHARE / 10}, 1]")
    tracked, most = math.ceil(6 / min_share), math.ceil(2 / min_share) + 1
    hashed = df.select(*on, F.xxhash64(*on).alias(HASH))
    # sketches of a few groups of partitions first: the last task merges SKETCHES of them, not one for each task
    partial = hashed.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCHES)).alias("part")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.call_function("approx_top_k_accumulate", HASH, F.lit(tracked)).alias("sketch"),
    )
    merged = partial.agg(
        F.sum("rows").alias("total"),
        F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(tracked)).alias("sketch"),
    )
    named = F.inline(F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(most)))
    candidates = merged.where(F.col("total") > 0).select("total", named).select(F.col("item").alias(HASH), "total")
    counted = hashed.na.drop(subset=list(on)).join(F.broadcast(candidates), HASH)
    counts = counted.groupBy(*on).agg(F.count(F.lit(1)).alias("rows"), F.any_value("total").alias("total"))
    return counts.where(F.col("rows") >= F.col("total") * F.lit(min_share)).drop("total")


def hot_values(df: DataFrame, columns: Sequence[str], min_share: float) -> DataFrame:
    """For each column the values that hold at least ``min_share`` of the rows: field, name, rows.

    All columns share the two passes of ``hot_keys``; values are given as text, nulls are left out.
    """
    fields = F.array(
        *(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("name")) for c in columns)
    )
    return hot_keys(df.select(F.inline(fields)), ["field", "name"], min_share / len(columns))


def _holds_map(kind: T.DataType) -> bool:
    """Whether a type holds a map or a variant, which Spark does not hash."""
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType | T.VariantType)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    salts: int = SALTS,
    hot_share: float | None = None,
    salt_on: Sequence[str] = (),
    residual: Column | None = None,
) -> DataFrame:
    """Equi-join that spreads each left key over ``salts`` tasks.

    Each left row carries one salt, each right row is repeated for every salt,
    so the result equals the plain join. With ``hot_share`` only keys holding
    at least that share of the left rows are spread (found by one more pass
    over the left keys; at most ``1 / hot_share`` of them, hence broadcast),
    and all other right rows travel once.

    The salt is a hash of the partition a row is read from and of ``salt_on``, by
    default all left columns that can be hashed. It does not depend on row
    order, so a task rerun after a lost executor salts alike; rows of one
    partition are spread, and exact copies over partitions. Both sides consult the
    same hot keys, so ``left`` must give the same rows each time it is read.

    The repeated rows are shuffled whatever their size: Spark's estimate does not count
    the repeats, so that it would gather ``salts`` times a broadcast's limit in the driver.
    """
    if how not in _ONE_SIDED:
        raise ValueError(f"how must be one of {_ONE_SIDED}: repeated right rows must not surface")
    if salts < 1:
        raise ValueError("salts must be at least 1")
    if hot_share is not None and hot_share < LEAST_HOT_SHARE:
        raise ValueError(f"hot_share must be at least {LEAST_HOT_SHARE}: its keys are broadcast")
    _disjoint(left, right, on)
    on = list(on)
    if salts == 1:
        return _join_on(left, right, on, how, residual)

    spread_by = list(salt_on) or [f.name for f in left.schema if not _holds_map(f.dataType)]
    origin = F.xxhash64(F.spark_partition_id(), *spread_by)
    salt = F.pmod(origin, F.lit(salts)).cast("int")
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    if hot_share is None:
        salted = left.withColumn(SALT, salt)
        repeated = right.withColumn(SALT, F.explode(every_salt))
    else:
        hot = F.broadcast(hot_keys(left, on, hot_share).select(*on, F.lit(True).alias(HOT)))
        unmatched = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in on))
        spread = F.col(HOT).isNotNull() | unmatched
        salted = left.join(hot, on, "left").withColumn(SALT, F.when(spread, salt).otherwise(0))
        repeated = right.join(hot, on, "left").withColumn(
            SALT, F.explode(F.when(F.col(HOT), every_salt).otherwise(F.array(F.lit(0))))
        )
        salted, repeated = salted.drop(HOT), repeated.drop(HOT)
    return _join_on(salted, repeated.hint("merge"), [*on, SALT], how, residual).drop(SALT).select(
        *left.columns, *([] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in on])
    )


def _fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own estimate lets it broadcast the frame."""
    spark = df.sparkSession
    setting = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting) if setting != "-1" else -1
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def band_edges(df: DataFrame, on: Sequence[str], band: str, width: float) -> DataFrame:
    """Where to cut the band of each dense key: the quantiles of its values, at least four widths apart.

    Dense are the keys with ``DENSE_SHARE`` of the rows, so there are at most ``1 / DENSE_SHARE`` of
    them, with ``CELLS`` edges each at most. Dense stretches lie between near quantiles and are cut
    often, sparse ones seldom.
    """
    dense = F.broadcast(hot_keys(df, on, DENSE_SHARE).select(*on))
    values = df.select(*on, F.col(band).cast("double").alias(band)).join(dense, list(on), "left_semi")
    shares = [i / (CELLS + 1) for i in range(1, CELLS + 1)]
    quantiles = values.groupBy(*on).agg(F.percentile_approx(band, shares, 20 * CELLS).alias(EDGES))
    apart = lambda kept, e: F.coalesce(e - F.try_element_at(kept, F.lit(-1)) >= 4 * width, F.lit(True))
    none = F.array().cast("array<double>")
    thinned = F.aggregate(EDGES, none, lambda kept, e: F.when(apart(kept, e), F.array_append(kept, e)).otherwise(kept))
    return quantiles.where(F.col(EDGES).isNotNull()).withColumn(EDGES, thinned)


def band_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_band: str,
    right_band: str,
    width: float,
    how: str = "inner",
    *,
    salts: int = 1,
) -> DataFrame:
    """Join rows with equal ``on`` columns and ``abs(left_band - right_band) <= width``.

    A right side that Spark can broadcast is joined as it is, the band as a condition. Otherwise the band of
    every dense key is cut into cells at the quantiles of its right rows (``band_edges``); a left row lies in one cell, a
    right row is repeated for the one or two cells its partners can lie in. Joining on key and cell compares near
    neighbours only, not all pairs of a dense key; all other keys are one cell and nothing of them is repeated.
    A reach wider than the band leaves room for floating-point rounding;
    the exact test is the residual condition. ``right`` must give the same rows each time it is read.
    """
    if how not in _ONE_SIDED:
        raise ValueError(f"how must be one of {_ONE_SIDED}")
    if width < 0:
        raise ValueError("width must not be negative")
    _disjoint(left, right, on)
    near = F.abs(F.col(left_band) - F.col(right_band)) <= F.lit(width)
    if width == 0:
        celled = left.withColumn(CELL, F.col(left_band).cast("double"))
        repeated = right.withColumn(CELL, F.col(right_band).cast("double"))
    elif _fits_broadcast(right):
        return _join_on(left, right, on, how, near).select(
            *left.columns, *([] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in on])
        )
    else:
        edges = F.broadcast(band_edges(right, on, right_band, width))
        cell_of = lambda v: F.coalesce(F.size(F.filter(EDGES, lambda e: e <= v)), F.lit(0))
        reach, centre = 1.25 * width, F.col(right_band).cast("double")
        cells = F.sequence(cell_of(centre - F.lit(reach)), cell_of(centre + F.lit(reach)))
        celled = left.join(edges, list(on), "left").withColumn(CELL, cell_of(F.col(left_band).cast("double"))).drop(EDGES)
        repeated = right.join(edges, list(on), "left").withColumn(CELL, F.explode(cells)).drop(EDGES)
        celled, repeated = celled.select(*left.columns, CELL), repeated.select(*right.columns, CELL)
    return salted_join(celled, repeated, [*on, CELL], how, salts=salts, residual=near).drop(CELL)


def band_join_avg(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    on: Sequence[str],
    left_band: str,
    right_band: str,
    width: float,
    value: str,
    name: str,
    *,
    salts: int = 1,
) -> DataFrame:
    """Average right ``value`` over the band-join partners of each ``by`` group.

    The right rows that agree on key and band are summed before the join, also where the right side could be
    broadcast: a left row meets one row per distinct band value of its key, not one per right row.
    """
    needed = left.select(*dict.fromkeys([*by, *on, left_band]))
    sums = right.groupBy(*on, right_band).agg(
        F.sum(value).alias("value_sum"), F.count(value).alias("value_count")
    )
    pairs = band_join(needed, sums, on, left_band, right_band, width, salts=salts)
    average = F.try_divide(F.sum("value_sum").cast("double"), F.sum("value_count"))
    return pairs.groupBy(*by).agg(average.alias(name))


def array_membership_join(
    left: DataFrame,
    right: DataFrame,
    array_col: str,
    key: str,
    how: str = "inner",
    *,
    left_id: Sequence[str] = (),
    salts: int = 1,
) -> DataFrame:
    """Join a left row to every right row whose ``key`` is in the left row's array.

    The array is exploded (each value once) into an equi-join, where a
    condition on the array would compare all rows with all rows. Both sides are read once.
    ``left`` and ``full`` also keep left rows without a partner, once, and then need ``left_id``, the
    columns that identify a left row; ``right`` and ``full`` keep right rows that no array holds.
    Null values of an array and null keys match nothing. The array itself only travels if
    it is asked for afterwards. Only ``inner`` and ``left`` can be salted.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError("how must be inner, left, right or full")
    if how in ("left", "full") and not left_id:
        raise ValueError("left_id must name the columns identifying a left row")
    if how in ("right", "full") and salts != 1:
        raise ValueError("a right or full join cannot be salted: repeated right rows must not surface")
    _disjoint(left, right, [])
    output = [*left.columns, *right.columns]
    keyed = right.withColumns({MEMBER: F.col(key), FOUND: F.lit(True)})
    values = F.array_distinct(array_col)
    if how in ("inner", "right"):
        members = left.withColumn(MEMBER, F.explode(values))
    else:
        members = left.select("*", F.posexplode_outer(values).alias(PLACE, MEMBER)).withColumn(HERE, F.lit(True))
    if how in ("inner", "left"):
        pairs = salted_join(members, keyed, [MEMBER], how, salts=salts)
    else:
        pairs = members.join(keyed, [MEMBER], how)
    if how in ("inner", "right"):
        return pairs.select(*output)
    # Of a row's values without a partner only the first can speak for the row: it
    # stays if none of the others has a partner either. Right rows alone are spread by key.
    matched = F.col(FOUND).isNotNull()
    first = F.coalesce(F.col(PLACE), F.lit(0)) == 0
    speaking = pairs.where(matched | first)
    spread = F.when(F.col(HERE).isNull(), F.xxhash64(key))
    row = Window.partitionBy(HERE, spread, *left_id)
    alone = F.max(matched).over(row)
    kept = speaking.withColumn(ANY, alone).where(matched | ~F.col(ANY))
    return kept.select(*output)
