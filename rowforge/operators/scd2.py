"""Slowly changing dimension, type 2: merging an increment into a mart with history.

A mart row is open (the current version of its key) or history. Open rows meet
the increment once, in one join on the key:

=====================================  ==========================================
open row, key not in the increment     kept ("missing")
open row, tracked columns equal        kept ("unchanged")
open row, a tracked column differs     closed at ``as_of`` and a new open row
                                       ("changed")
no open row for the key                a new open row ("new")
history row                            kept, never joined or shuffled
=====================================  ==========================================

Columns compare null-safe, so merging the same increment again changes nothing.
The mart must hold at most one open row per key, which the merge preserves; a
key with several fails the job, as does closing a row that starts after ``as_of``.
With ``small_increment`` only keys of the increment are checked.

An increment that repeats most of the mart, such as a daily snapshot, can be compared by digests
first: with ``buckets`` the open rows and the increment are summed up per bucket of keys, and only
buckets that differ are joined (see ``differing_buckets``).
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rowforge.sinks.landing import land_table
from rowforge.sources.tables import extract_table

# End of validity that marks an open row.
OPEN_END_DATE = "9999-12-31"
OPEN_END_TIMESTAMP = "5999-12-31 00:00:00"

OLD, NEW, STATUS, COPIES = "old_row", "new_row", "status", "copies"
BUCKET, MAX_BUCKETS = "key_bucket", 1 << 20
UNCHANGED, CHANGED, FRESH, MISSING = "unchanged", "changed", "new", "missing"


@dataclass(frozen=True)
class Scd2Config:
    """What a merge needs to know about its mart.

    ``active_col`` names the open flag; without one, a row is open when its
    end date is ``open_end``. ``latest_by`` picks the increment row of a key
    that has several; without it such an increment is refused. ``audit`` maps
    columns to values stamped on every row that took part in the join.
    ``date_format`` serves marts that hold their dates as text.
    """

    keys: Sequence[str]
    tracked: Sequence[str]
    from_col: str = "effective_from_dt"
    to_col: str = "effective_to_dt"
    active_col: str | None = None
    open_end: str = OPEN_END_DATE
    latest_by: Sequence[str] = ()
    audit: Mapping[str, Any] = field(default_factory=dict)
    date_format: str = "yyyy-MM-dd"
    table: str | None = None

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError("keys must not be empty")
        if not self.tracked:
            raise ValueError("tracked must not be empty")
        if set(self.keys) & set(self.tracked):
            raise ValueError("a key column cannot be tracked")

    @classmethod
    def from_json(cls, path: str, **overrides: Any) -> Scd2Config:
        """Parameters of a merge job from a small JSON file on the driver."""
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        keys = spec["join_cols"]
        settings = {
            "keys": keys,
            "tracked": [c for c in spec["sensitive_cols"] if c not in keys],
            "table": f"{spec['database']}.{spec['table']}",
        }
        optional = {
            "from_col": "effective_from_col_name",
            "to_col": "effective_to_col_name",
            "date_format": "date_format",
        }
        settings |= {k: spec[name] for k, name in optional.items() if spec.get(name)}
        return cls(**(settings | overrides))


def _as_type(mart: DataFrame, col: str, value: Any, cfg: Scd2Config) -> Column:
    """A literal in the type the mart holds it in; dates held as text are formatted."""
    target = mart.schema[col].dataType
    if isinstance(target, StringType) and isinstance(value, (dt.date, dt.datetime)):
        return F.date_format(F.lit(value), cfg.date_format)
    return F.lit(value).cast(target)


def _open_and_history(mart: DataFrame, cfg: Scd2Config) -> tuple[Column, Column]:
    """Conditions for open rows and for all others, in forms a scan can take."""
    if cfg.active_col is not None:
        active = F.col(cfg.active_col)
        return active, ~active.eqNullSafe(F.lit(True))
    end = F.col(cfg.to_col)
    if isinstance(mart.schema[cfg.to_col].dataType, StringType):
        # Text may carry a time of day after the date.
        is_open = end.startswith(cfg.open_end)
        return is_open, ~F.coalesce(is_open, F.lit(False))
    marker = _as_type(mart, cfg.to_col, cfg.open_end, cfg)
    return end == marker, ~end.eqNullSafe(marker)


def scd2_history(mart: DataFrame, cfg: Scd2Config) -> DataFrame:
    """Every row that is not open, whenever it was closed."""
    return mart.where(_open_and_history(mart, cfg)[1])


def _one_per_key(increment: DataFrame, cfg: Scd2Config, columns: Sequence[str]) -> DataFrame:
    """Keys and, as a struct, the named columns of the one increment row of each.

    Rows are reduced on the map side, so many copies of one key cost no more
    than one, and the join reuses this aggregate's partitioning. A key that is
    null, or has several rows and no ``latest_by``, fails the job.
    """
    row = F.struct(*columns)
    if cfg.latest_by:
        picked = F.max(F.struct(F.struct(*cfg.latest_by).alias("rank"), row.alias("row")))["row"]
    else:
        picked = F.any_value(row)
    grouped = increment.groupBy(*cfg.keys).agg(
        picked.alias(NEW), F.count(F.lit(1)).alias(COPIES)
    )
    no_key = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in cfg.keys))
    valid = F.when(no_key, F.raise_error(F.lit("increment row without a key")))
    if not cfg.latest_by:
        valid = valid.when(
            F.col(COPIES) > 1,
            F.raise_error(
                F.concat(F.lit("several increment rows for key "), F.to_json(F.struct(*cfg.keys)))
            ),
        )
    return grouped.where(valid.otherwise(F.lit(True))).drop(COPIES)


def _with_keys(increment: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fails the job on an increment row whose key holds a null."""
    no_key = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    return increment.where(F.when(no_key, F.raise_error(F.lit("increment row without a key"))).otherwise(F.lit(True)))


def _digests(rows: DataFrame, keys: Sequence[str], tracked: Sequence[str], buckets: int) -> DataFrame:
    """Per bucket of keys: row count, and xor and sum of row fingerprints, whatever the order of rows."""
    parts = [x for c in [*keys, *tracked] for x in (F.col(c), F.col(c).isNull())]
    first, second = F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)
    hashed = rows.select(_bucket(keys, buckets).alias(BUCKET), first.alias("a"), second.alias("b"))
    low = F.col("b").bitwiseAND(F.lit(0xFFFFFFFF))
    return hashed.groupBy(BUCKET).agg(
        F.struct(F.count(F.lit(1)), F.bit_xor("a"), F.bit_xor("b"), F.sum(low)).alias("digest")
    )


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def differing_buckets(
    left: DataFrame, right: DataFrame, keys: Sequence[str], tracked: Sequence[str], buckets: int
) -> DataFrame:
    """Buckets of keys in which the two sides do not hold the same rows of ``keys`` and ``tracked``.

    Both sides are reduced to a digest per bucket on the map side, so a row for each bucket and
    task is all that travels. Rows compare null-safe. Sides that differ agree in count, both 64-bit
    xors and the sum with a chance of about 2^-128, as fingerprints may. At most ``MAX_BUCKETS``,
    so that the result can be broadcast; take several times as many as rows are expected to change.
    """
    if not 1 <= buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be between 1 and {MAX_BUCKETS}")
    ours = _digests(left, keys, tracked, buckets).withColumnRenamed("digest", "ours")
    theirs = _digests(right, keys, tracked, buckets).withColumnRenamed("digest", "theirs")
    return ours.join(theirs, BUCKET, "full").where(~F.col("ours").eqNullSafe(F.col("theirs"))).select(BUCKET)


def _one_open(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fails the job where ``COPIES`` tells of several open rows for a key.

    Rows whose key holds a null meet no increment row and are let through.
    """
    named = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    message = F.concat(F.lit("several open mart rows for key "), F.to_json(F.struct(*keys)))
    twice = F.when(named & (F.col(COPIES) > 1), F.raise_error(message))
    return counted.where(twice.otherwise(F.lit(True))).drop(COPIES)


def _matched(
    mart: DataFrame,
    increment: DataFrame,
    cfg: Scd2Config,
    small_increment: bool = False,
    columns: Sequence[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Keys, open row, increment row and status: one row per open or incoming key.

    The rows are structs of the mart's ``columns`` (default all) besides the
    keys; what else the increment holds is not carried along.
    """
    keys = list(cfg.keys)
    carried = [c for c in columns or mart.columns if c not in keys]
    replaced = _replaced(cfg)
    offered = [c for c in carried if c in increment.columns and c not in replaced]
    is_open, _ = _open_and_history(mart, cfg)
    current = mart.where(is_open).select(*keys, F.struct(*carried).alias(OLD))
    # Keys in the mart's own types, so that both sides hash alike.
    typed = increment.withColumns({k: F.col(k).cast(mart.schema[k].dataType) for k in keys})
    equal = None
    if buckets is not None:
        # What lies in buckets of equal digests is unchanged and passes by the join.
        compared = typed.withColumns({c: F.col(c).cast(mart.schema[c].dataType) for c in cfg.tracked})
        open_rows = current.select(*keys, *(F.col(OLD)[c].alias(c) for c in cfg.tracked))
        differ = F.broadcast(differing_buckets(open_rows, _with_keys(compared, keys), keys, cfg.tracked, buckets))
        typed = _with_keys(typed, keys).withColumn(BUCKET, _bucket(keys, buckets)).join(differ, BUCKET, "left_semi").drop(BUCKET)
        placed = current.withColumn(BUCKET, _bucket(keys, buckets))
        equal = placed.join(differ, BUCKET, "left_anti").select(*keys, OLD)
        current = placed.join(differ, BUCKET, "left_semi").select(*keys, OLD)
    incoming = _one_per_key(typed, cfg, offered)
    if small_increment:
        # The mart only streams past the increment, which Spark broadcasts if
        # its size allows; a second pass over the open keys finds the new ones
        # and refuses keys that are open more than once.
        met = current.join(incoming, keys, "left")
        known = current.select(*keys).join(incoming.select(*keys), keys, "left_semi")
        counted = known.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES))
        fresh = incoming.join(_one_open(counted, keys), keys, "left_anti")
        blank = F.lit(None).cast(met.schema[OLD].dataType).alias(OLD)
        pairs = met.unionByName(fresh.select(*keys, blank, NEW))
    else:
        # The count uses the exchange and the order that the join needs anyway.
        copies = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        current = _one_open(current.withColumn(COPIES, copies), keys)
        pairs = current.join(incoming, keys, "full")
    differs = reduce(
        lambda a, b: a | b,
        (
            ~F.col(OLD)[c].eqNullSafe(F.col(NEW)[c].cast(mart.schema[c].dataType))
            for c in cfg.tracked
        ),
    )
    status = (
        F.when(F.col(OLD).isNull(), F.lit(FRESH))
        .when(F.col(NEW).isNull(), F.lit(MISSING))
        .when(differs, F.lit(CHANGED))
        .otherwise(F.lit(UNCHANGED))
    )
    pairs = pairs.withColumn(STATUS, status)
    if equal is None:
        return pairs
    blank = F.lit(None).cast(pairs.schema[NEW].dataType).alias(NEW)
    return pairs.unionByName(equal.select(*keys, OLD, blank, F.lit(UNCHANGED).alias(STATUS)))


def _replaced(cfg: Scd2Config) -> set[str]:
    """Columns whose new value never comes from the increment."""
    return {cfg.from_col, cfg.to_col, cfg.active_col, *cfg.audit}


class _Versions:
    """The row structs a matched pair can turn into, all of the mart's schema."""

    def __init__(self, mart: DataFrame, increment: DataFrame, cfg: Scd2Config, as_of: Any) -> None:
        self.mart, self.cfg = mart, cfg
        self.offered = set(increment.columns) - _replaced(cfg)
        self.audit = {c: _as_type(mart, c, v, cfg) for c, v in cfg.audit.items()}
        flag = [cfg.active_col] if cfg.active_col else []
        end = _as_type(mart, cfg.to_col, as_of, cfg)
        early = F.raise_error(F.lit(f"a row to close starts after {as_of}"))
        self.ends = {cfg.to_col: F.when(self._starts_later(as_of), early).otherwise(end)}
        self.ends |= {c: F.lit(False) for c in flag}
        self.starts = {
            cfg.from_col: _as_type(mart, cfg.from_col, as_of, cfg),
            cfg.to_col: _as_type(mart, cfg.to_col, cfg.open_end, cfg),
        }
        self.starts |= {c: F.lit(True) for c in flag}

    def _starts_later(self, as_of: Any) -> Column:
        """Whether the old row starts after ``as_of``; text that is no date is let through."""
        old, limit = F.col(OLD)[self.cfg.from_col], _as_type(self.mart, self.cfg.from_col, as_of, self.cfg)
        if isinstance(self.mart.schema[self.cfg.from_col].dataType, StringType):
            form = F.lit(self.cfg.date_format)
            return F.try_to_timestamp(old, form) > F.try_to_timestamp(limit, form)
        return old > limit

    def _row(self, given: Mapping[str, Column], offered: set[str]) -> Column:
        """Given values first, then the increment's, then the old row's."""

        def value(c: str, kind: Any) -> Column:
            if c in self.cfg.keys:
                return F.col(c)
            if c in given:
                return given[c]
            return F.col(NEW)[c].cast(kind) if c in offered else F.col(OLD)[c]

        return F.struct(*(value(c.name, c.dataType).alias(c.name) for c in self.mart.schema))

    def kept(self) -> Column:
        return self._row(self.audit, set())

    def closed(self) -> Column:
        return self._row(self.audit | self.ends, set())

    def opened(self) -> Column:
        """A column the increment lacks is carried over from the old version."""
        return self._row(self.audit | self.starts, self.offered)


def _checked(mart: DataFrame, increment: DataFrame, cfg: Scd2Config) -> None:
    needed = [*cfg.keys, *cfg.tracked, cfg.from_col, cfg.to_col, *cfg.audit]
    needed += [cfg.active_col] if cfg.active_col else []
    absent = set(needed) - set(mart.columns)
    if absent:
        raise ValueError(f"mart lacks columns {sorted(absent)}")
    absent = {*cfg.keys, *cfg.tracked, *cfg.latest_by} - set(increment.columns)
    if absent:
        raise ValueError(f"increment lacks columns {sorted(absent)}")


def scd2_changes(
    mart: DataFrame,
    increment: DataFrame,
    cfg: Scd2Config,
    *,
    small_increment: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Status of every open or incoming key: unchanged, changed, new or missing.

    With ``buckets`` only keys in buckets that differ are joined; the result is the same.
    """
    _checked(mart, increment, cfg)
    pairs = _matched(mart, increment, cfg, small_increment, columns=cfg.tracked, buckets=buckets)
    return pairs.select(*cfg.keys, STATUS)


def _part(
    mart: DataFrame,
    increment: DataFrame,
    cfg: Scd2Config,
    as_of: Any,
    statuses: Sequence[str],
    version: str,
) -> DataFrame:
    _checked(mart, increment, cfg)
    pairs = _matched(mart, increment, cfg).where(F.col(STATUS).isin(statuses))
    row = getattr(_Versions(mart, increment, cfg, as_of), version)()
    return pairs.select(row.alias("row")).select("row.*")


def scd2_unchanged(mart: DataFrame, increment: DataFrame, cfg: Scd2Config, as_of: Any) -> DataFrame:
    """Open rows the increment leaves as they are."""
    return _part(mart, increment, cfg, as_of, [UNCHANGED, MISSING], "kept")


def scd2_closed(mart: DataFrame, increment: DataFrame, cfg: Scd2Config, as_of: Any) -> DataFrame:
    """Open rows the increment closes, with their new end."""
    return _part(mart, increment, cfg, as_of, [CHANGED], "closed")


def scd2_new(mart: DataFrame, increment: DataFrame, cfg: Scd2Config, as_of: Any) -> DataFrame:
    """Versions the increment opens."""
    return _part(mart, increment, cfg, as_of, [CHANGED, FRESH], "opened")


def scd2_merge(
    mart: DataFrame,
    increment: DataFrame,
    cfg: Scd2Config,
    as_of: dt.date | dt.datetime | str,
    *,
    small_increment: bool = False,
    with_history: bool = True,
    buckets: int | None = None,
) -> DataFrame:
    """The mart after the increment, in the mart's columns and types.

    ``buckets`` joins only what lies in buckets of keys whose digests differ, which suits increments that
    repeat most of the mart; the result is the same, but repeated keys are only refused in those buckets.
    ``small_increment`` avoids shuffling the mart when the increment is small
    enough for Spark to broadcast; the result is the same either way.
    ``with_history=False`` gives only the rows that took part in the join: the open
    rows after the merge and those closed by it. Old history is not among them, so never
    overwrite a mart or partitions that hold history with this result: ``scd2_land`` writes
    a merge back to its own table.
    """
    _checked(mart, increment, cfg)
    versions = _Versions(mart, increment, cfg, as_of)
    kept, closed, opened = versions.kept(), versions.closed(), versions.opened()
    rows = (
        F.when(F.col(STATUS) == CHANGED, F.array(closed, opened))
        .when(F.col(STATUS) == FRESH, F.array(opened))
        .otherwise(F.array(kept))
    )
    merged = _matched(mart, increment, cfg, small_increment, buckets=buckets).select(F.inline(rows))
    if not with_history:
        return merged
    return scd2_history(mart, cfg).unionByName(merged)


def scd2_layer(
    spark: SparkSession, increment: DataFrame, cfg: Scd2Config, as_of: Any, **options: Any
) -> DataFrame:
    """Merge into the catalog table named by a JSON configuration; lazy, writes nothing.

    Spark refuses to overwrite a table while reading it: write the result to
    another table with ``insert_table``, or merge in place with ``scd2_land``.
    """
    if not cfg.table:
        raise ValueError("the configuration names no table")
    mart = extract_table(spark, cfg.table, ["*"])
    return scd2_merge(mart, increment, cfg, as_of, **options)


def scd2_land(
    spark: SparkSession, increment: DataFrame, cfg: Scd2Config, as_of: Any, **options: Any
) -> None:
    """Merge into the configured catalog table in place, history included.

    The merged mart is landed by ``land_table``: whatever moment a job is lost at, the next call first
    finishes or forgets the landing that was begun, then merges; merging an increment
    twice changes nothing. A mart bucketed by its keys stays so, and neither the merge nor the
    landing shuffles it. One job at a time may land in a table.
    """
    if options.get("with_history") is False:
        raise ValueError("landing a merge without history would lose it")
    if not cfg.table:
        raise ValueError("the configuration names no table")
    land_table(spark, cfg.table, lambda mart: scd2_merge(mart, increment, cfg, as_of, **options))
