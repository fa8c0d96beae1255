"""How many rows break each rule, counted while the rows are written."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rowforge.operators.rules import ERRORS, validate

ACCEPTED = "accepted"


@dataclass(frozen=True)
class QualityCounts:
    """Rows seen, rows that break no rule, and rows that break each rule."""

    rows: int
    accepted: int
    broken: Mapping[str, int]

    @property
    def quarantined(self) -> int:
        return self.rows - self.accepted


def _broken(rules: Mapping[str, Column]) -> list[Column]:
    return [F.count_if(F.array_contains(ERRORS, name)) for name in rules]


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """rule and rows: how many rows break each rule, none left out; one pass, map-side counts."""
    counted = validate(df, rules).agg(*(c.alias(f"rule_{i}") for i, c in enumerate(_broken(rules))))
    each = (F.struct(F.lit(name).alias("rule"), F.col(f"rule_{i}").alias("rows")) for i, name in enumerate(rules))
    return counted.select(F.inline(F.array(*each)))


def write_validated(
    df: DataFrame, rules: Mapping[str, Column], path: str
) -> tuple[DataFrame, DataFrame, QualityCounts]:
    """Write accepted and quarantined rows below ``path`` in one action, and count both while it runs.

    Returns the accepted rows, the quarantined rows with their ``errors``, and the counts: metrics
    observed by the write itself, so the source is read once and nothing is computed
    twice. The write is one stage on top of ``df``; each row is counted by the task that writes
    it, and a task that is run again counts once.
    """
    if ACCEPTED in df.columns:
        raise ValueError(f"column {ACCEPTED} already exists")
    seen = Observation()
    checked = validate(df, rules)
    clean = F.size(ERRORS) == 0
    metrics = [c.alias(f"rule_{i}") for i, c in enumerate(_broken(rules))]
    observed = checked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(clean).alias(ACCEPTED), *metrics)
    observed.withColumn(ACCEPTED, clean).write.partitionBy(ACCEPTED).parquet(path)
    found = seen.get
    counts = QualityCounts(found["rows"], found[ACCEPTED], {name: found[f"rule_{i}"] for i, name in enumerate(rules)})
    schema = checked.schema.add(ACCEPTED, "boolean")
    written = df.sparkSession.read.schema(schema).parquet(path)
    accepted = written.where(F.col(ACCEPTED)).drop(ACCEPTED, ERRORS)
    return accepted, written.where(~F.col(ACCEPTED)).drop(ACCEPTED), counts
