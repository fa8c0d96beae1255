"""Row rules: validation with quarantine, code tables held as frames."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERRORS = "errors"

# What a password must hold, tested one by one.
PASSWORD_PARTS = ("[0-9]", "[a-z]", "[A-Z]", "[@#$%^&+=]", r"^\S+$")
PASSWORD_LENGTH = (8, 20)

# Allowed ages, and the age above which a person counts as verified.
AGE_RANGE = (16, 85)
VERIFICATION_AGE = 18


def required(col: str) -> Column:
    """Neither null nor empty text."""
    return F.col(col).isNotNull() & (F.col(col).cast("string") != "")


def in_range(col: str, low: Any, high: Any) -> Column:
    return F.col(col).between(low, high)


def strong_password(col: str) -> Column:
    """Digit, lower, upper and special character, no blanks, 8 to 20 long."""
    holds = F.length(col).between(*PASSWORD_LENGTH)
    for part in PASSWORD_PARTS:
        holds = holds & F.col(col).rlike(part)
    return holds


def validate(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add array column ``errors`` with the names of the rules a row breaks.

    A rule is a condition that must hold; a null result breaks it. All rules
    are tested in one projection.
    """
    if not rules or not all(rules):
        raise ValueError("rules must be a non-empty mapping of named conditions")
    broken = [
        F.when(F.coalesce(rule, F.lit(False)), F.lit("")).otherwise(F.lit(name))
        for name, rule in rules.items()
    ]
    return df.withColumn(ERRORS, F.array_remove(F.array(*broken), ""))


def accepted(validated: DataFrame) -> DataFrame:
    """Rows that break no rule, without the ``errors`` column."""
    return validated.where(F.size(ERRORS) == 0).drop(ERRORS)


def quarantined(validated: DataFrame) -> DataFrame:
    """Rows that break a rule, with their ``errors``."""
    return validated.where(F.size(ERRORS) > 0)


def decode_join(
    df: DataFrame, col: str, labels: DataFrame, code: str, label: str, default: Any
) -> DataFrame:
    """Attach ``label`` from a code table, ``default`` where the code is unknown.

    ``labels`` must hold one row per code: a code that it repeats would double rows and fails the job,
    whether or not ``df`` holds it. No broadcast is forced: Spark picks it
    when the table's size allows, and a shuffled join otherwise.
    """
    message = F.concat(F.lit("several rows for code "), F.col("decode_code").cast("string"))
    once = F.when(F.col("decode_rows") > 1, F.raise_error(message)).otherwise(F.lit(True))
    known = labels.where(F.col(code).isNotNull()).groupBy(F.col(code).alias("decode_code"))
    table = known.agg(F.any_value(label).alias("decode_label"), F.count(F.lit(1)).alias("decode_rows"))
    joined = df.join(table.where(once).drop("decode_rows"), F.col(col) == F.col("decode_code"), "left")
    found = F.coalesce(F.col("decode_label"), F.lit(default))
    return joined.withColumn(label, found).drop("decode_code", "decode_label")
