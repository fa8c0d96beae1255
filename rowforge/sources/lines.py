"""Text lines parsed inside Spark: delimited fields with defaults, JSON objects."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rowforge.functions.numbers import INTEGER_TYPES, parse_integer

# Stand-ins for an unreadable field.
TEXT_DEFAULT = "na"
NUMBER_DEFAULT = -1

CORRUPT = "corrupt_record"


@dataclass(frozen=True)
class TextField:
    """A field of a delimited line: its name, type, and value when unreadable."""

    name: str
    type: str = "string"
    default: Any = TEXT_DEFAULT


def parse_delimited(
    lines: DataFrame, fields: Sequence[TextField], col: str = "value", sep: str = ","
) -> DataFrame:
    """Split each line and type its fields by position.

    A field that is missing or not readable as its type takes its default.
    Separators at the end of a line count as missing fields, and lines whose
    first field is empty are dropped.
    """
    if len(sep) != 1:
        raise ValueError("sep must be one character")
    line = F.rtrim(F.col(col), F.lit(sep))
    kept = lines.where((line != "") & ~line.startswith(sep))
    parts = kept.select(F.split(line, re.escape(sep), -1).alias("parts"))

    def typed(i: int, field: TextField) -> Column:
        text = F.get("parts", F.lit(i))
        whole = field.type in INTEGER_TYPES
        value = parse_integer(text, field.type) if whole else text.try_cast(field.type)
        return F.coalesce(value, F.lit(field.default).cast(field.type)).alias(field.name)

    return parts.select(*(typed(i, field) for i, field in enumerate(fields)))


def parse_json_lines(
    lines: DataFrame, schema: StructType, col: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Decode one JSON object per line into the fields of ``schema``.

    Absent keys give null. A line that is not JSON, or has a value of another
    type, is kept whole in ``corrupt_record``, which is null for good lines.
    """
    wanted = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    decoded = lines.select(*keep, F.from_json(F.col(col), wanted, options).alias("decoded"))
    return decoded.select(*keep, "decoded.*")


def split_corrupt(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the corrupt column, and the quarantined lines."""
    good = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, parsed.where(F.col(CORRUPT).isNotNull())
