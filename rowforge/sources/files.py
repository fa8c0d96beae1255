"""CSV, JSON and text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    *,
    header: bool = True,
    sep: str = ",",
    infer: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a fixed schema (bound by position), inferred types, or all text.

    ``multi_line`` is off because a multi-line file cannot be split: one task
    would read it whole. ``infer`` costs an extra pass; give a schema for
    large inputs.
    """
    reader = spark.read.options(header=header, sep=sep, multiLine=multi_line)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_json(
    spark: SparkSession, path: str | list[str], schema: StructType | str | None = None
) -> DataFrame:
    """One JSON object per line; with a schema, absent keys are null."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Free text, one row per line, in column ``value``."""
    return spark.read.text(path)
