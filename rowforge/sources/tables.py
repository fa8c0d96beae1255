"""Catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession


def extract_table(
    spark: SparkSession,
    table: str,
    columns: Sequence[str | Column],
    where: str | Column | None = None,
) -> DataFrame:
    """Named columns of a catalog table, filtered; both reach the scan."""
    if not table:
        raise ValueError("table name must be specified")
    if not columns:
        raise ValueError("columns must be specified")
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist")
    rows = spark.table(table)
    if where is not None:
        rows = rows.where(where)
    return rows.select(*columns)
