"""CSV, JSON and Parquet files.

The number of files follows the partitions of the frame. ``files`` forces a
count through a shuffle; one file means one writing task, so it is for small
results only and never the default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter


def _writer(df: DataFrame, mode: str, files: int | None) -> DataFrameWriter:
    if files is not None and files < 1:
        raise ValueError("files must be at least 1")
    return (df if files is None else df.repartition(files)).write.mode(mode)


def write_csv(
    df: DataFrame, path: str, *, mode: str = "overwrite", header: bool = True, files: int | None = None
) -> None:
    _writer(df, mode, files).option("header", header).csv(path)


def write_json(df: DataFrame, path: str, *, mode: str = "overwrite", files: int | None = None) -> None:
    _writer(df, mode, files).json(path)


def write_parquet(
    df: DataFrame, path: str, *, mode: str = "overwrite", files: int | None = None
) -> None:
    _writer(df, mode, files).parquet(path)
