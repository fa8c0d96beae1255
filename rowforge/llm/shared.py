"""Helpers that several operators use: written tables, small statistics, text batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    A session on ``local[...]`` may leave it unset and gets a folder of its own;
    on a cluster an unset folder is an error, as a local one would lose data.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="rowforge-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(df: DataFrame) -> None:
    """Remove a table of ``written`` that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._written_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids are in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0))


def hash_share(*cols: Column) -> Column:
    """A fixed number in [0, 1) for each row, from its hash."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 32)) / float(1 << 32)


def parts(batches, rows: int = 1024) -> Iterator:
    """Arrow batches of at most ``rows`` rows, so that the Python values made of one stay few."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def sliced(texts: list, chars: int = 1 << 20) -> Iterator[list]:
    """The texts in runs of about ``chars`` characters, so that arrays made of them stay small."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run
