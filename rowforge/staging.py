"""Intermediate results as Parquet in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER = "spark.checkpoint.dir"


def staging_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a local session without one gets a folder of its own.

    On a cluster an unset folder is an error: what one executor writes to its own disk, others cannot read.
    """
    folder = spark.conf.get(FOLDER, None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or "cluster" in master:
        raise ValueError(f"set {FOLDER} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="rowforge-staging-")
    spark.conf.set(FOLDER, folder)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written once and read back: later passes see the same rows, and lost executors cost nothing.

    The files stay until the folder is cleared; they belong to the job, not to a table.
    """
    path = f"{staging_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
