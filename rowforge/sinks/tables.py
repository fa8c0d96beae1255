"""Inserts into catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

FORMATS = ("parquet",)
MODES = ("append", "overwrite")
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def bucketing(spark: SparkSession, table: str) -> tuple[int | None, list[str]]:
    """Number of buckets and bucket columns of a table; none if it has no buckets."""
    said = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    columns = said.get("Bucket Columns", "[]").strip("[]")
    names = [c.strip().strip("`") for c in columns.split(",") if c.strip()]
    return (int(said["Num Buckets"]), names) if names else (None, [])


def insert_table(
    df: DataFrame,
    table: str,
    *,
    mode: str = "append",
    fmt: str = "parquet",
    partition_cols: Sequence[str] = (),
    whole_table: bool = False,
    bucket_cols: Sequence[str] = (),
    buckets: int | None = None,
    dealt: bool = False,
) -> None:
    """Insert into ``table``, creating it when absent.

    Columns are matched by name. Overwriting a partitioned table replaces only
    the partitions present in ``df``, or all with ``whole_table``. Before a
    partitioned write the rows are
    rebalanced by the partition columns: each date gets few files, and the
    rows of one very large partition value are still split over many tasks.
    With ``bucket_cols`` a new table gets that many ``buckets``, each sorted by them, so that joins
    and aggregates on these columns need no exchange; an existing table keeps its own. The
    rows are dealt to the buckets first, one task for each, unless they are ``dealt``
    already, as what is read from a table of equal buckets is. Take at least as many buckets as
    ``spark.sql.shuffle.partitions``: Spark deals a side with fewer anew.

    The session's overwrite mode is set for the time of the insert: use one
    thread per session.
    """
    if not table:
        raise ValueError("table name must be specified")
    if fmt not in FORMATS:
        raise ValueError(f"unsupported output format {fmt}")
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if exists:
        known = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
        if partition_cols and list(partition_cols) != known:
            raise ValueError(f"table {table} is partitioned by {known}, not {list(partition_cols)}")
        partition_cols = known
        df = df.select(*spark.table(table).columns)
        known_buckets, known_cols = bucketing(spark, table)
        if bucket_cols and (list(bucket_cols) != known_cols or buckets not in (None, known_buckets)):
            raise ValueError(f"table {table} has {known_buckets} buckets by {known_cols}")
        buckets, bucket_cols = known_buckets, known_cols
    if bool(bucket_cols) != (buckets is not None):
        raise ValueError("bucket_cols and buckets belong together")
    if bucket_cols and not dealt:
        df = df.repartition(buckets, *bucket_cols)
    elif partition_cols and not bucket_cols:
        df = df.hint("rebalance", *partition_cols)
    writer = df.write.format(fmt).mode(mode)
    if not exists:
        if bucket_cols:
            writer = writer.bucketBy(buckets, *bucket_cols).sortBy(*bucket_cols)
        writer.partitionBy(*partition_cols).saveAsTable(table)
        return
    # An insert takes this mode from the session only, not from the writer.
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "static" if whole_table else "dynamic")
    try:
        writer.insertInto(table, overwrite=mode == "overwrite")
    finally:
        spark.conf.set(OVERWRITE_MODE, before)
