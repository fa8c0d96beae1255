"""Replacing a catalog table by a result computed from it, whatever moment the job is lost at.

The result is first written to a stage table of its own, ``<table>_stage_<run>``, which is marked
complete once its rows are counted; only then is the table overwritten from the stage, and the
stage dropped. What a lost job leaves behind tells how far it came:

==========================================  =====================================================
files of a stage without a catalog entry    lost while the stage was written: the files are removed
a stage without its mark                    lost before it was checked: the stage is dropped
a marked stage                              lost before, while or after the table was overwritten:
                                            the table is overwritten from the stage (again)
==========================================  =====================================================

So the next landing first finishes or forgets the one that was begun, and a result is landed whole
or not at all. One job at a time may land in a table. Readers may see the table empty while it is overwritten.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rowforge.sinks.tables import bucketing, insert_table

MARK = "landing.rows"


def _split(spark: SparkSession, table: str) -> tuple[str, str]:
    database, _, name = table.rpartition(".")
    return database or spark.catalog.currentDatabase(), name


def _remove_folder(spark: SparkSession, path) -> None:
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _stage_name(name: str) -> re.Pattern:
    return re.compile(re.escape(name.lower()) + r"_stage_[0-9a-f]{32}")


def _stages(spark: SparkSession, table: str) -> dict[str, int | None]:
    """Stages in the catalog and the rows that each is marked with, if it is marked."""
    database, name = _split(spark, table)
    form = _stage_name(name)
    found = {}
    for entry in spark.catalog.listTables(database, f"{name}_stage_*"):
        if form.fullmatch(entry.name.lower()):
            stage = f"{database}.{entry.name}"
            marks = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {stage}").collect()}
            found[stage] = int(marks[MARK]) if MARK in marks else None
    return found


def _orphans(spark: SparkSession, table: str) -> list:
    """Folders of stages that never entered the catalog."""
    database, name = _split(spark, table)
    home = spark._jvm.org.apache.hadoop.fs.Path(spark.catalog.getDatabase(database).locationUri)
    files = home.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(home):
        return []
    known = {stage.rpartition(".")[2].lower() for stage in _stages(spark, table)}
    form = _stage_name(name)
    folders = [status.getPath() for status in files.listStatus(home) if status.isDirectory()]
    return [f for f in folders if form.fullmatch(f.getName().lower()) and f.getName().lower() not in known]


def _write_stage(df: DataFrame, table: str) -> str:
    """Write the stage, laid out like the table, and return its name."""
    spark = df.sparkSession
    database, name = _split(spark, table)
    stage = f"{database}.{name}_stage_{uuid.uuid4().hex}"
    buckets, by = bucketing(spark, table)
    insert_table(df, stage, bucket_cols=by, buckets=buckets, dealt=True)
    return stage


def _mark(spark: SparkSession, stage: str) -> None:
    spark.sql(f"ALTER TABLE {stage} SET TBLPROPERTIES ('{MARK}' = '{spark.table(stage).count()}')")


def _replace(spark: SparkSession, stage: str, table: str) -> None:
    insert_table(spark.table(stage), table, mode="overwrite", whole_table=True, dealt=True)
    spark.sql(f"DROP TABLE {stage}")


def resume_landing(spark: SparkSession, table: str) -> bool:
    """Finish or forget a landing that was begun; whether one was finished.

    Fails if a marked stage has lost rows since, or if two are marked, which takes two
    jobs landing at once: neither may be chosen blindly.
    """
    for folder in _orphans(spark, table):
        _remove_folder(spark, folder)
    stages = _stages(spark, table)
    for stage in [s for s, rows in stages.items() if rows is None]:
        spark.sql(f"DROP TABLE {stage}")
    complete = {s: rows for s, rows in stages.items() if rows is not None}
    if len(complete) > 1:
        raise RuntimeError(f"several complete stages for {table}: {sorted(complete)}")
    for stage, rows in complete.items():
        held = spark.table(stage).count()
        if held != rows:
            raise RuntimeError(f"stage {stage} holds {held} rows of {rows}")
        _replace(spark, stage, table)
    return bool(complete)


def land_table(spark: SparkSession, table: str, build: Callable[[DataFrame], DataFrame]) -> None:
    """Replace ``table`` by ``build(table)``, which may read the table it replaces."""
    resume_landing(spark, table)
    mart = spark.table(table)
    stage = _write_stage(build(mart).select(*mart.columns), table)
    _mark(spark, stage)
    _replace(spark, stage, table)
