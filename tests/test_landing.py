"""Landing in place: jobs lost at every point, and marts bucketed by their keys."""

from __future__ import annotations

import datetime as dt
import os
import signal
import subprocess
import sys
import uuid
from pathlib import Path

import pytest
from conftest import ROOT, rows

from rowforge.operators import Scd2Config, scd2_land, scd2_merge
from rowforge.sinks import insert_table, land_table, landing, resume_landing
from rowforge.sinks.tables import bucketing

AS_OF = dt.date(2024, 4, 26)
LAND = Scd2Config(keys=["id"], tracked=["v"], active_col="act", table="land_mart")
SCHEMA = "id int, v string, effective_from_dt date, effective_to_dt date, act boolean"
END = dt.date(9999, 12, 31)
MART = [
    (1, "old", dt.date(2020, 1, 1), dt.date(2021, 1, 1), False),
    (1, "now", dt.date(2021, 1, 1), END, True),
    (2, "gone", dt.date(2020, 1, 1), dt.date(2020, 6, 1), False),
    (3, "still", dt.date(2022, 1, 1), END, True),
]
AFTER = sorted(
    [MART[0], (1, "now", dt.date(2021, 1, 1), AS_OF, False), *MART[2:], (1, "next", AS_OF, END, True), (4, "fresh", AS_OF, END, True)], key=repr
)


def home(spark) -> Path:
    return Path(spark.catalog.getDatabase("default").locationUri.removeprefix("file:"))


def stages(spark) -> list:
    named = [t.name for t in spark.catalog.listTables() if "_stage_" in t.name]
    return sorted({*named, *(p.name for p in home(spark).glob("*_stage_*"))})


@pytest.fixture
def increment(spark):
    spark.sql("DROP TABLE IF EXISTS land_mart")
    insert_table(spark.createDataFrame(MART, SCHEMA), "land_mart", partition_cols=["act"])
    yield spark.createDataFrame([(1, "next"), (4, "fresh")], "id int, v string")
    for name in [t.name for t in spark.catalog.listTables() if "_stage_" in t.name]:
        spark.sql(f"DROP TABLE {name}")


def test_landing_keeps_history_and_may_be_repeated(spark, increment):
    for _ in range(2):
        scd2_land(spark, increment, LAND, AS_OF)
        assert rows(spark.table("land_mart")) == AFTER
        assert stages(spark) == []
    assert not resume_landing(spark, "land_mart")
    with pytest.raises(ValueError, match="history"):
        scd2_land(spark, increment, LAND, AS_OF, with_history=False)


class Lost(BaseException):
    """The job is gone: nothing after this runs."""


def lost(*_, **__):
    raise Lost


def lost_writing(df, table):
    """Part files of a stage on disk, no catalog entry."""
    folder = home(df.sparkSession) / f"land_mart_stage_{uuid.uuid4().hex}"
    df.write.parquet(str(folder))
    (folder / "_SUCCESS").unlink()
    (folder / "_temporary" / "0").mkdir(parents=True)
    raise Lost


def lost_replacing(df, table, **options):
    if table == "land_mart":
        df.sparkSession.sql("TRUNCATE TABLE land_mart")
        raise Lost
    insert_table(df, table, **options)


def lost_after_replacing(spark, stage, table):
    insert_table(spark.table(stage), table, mode="overwrite", whole_table=True)
    raise Lost


@pytest.mark.parametrize(
    ("place", "how", "finished"),
    [
        ("_write_stage", lost_writing, False),
        ("_mark", lost, False),
        ("_replace", lost, True),
        ("insert_table", lost_replacing, True),
        ("_replace", lost_after_replacing, True),
    ],
)
def test_a_landing_lost_anywhere_is_finished_or_forgotten(spark, increment, monkeypatch, place, how, finished):
    monkeypatch.setattr(landing, place, how)
    with pytest.raises(Lost):
        scd2_land(spark, increment, LAND, AS_OF)
    monkeypatch.undo()
    assert len(stages(spark)) == 1
    assert resume_landing(spark, "land_mart") is finished
    assert rows(spark.table("land_mart")) == (AFTER if finished else sorted(MART, key=repr))
    assert stages(spark) == []
    scd2_land(spark, increment, LAND, AS_OF)
    assert rows(spark.table("land_mart")) == AFTER


def test_a_stage_that_lost_rows_or_has_a_rival_is_refused(spark, increment, monkeypatch):
    monkeypatch.setattr(landing, "_replace", lost)
    with pytest.raises(Lost):
        scd2_land(spark, increment, LAND, AS_OF)
    monkeypatch.undo()
    (stage,) = stages(spark)
    rival = stage[:-32] + "0" * 32
    spark.sql(f"CREATE TABLE {rival} TBLPROPERTIES ('landing.rows' = '0') AS SELECT * FROM land_mart WHERE false")
    with pytest.raises(RuntimeError, match="several complete stages"):
        resume_landing(spark, "land_mart")
    spark.sql(f"DROP TABLE {rival}")
    spark.sql(f"TRUNCATE TABLE {stage}")
    with pytest.raises(RuntimeError, match="0 rows of 6"):
        scd2_land(spark, increment, LAND, AS_OF)
    assert rows(spark.table("land_mart")) == sorted(MART, key=repr)


KILLED = """
import sys, threading, time, os, signal, pathlib
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
from rowforge.sinks import land_table
home = pathlib.Path({home!r})
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.warehouse.dir", str(home)).getOrCreate()
spark.sql("CREATE TABLE land_mart ({schema}) USING parquet LOCATION '{mart}'")

def watch():
    while not list(home.glob("land_mart_stage_*/_temporary/**/*.parquet")):
        time.sleep(0.05)
    os.kill(os.getpid(), signal.SIGKILL)

threading.Thread(target=watch, daemon=True).start()
slow = F.expr("CASE WHEN reflect('java.lang.Thread', 'sleep', 300L) IS NULL THEN v ELSE v END")
land_table(spark, "land_mart", lambda m: spark.range(2000).repartition(400).select(F.col("id").cast("int").alias("id"), F.lit("x").alias("v"),
    F.lit(None).cast("date").alias("effective_from_dt"), F.lit(None).cast("date").alias("effective_to_dt"), F.lit(True).alias("act")).unionByName(m).withColumn("v", slow))
"""


def test_a_process_killed_while_it_writes_the_stage_leaves_nothing(spark, increment):
    """The killed process and this one share the warehouse folder; its catalog dies with it."""
    spark.sql("DROP TABLE land_mart")
    mart = home(spark).parent / f"killed-{uuid.uuid4().hex}"
    spark.createDataFrame(MART, SCHEMA).write.parquet(str(mart))
    code = KILLED.format(root=str(ROOT), home=str(home(spark)), schema=SCHEMA, mart=mart)
    ended = subprocess.run([sys.executable, "-c", code], capture_output=True, timeout=120, env=os.environ | {"PYSPARK_PYTHON": sys.executable})
    assert ended.returncode == -signal.SIGKILL, ended.stderr[-2000:]
    assert len(stages(spark)) == 1
    spark.sql(f"CREATE TABLE land_mart ({SCHEMA}) USING parquet LOCATION '{mart}'")
    scd2_land(spark, increment, LAND, AS_OF)
    assert rows(spark.table("land_mart")) == AFTER
    assert stages(spark) == []


def test_landing_any_result(spark, increment):
    land_table(spark, "land_mart", lambda mart: mart.where("id <> 2"))
    assert rows(spark.table("land_mart")) == sorted([r for r in MART if r[0] != 2], key=repr)


def test_bucketed_marts_are_merged_and_landed_without_a_shuffle_of_the_mart(spark, plan_of):
    cfg = Scd2Config(keys=["id"], tracked=["v"], active_col="act", table="bucketed_land")
    spark.sql("DROP TABLE IF EXISTS bucketed_land")
    mart = [(i, f"v{i}", dt.date(2020, 1, 1), END, True) for i in range(400)]
    insert_table(spark.createDataFrame(mart, SCHEMA), "bucketed_land", bucket_cols=["id"], buckets=16)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    expected = spark.table("bucketed_land").collect()
    try:
        for day in range(3):
            as_of = dt.date(2024, 1, 1 + day)
            increment = spark.createDataFrame([(i, f"day{day}") for i in range(100 * day, 100 * day + 50)] + [(500 + day, "new")], "id int, v string")
            expected = scd2_merge(spark.createDataFrame(expected, SCHEMA), increment, cfg, as_of).collect()
            plan = plan_of(scd2_merge(spark.table("bucketed_land"), increment, cfg, as_of))
            joined = plan.split("SortMergeJoin")[1]
            assert "Bucketed: true" in joined.split("Exchange")[0]
            # only the increment travels
            assert plan.count("Exchange") == joined.count("Exchange") <= 2
            written = []
            keep, landing.insert_table = landing.insert_table, lambda df, table, **o: (written.append(plan_of(df)), insert_table(df, table, **o))[1]
            try:
                scd2_land(spark, increment, cfg, as_of)
            finally:
                landing.insert_table = keep
            assert "Exchange" not in written[1]
            assert bucketing(spark, "bucketed_land") == (16, ["id"])
            assert rows(spark.table("bucketed_land")) == sorted((tuple(r) for r in expected), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    with pytest.raises(ValueError, match="16 buckets"):
        insert_table(spark.table("bucketed_land"), "bucketed_land", bucket_cols=["id"], buckets=7)
    with pytest.raises(ValueError, match="belong together"):
        insert_table(spark.table("bucketed_land"), "bucketed_other", bucket_cols=["id"])
