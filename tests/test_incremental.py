"""Missing periods and load batches."""

from __future__ import annotations

import datetime as dt

from conftest import rows

from rowforge.operators import flag_load_batches, late_rows, latest_values, missing_periods

D = dt.date


def _source(spark):
    days = [D(2024, m, d) for m in range(1, 9) for d in (1, 15, 28)] + [None]
    return spark.createDataFrame([(i, day) for i, day in enumerate(days)], "id int, send_dt date")


def test_latest_values(spark):
    values = spark.createDataFrame([(v,) for v in (3, 1, 3, None, 2, 5)], "v int")
    assert [r[0] for r in latest_values(values, "v", 2).collect()] == [5, 3]


def test_missing_periods(spark):
    target = spark.createDataFrame(
        [(D(2024, 5, 31),), (D(2024, 7, 31),), (D(2024, 7, 31),), (D(2024, 1, 31),), (None,)], "report_dt date"
    )
    wanted = missing_periods(_source(spark), target, "send_dt", "report_dt")
    # The six latest months are March to August; May and July are reported.
    assert {r["send_dt"].month for r in wanted.collect()} == {3, 4, 6, 8}
    assert wanted.count() == 12


def test_dates_held_as_text(spark):
    texts = ["2024-07-15", " 2024-8-5", "2024-06-31", None, "2024-08-28"]
    source = spark.createDataFrame([(t,) for t in texts], "send_dt string")
    target = spark.createDataFrame([("2024-07-31",), ("bad",)], "report_dt string")
    wanted = missing_periods(source, target, "send_dt", "report_dt")
    assert rows(wanted) == [(" 2024-8-5",), ("2024-08-28",)]


def test_nothing_missing(spark):
    target = spark.createDataFrame([(D(2024, m, 1),) for m in range(1, 9)], "day date").selectExpr(
        "last_day(day) AS report_dt"
    )
    assert missing_periods(_source(spark), target, "send_dt", "report_dt").count() == 0


def test_empty_target_wants_everything_and_one_row_does_not_look_empty(spark):
    empty = spark.createDataFrame([], "report_dt date")
    assert missing_periods(_source(spark), empty, "send_dt", "report_dt").count() == 25
    one = spark.createDataFrame([(D(2024, 8, 31),)], "report_dt date")
    for _ in range(3):
        assert missing_periods(_source(spark), one, "send_dt", "report_dt").count() == 15


def test_missing_periods_bound_the_scan(spark, tmp_path, plan_of):
    _source(spark).write.parquet(str(tmp_path / "source"))
    source = spark.read.parquet(str(tmp_path / "source"))
    target = spark.createDataFrame([(D(2024, 8, 31),)], "report_dt date")
    plan = plan_of(missing_periods(source, target, "send_dt", "report_dt"))
    assert "GreaterThanOrEqual(send_dt,ScalarSubquery" in plan
    assert "BroadcastHashJoin" in plan


def _loads(spark):
    texts = [
        ("2024-06-30", "a", "2024-07-02 08:00:00"),
        ("2024-07-31", "b", "2024-07-02 09:30:00"),
        ("2024-07-31", "c", "2024-07-15 10:00:00"),
        ("2024-07-31", "d", "2024-07-15 11:45:00"),
        ("2024-06-30", "e", "2024-06-31 12:10:00"),
        ("2024-06-30", "f", "2024-06-31 13:20:00"),
        ("2024-06-30", "g", "2024-06-28 14:05:00"),
        ("2024-07-31", "h", "2024-07-08 15:50:00"),
        ("2024-05-31", "i", "2024-07-08 15:50:00"),
    ]
    loads = spark.createDataFrame(texts, "report_dt string, who string, loaded string")
    return loads.withColumnRenamed("loaded", "load_day")


def test_load_batches(spark):
    flagged = flag_load_batches(_loads(spark), "load_day", "report_dt", D(2024, 7, 20))
    flags = {r["who"]: r["flag"] for r in flagged.collect()}
    assert flags == {"a": 1, "b": 1, "c": 0, "d": 0, "e": 1, "f": 1, "g": 1, "h": 1, "i": 1}


def test_rows_without_a_load_day_are_one_batch(spark):
    loads = spark.createDataFrame([(None, D(2024, 7, 31)), (None, D(2024, 7, 31))], "load_day date, report_dt date")
    flagged = flag_load_batches(loads, "load_day", "report_dt", D(2024, 7, 20))
    assert rows(flagged.select("flag")) == [(0,), (0,)]


def test_late_rows(spark):
    late = late_rows(_loads(spark), "load_day", "report_dt", D(2024, 7, 20))
    assert sorted(r["who"] for r in late.collect()) == ["a", "e", "f", "g"]
