"""Null handling, patterns, casts, dates, duplicates."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rowforge.functions import age_in_years, fingerprint, month_code, month_name, parse_date, weekday_name
from rowforge.operators import (
    cast_columns,
    clean,
    dates_after,
    dedup_by_key,
    repeat_rows,
    project_filled,
    replace_pattern,
    with_average,
)


def test_clean_fills_from_the_other_column_before_its_own_default(spark):
    shoes = spark.createDataFrame(
        [
            ("a", "x", "9", "10", 5, 3, "m"),
            ("a", None, "9", "10", 5, 3, "m"),
            (None, "x", "9", "10", 5, 3, "m"),
            ("b", "y", None, "10", None, None, None),
            ("c", "z", None, None, 1, 2, "f"),
        ],
        "category string, name string, reduced string, price string, sold int, rating int, buyer string",
    )
    cleaned = clean(
        shoes,
        required=["category", "name"],
        fallback={"reduced": "price"},
        fill={"rating": 0, "sold": -1, "buyer": "unknown", "price": "n/a"},
    )
    assert rows(cleaned) == [
        ("a", "x", "9", "10", 5, 3, "m"),
        ("b", "y", "10", "10", -1, 0, "unknown"),
        ("c", "z", None, "n/a", 1, 2, "f"),
    ]


def test_project_filled(spark):
    jobs = spark.createDataFrame([("dev", None, 1), (None, "9", 2)], "title string, reviews string, other int")
    filled = project_filled(jobs, {"title": "n/a", "reviews": "0"})
    assert filled.columns == ["title", "reviews"]
    assert rows(filled) == [("dev", "0"), ("n/a", "9")]


def test_patterns_and_casts(spark):
    jobs = spark.createDataFrame(
        [("\n  Big Co\n", "1,234 reviews"), ("Tiny", "none"), ("Huge", "99999999999")], "company string, reviews string"
    )
    cleaned = jobs.transform(replace_pattern, "company", "[\\n    ]").transform(replace_pattern, "reviews", "\\D+")
    assert rows(cast_columns(cleaned, {"reviews": "int"})) == [("BigCo", 1234), ("Huge", None), ("Tiny", None)]


def test_casts_never_raise(spark):
    texts = spark.createDataFrame([(" 12 ", "1.5"), ("4.9", "x"), ("", ""), (None, None)], "i string, d string")
    assert rows(cast_columns(texts, {"i": "int", "d": "double"})) == sorted(
        [(12, 1.5), (None, None), (None, None), (None, None)], key=repr
    )


def test_date_spellings(spark):
    texts = ["2013-07-19", "2005 10 23", "2016 Aug 27", "2017-3-8", "15/04/2018", "2018-02-31", "", None]
    dates = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_date("t").alias("d"))
    assert [r["d"] for r in dates.collect()] == [
        dt.date(2013, 7, 19), dt.date(2005, 10, 23), dt.date(2016, 8, 27), dt.date(2017, 3, 8),
        None, None, None, None,
    ]
    default = dt.date(1970, 1, 1)
    filled = spark.createDataFrame([("bad",)], "t string").select(parse_date("t", default=default).alias("d"))
    assert filled.first()["d"] == default


def test_age_uses_years_of_365_days_cut_toward_zero(spark):
    as_of = dt.date(2024, 1, 1)
    days = [0, 364, 365, 729, 730, -1, -365]
    born = spark.createDataFrame([(i, as_of - dt.timedelta(days=n)) for i, n in enumerate(days)], "i int, d date")
    ages = {r["i"]: r["age"] for r in born.select("i", age_in_years("d", as_of).alias("age")).collect()}
    assert [ages[i] for i in range(len(days))] == [0, 0, 1, 1, 2, 0, -1]


def test_dates_after_is_strict_and_defaults_unreadable_text(spark):
    sales = spark.createDataFrame(
        [("2018-02-10",), ("2018-02-11",), ("2018-02-12",), ("",), (None,), ("bad",)], "d string"
    )
    assert rows(dates_after(sales, "d", dt.date(2018, 2, 11))) == [("2018-02-12",)]
    assert dates_after(sales, "d", dt.date(1899, 1, 1)).count() == 6


def test_month_codes(spark):
    dates = spark.createDataFrame([("2015-12-27",), ("2015-01-01",), ("2015",), ("",), (None,), ("2015-77-1",)], "d string")
    names = dates.select(month_code("d").alias("c")).select("c", month_name("c"))
    assert rows(names) == sorted(
        [("12", "DECEMBER"), ("01", "JANUARY"), ("00", "UNKNOWN"), ("00", "UNKNOWN"), ("00", "UNKNOWN"), ("77", "unknown")],
        key=repr,
    )


def test_weekday_does_not_depend_on_the_session_zone(spark):
    times = spark.createDataFrame([(0,), (86399,), (86400,), (-1,), (None,)], "s bigint")
    expected = ["THURSDAY", "THURSDAY", "FRIDAY", "WEDNESDAY", "na"]
    for zone in ("Asia/Tokyo", "America/Lima", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert [r[0] for r in times.select(weekday_name("s")).collect()] == expected


def test_dedup_by_key(spark):
    links = spark.createDataFrame(
        [(3, "x[k1]"), (1, "y[k1]"), (2, "z[k2]"), (4, "plain"), (5, "plain"), (6, None)], "id int, link string"
    )
    key = F.get(F.split("link", "[\\[\\]]"), F.lit(1))
    kept = dedup_by_key(links, key, ["id"], key_name="param")
    assert rows(kept) == [
        (1, "y[k1]", "k1"), (2, "z[k2]", "k2"), (4, "plain", None), (5, "plain", None), (6, None, None)
    ]
    collapsed = dedup_by_key(links, key, ["id"], keep_null_keys=False)
    assert rows(collapsed) == [(1, "y[k1]"), (2, "z[k2]"), (4, "plain")]


def test_dedup_reduces_copies_before_the_shuffle(spark, plan_of):
    copies = spark.range(1000).select(F.lit(1).alias("k"), F.col("id"))
    plan = plan_of(dedup_by_key(copies, "k", ["id"], keep_null_keys=False))
    assert "partial_min" in plan and "Window" not in plan


def test_fingerprint_tells_nulls_and_borders_apart(spark):
    pairs = spark.createDataFrame(
        [("ab", "c"), ("a", "bc"), ("a", None), (None, "a"), (None, None), ("-", None), ("", None)], "a string, b string"
    )
    for algorithm, length in (("sha1", 40), ("sha256", 64)):
        digests = [r[0] for r in pairs.select(fingerprint(["a", "b"], algorithm)).collect()]
        assert len(set(digests)) == len(digests) and {len(d) for d in digests} == {length}
    with pytest.raises(ValueError):
        fingerprint(["a"], "md5")


def test_average_counts_null_as_zero(spark):
    cars = spark.createDataFrame([(1, 10.0), (2, None), (3, 20.0)], "id int, miles double")
    assert rows(with_average(cars, "miles", "avg")) == [(1, 10.0, 10.0), (2, None, 10.0), (3, 20.0, 10.0)]


def test_dedup_reads_once_and_repeats_copies_without_a_key(spark, tmp_path, plan_of):
    data = [(1, "a", 5), (1, "a", 5), (1, "b", 2), (2, None, 1)] + [(None, "a", 1)] * 3 + [(None, None, 7), (None, "z", 0)]
    spark.createDataFrame(data, "k int, v string, n int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert plan_of(dedup_by_key(df, "k", ["n"])).count("FileScan") == 1
    assert rows(dedup_by_key(df, "k", ["n"])) == sorted([(1, "b", 2), (2, None, 1), *data[4:]], key=repr)
    assert rows(dedup_by_key(df, "k", ["n"], keep_null_keys=False)) == sorted([(1, "b", 2), (2, None, 1), (None, "z", 0)], key=repr)


def test_repeat_rows(spark):
    counted = spark.createDataFrame([("a", 3), ("b", 0), ("c", None), ("d", 150), ("e", -1)], "v string, n int")
    assert {r["v"]: r["count"] for r in repeat_rows(counted, "n", block=64).groupBy("v").count().collect()} == {"a": 3, "d": 150}
    assert repeat_rows(counted, "n").columns == ["v"]
