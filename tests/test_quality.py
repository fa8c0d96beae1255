"""Rule counts observed by a write, and distinct counts from merged sketches."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rowforge.operators import (
    distinct_estimates,
    distinct_sketches,
    keys_with_distinct,
    quarantined,
    rule_counts,
    validate,
    write_validated,
)

@pytest.fixture
def rules(spark):
    return {"positive": F.col("v") > 0, "short": F.length("name") < 4, "never broken": F.lit(True)}


@pytest.fixture
def people(spark):
    data = [(1, "ab"), (-1, "abcdef"), (None, "x"), (5, None), (7, "abcd"), (7, "abcd"), (2, "ok")]
    return spark.createDataFrame(data, "v int, name string").repartition(3)


def test_counts_are_those_of_a_second_pass(people, rules, tmp_path):
    accepted, bad, counts = write_validated(people, rules, str(tmp_path / "out"))
    assert rows(accepted) == [(1, "ab"), (2, "ok")]
    assert rows(bad) == rows(quarantined(validate(people, rules)))
    assert (counts.rows, counts.accepted, counts.quarantined) == (7, 2, 5)
    assert counts.broken == {r["rule"]: r["rows"] for r in rule_counts(people, rules).collect()}
    assert counts.broken == {"positive": 2, "short": 4, "never broken": 0}


def test_the_source_is_read_once(spark, people, rules, tmp_path):
    """The write and its counts are one job over the source: each row passes an accumulator once."""
    passed = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(v):
        passed.add(1)
        return v

    watched = people.withColumn("v", seen.asNondeterministic()("v"))
    _, _, counts = write_validated(watched, rules, str(tmp_path / "out"))
    assert passed.value == counts.rows == 7


def test_nothing_to_write_and_clashing_names(people, rules, tmp_path):
    accepted, bad, counts = write_validated(people.limit(0), rules, str(tmp_path / "none"))
    assert (accepted.count(), bad.count(), counts.rows, counts.broken["short"]) == (0, 0, 0, 0)
    with pytest.raises(ValueError, match="accepted"):
        write_validated(people.withColumn("accepted", F.lit(1)), rules, str(tmp_path / "clash"))


@pytest.fixture
def visits(spark):
    rng = random.Random(4)
    day = dt.date(2024, 1, 1)
    data = [(k, day + dt.timedelta(rng.randrange(30)), rng.choice([None, *range(10 + 40 * k)])) for k in range(30) for _ in range(100 + 60 * k)]
    data += [(None, day, u) for u in range(500)]
    return spark.createDataFrame(data, "site int, day date, user int").repartition(6)


def test_merged_sketches_count_a_value_once(visits):
    stored = distinct_sketches(visits, ["site"], "day", "user")
    within = F.col("day") < F.lit("2024-01-15").cast("date")
    exact = {r["site"]: r["n"] for r in visits.where(within).groupBy("site").agg(F.countDistinct("user").alias("n")).collect()}
    found = {r["site"]: r["estimate"] for r in distinct_estimates(stored, ["site"], within).collect()}
    assert found.keys() == exact.keys()
    assert all(abs(found[k] - n) <= 0.1 * n + 1 for k, n in exact.items())


@pytest.mark.parametrize("at_least", [1, 100, 333, 480, 10_000])
@pytest.mark.parametrize("margin", [0.1, 0.6])
def test_threshold_is_exact(visits, at_least, margin):
    exact = visits.groupBy("site").agg(F.countDistinct("user").alias("n")).where(F.col("n") >= at_least).select("site")
    stored = distinct_sketches(visits, ["site"], "day", "user", lg_k=8 if margin > 0.5 else 12)
    assert rows(keys_with_distinct(stored, visits, ["site"], "user", at_least, margin=margin)) == rows(exact)
    with pytest.raises(ValueError, match="at_least"):
        keys_with_distinct(stored, visits, ["site"], "user", 0)
