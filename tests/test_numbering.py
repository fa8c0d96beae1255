"""Dense row numbers and samples by hash."""

from __future__ import annotations

import hashlib
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rowforge.operators import dense_row_numbers, hash_sample


@pytest.fixture
def scores(spark):
    """A third of the rows share one score; some are exact copies; some scores are null."""
    rng = random.Random(11)
    data = [(rng.choice([5, None, *range(40)]), f"n{i}") for i in range(400)] + [(5, f"m{i}") for i in range(150)] + [(5, "copy")] * 60
    rng.shuffle(data)
    return spark.createDataFrame(data, "score int, name string").repartition(7)


def test_numbers_are_those_of_a_window_over_the_whole_table(scores):
    numbered = dense_row_numbers(scores, [F.desc("score"), "name"], "n", partitions=9)
    data = sorted((tuple(r) for r in scores.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert sorted(((r["n"], r["score"], r["name"]) for r in numbered.collect())) == [(i, *r) for i, r in enumerate(data, 1)]


def test_ties_are_numbered_without_gaps_and_spread_over_partitions(spark, scores):
    one = scores.select(F.lit(1).alias("same"), "name")
    numbered = dense_row_numbers(one, ["same"], "n", start=0, partitions=6)
    assert sorted(r["n"] for r in numbered.collect()) == list(range(one.count()))
    # copies, too, when they were read from several partitions
    copies = spark.range(0, 1000, 1, 10).select(F.lit(1).alias("same"))
    numbered = dense_row_numbers(copies, ["same"], "n", partitions=5)
    assert len(numbered.inputFiles()) > 1
    assert sorted(r["n"] for r in numbered.collect()) == list(range(1, 1001))


def test_no_rows_and_clashing_names(spark, scores):
    assert dense_row_numbers(scores.limit(0), ["score"], "n").count() == 0
    with pytest.raises(ValueError, match="already exist"):
        dense_row_numbers(scores, ["score"], "name")
    with pytest.raises(ValueError, match="order_by"):
        dense_row_numbers(scores, [], "n")


def test_only_the_counts_meet_in_one_task(scores, plan_of):
    plan = plan_of(dense_row_numbers(scores, ["score"], "n"))
    below = plan.split("Window")[1]
    assert "HashAggregate" in below.split("FileScan")[0]


def test_sample_is_the_same_for_every_partitioning(spark, scores):
    data = [tuple(r) for r in scores.collect()]
    mark = lambda r: (hashlib.md5(("s" + r[1]).encode()).hexdigest(), r[0] is not None, r[0] or 0, r[1])
    wanted = sorted(data, key=mark)[:25]
    for n in (1, 3, 20):
        assert rows(hash_sample(scores.repartition(n), "name", 25, seed="s")) == sorted(wanted, key=repr)
    per = hash_sample(scores, "name", 2, by=["score"], seed="s")
    groups = {}
    for r in sorted(data, key=mark):
        groups.setdefault(r[0], []).append(r)
    assert rows(per) == sorted((r for g in groups.values() for r in g[:2]), key=repr)
    # samples of parts make the sample of the whole
    parts = [hash_sample(scores.where(c), "name", 25, seed="s") for c in ("score > 10", "score <= 10 OR score IS NULL")]
    assert rows(hash_sample(parts[0].union(parts[1]), "name", 25, seed="s")) == sorted(wanted, key=repr)


def test_sample_leaves_rows_without_a_key_out(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    assert rows(hash_sample(df, "k", 5)) == [("a", 2)]
    with pytest.raises(ValueError, match="k must"):
        hash_sample(df, "k", 0)
