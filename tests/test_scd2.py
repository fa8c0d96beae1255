"""Type 2 merges: golden case, invariants, refusals, and a brute-force comparison."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from conftest import rows

from rowforge.operators import (
    Scd2Config,
    differing_buckets,
    scd2_changes,
    scd2_closed,
    scd2_history,
    scd2_layer,
    scd2_merge,
    scd2_new,
    scd2_unchanged,
)
from rowforge.sinks import insert_table

AS_OF = dt.date(2024, 4, 26)
TEXT = Scd2Config(
    keys=["id"], tracked=["attr", "nm_1", "nm_2"], from_col="start_date", to_col="end_date"
)
TEXT_MART = "id int, attr string, nm_1 string, nm_2 string, start_date string, end_date string"


# The date variant's known result, mart, increment and parts, must match row by row.
@pytest.fixture
def text_mart(spark):
    return spark.createDataFrame(
        [
            (1, "Hello!", "qwe", "qwe", "2020-01-01", "2021-01-31"),
            (1, "Hadoop", "qe", "qe", "2019-01-01", "9999-12-31"),
            (2, "Hadoop with Java", "e", "e", "2019-02-01", "9999-12-31"),
            (3, "old system", "we", "we", "2019-02-01", "9999-12-31"),
            (4, "Scala", "qe", "qe", "2019-02-02", "9999-12-31"),
            (6, "C", "ad", "ad", "2019-02-04", "9999-12-31"),
        ],
        TEXT_MART,
    )


@pytest.fixture
def text_increment(spark):
    return spark.createDataFrame(
        [(1, "Spark", "qwe", "qwe"), (2, "PySpark!", "e", "e"), (4, "Scala", "qe", "qe"), (5, "C++!", "er", "er")],
        "id int, attr string, nm_1 string, nm_2 string",
    )


HISTORY = [(1, "Hello!", "qwe", "qwe", "2020-01-01", "2021-01-31")]
KEPT = [
    (3, "old system", "we", "we", "2019-02-01", "9999-12-31"),
    (4, "Scala", "qe", "qe", "2019-02-02", "9999-12-31"),
    (6, "C", "ad", "ad", "2019-02-04", "9999-12-31"),
]
CLOSED = [
    (1, "Hadoop", "qe", "qe", "2019-01-01", "2024-04-26"),
    (2, "Hadoop with Java", "e", "e", "2019-02-01", "2024-04-26"),
]
OPENED = [
    (1, "Spark", "qwe", "qwe", "2024-04-26", "9999-12-31"),
    (2, "PySpark!", "e", "e", "2024-04-26", "9999-12-31"),
    (5, "C++!", "er", "er", "2024-04-26", "9999-12-31"),
]


@pytest.mark.parametrize("small", [False, True])
def test_golden_merge(text_mart, text_increment, small):
    merged = scd2_merge(text_mart, text_increment, TEXT, AS_OF, small_increment=small)
    assert merged.schema == text_mart.schema
    assert rows(merged) == sorted(HISTORY + KEPT + CLOSED + OPENED, key=repr)


def test_golden_parts(text_mart, text_increment):
    assert rows(scd2_history(text_mart, TEXT)) == HISTORY
    assert rows(scd2_unchanged(text_mart, text_increment, TEXT, AS_OF)) == KEPT
    assert rows(scd2_closed(text_mart, text_increment, TEXT, AS_OF)) == CLOSED
    assert rows(scd2_new(text_mart, text_increment, TEXT, AS_OF)) == OPENED
    changes = rows(scd2_changes(text_mart, text_increment, TEXT))
    assert changes == [(1, "changed"), (2, "changed"), (3, "missing"), (4, "unchanged"), (5, "new"), (6, "missing")]


def test_without_history(text_mart, text_increment):
    merged = scd2_merge(text_mart, text_increment, TEXT, AS_OF, with_history=False)
    assert rows(merged) == sorted(KEPT + CLOSED + OPENED, key=repr)


def test_second_run_changes_nothing_and_keeps_rows_closed_today(spark, text_mart, text_increment):
    once = scd2_merge(text_mart, text_increment, TEXT, AS_OF)
    twice = scd2_merge(once, text_increment, TEXT, AS_OF)
    assert rows(twice) == rows(once)


FLAG = Scd2Config(
    keys=["customer_id"],
    tracked=["client_type", "email", "address"],
    active_col="is_active",
    open_end="5999-12-31 00:00:00",
)


def test_flag_variant(spark):
    """Two history rows of one key, a key the increment lacks, a null turned into a value, and a value into a null."""
    at, end, now = dt.datetime, dt.datetime(5999, 12, 31), dt.datetime(2024, 5, 1, 10, 30)
    history = [
        ("b", "trial", None, "north", at(2019, 1, 1), at(2019, 4, 1), False),
        ("b", "paid", "b@x.test", "north", at(2019, 4, 1), at(2021, 1, 1), False),
    ]
    untouched = [
        ("a", "paid", "a@x.test", "west", at(2023, 3, 3), end, True),
        ("e", None, None, "south", at(2020, 2, 29), end, True),
    ]
    filled = ("c", "paid", None, "east", at(2022, 8, 8), end, True)
    emptied = ("d", "trial", "d@x.test", "east", at(2022, 9, 9, 9), end, True)
    mart = spark.createDataFrame(
        [untouched[0], emptied, history[1], filled, untouched[1], history[0]],
        "customer_id string, client_type string, email string, address string, "
        "effective_from_dt timestamp, effective_to_dt timestamp, is_active boolean",
    )
    increment = spark.createDataFrame(
        [("e", None, None, "south"), ("d", "trial", None, "east"), ("b", "paid", "b@x.test", "north"), ("c", "paid", "c@x.test", "east"), ("f", None, "f@x.test", None)],
        "customer_id string, client_type string, email string, address string",
    )
    closed = [(*row[:5], now, False) for row in (filled, emptied)]
    opened = [
        ("b", "paid", "b@x.test", "north", now, end, True),
        ("c", "paid", "c@x.test", "east", now, end, True),
        ("d", "trial", None, "east", now, end, True),
        ("f", None, "f@x.test", None, now, end, True),
    ]
    merged = rows(scd2_merge(mart, increment, FLAG, now))
    assert merged == sorted([*history, *untouched, *closed, *opened], key=repr)


def test_audit_columns_are_typed_and_spare_history(spark):
    cfg = Scd2Config(
        keys=["mdm_id"],
        tracked=["package"],
        audit={"load_dttm": dt.datetime(2024, 4, 26, 12), "load_dt": dt.date(2024, 4, 26)},
    )
    d = dt.date
    old = (dt.datetime(2024, 4, 25, 12), d(2024, 3, 25))
    stamp = (dt.datetime(2024, 4, 26, 12), d(2024, 4, 26))
    mart = spark.createDataFrame(
        [
            ("1", "mass", 7, d(2024, 4, 21), d(2024, 4, 23), *old),
            ("3", "mass", 8, d(2024, 4, 25), d(9999, 12, 31), *old),
            ("6", "mass", 9, d(2024, 4, 25), d(9999, 12, 31), *old),
            ("7", "mass", 5, d(2024, 4, 25), d(9999, 12, 31), *old),
        ],
        "mdm_id string, package string, note int, effective_from_dt date, effective_to_dt date, "
        "load_dttm timestamp, load_dt date",
    )
    increment = spark.createDataFrame(
        [("1", "vip", 17), ("3", "mass", 18), ("6", "vip", 19)], "mdm_id string, package string, note int"
    )
    open_end = d(9999, 12, 31)
    assert rows(scd2_merge(mart, increment, cfg, AS_OF)) == sorted(
        [
            ("1", "mass", 7, d(2024, 4, 21), d(2024, 4, 23), *old),
            ("1", "vip", 17, AS_OF, open_end, *stamp),
            ("3", "mass", 8, d(2024, 4, 25), open_end, *stamp),
            ("6", "mass", 9, d(2024, 4, 25), AS_OF, *stamp),
            ("6", "vip", 19, AS_OF, open_end, *stamp),
            ("7", "mass", 5, d(2024, 4, 25), open_end, *stamp),
        ],
        key=repr,
    )


def test_column_missing_from_the_increment_is_carried_over(spark, text_mart):
    cfg = Scd2Config(keys=["id"], tracked=["attr"], from_col="start_date", to_col="end_date")
    increment = spark.createDataFrame([(1, "Spark"), (9, "Zig")], "id int, attr string")
    opened = rows(scd2_new(text_mart, increment, cfg, AS_OF))
    assert opened == [
        (1, "Spark", "qe", "qe", "2024-04-26", "9999-12-31"),
        (9, "Zig", None, None, "2024-04-26", "9999-12-31"),
    ]


def test_nulls_and_field_borders_are_told_apart(spark):
    cfg = Scd2Config(keys=["id"], tracked=["a", "b"])
    schema = "id int, a string, b string, effective_from_dt date, effective_to_dt date"
    end, start = dt.date(9999, 12, 31), dt.date(2020, 1, 1)
    old = [(1, "ab", "c"), (2, "x", None), (3, None, None), (4, None, "y")]
    mart = spark.createDataFrame([(*r, start, end) for r in old], schema)
    new = [(1, "a", "bc"), (2, None, "x"), (3, None, None), (4, "y", None)]
    increment = spark.createDataFrame(new, "id int, a string, b string")
    assert rows(scd2_changes(mart, increment, cfg)) == [
        (1, "changed"), (2, "changed"), (3, "unchanged"), (4, "changed")
    ]


@pytest.mark.parametrize("small", [False, True])
def test_several_increment_rows_per_key_are_refused(text_mart, text_increment, small):
    twice = text_increment.union(text_increment)
    with pytest.raises(Exception, match="several increment rows for key"):
        scd2_merge(text_mart, twice, TEXT, AS_OF, small_increment=small).collect()


@pytest.mark.parametrize("small", [False, True])
def test_increment_row_without_a_key_is_refused(spark, text_mart, text_increment, small):
    keyless = text_increment.union(spark.createDataFrame([(None, "x", "y", "z")], text_increment.schema))
    with pytest.raises(Exception, match="without a key"):
        scd2_merge(text_mart, keyless, TEXT, AS_OF, small_increment=small).collect()


def test_latest_by_picks_the_increment_row(spark, text_mart):
    cfg = Scd2Config(
        keys=["id"], tracked=["attr"], from_col="start_date", to_col="end_date", latest_by=["seq"]
    )
    increment = spark.createDataFrame(
        [(1, "first", 1), (1, "last", 3), (1, "middle", 2), *[(1, "copy", 0)] * 50],
        "id int, attr string, seq int",
    )
    assert [r[1] for r in rows(scd2_new(text_mart, increment, cfg, AS_OF))] == ["last"]


def test_configuration_is_checked():
    with pytest.raises(ValueError, match="keys"):
        Scd2Config(keys=[], tracked=["a"])
    with pytest.raises(ValueError, match="tracked"):
        Scd2Config(keys=["a"], tracked=[])
    with pytest.raises(ValueError, match="cannot be tracked"):
        Scd2Config(keys=["a"], tracked=["a"])


def test_missing_columns_are_named(spark, text_mart, text_increment):
    with pytest.raises(ValueError, match="increment lacks columns \\['nm_2'\\]"):
        scd2_merge(text_mart, text_increment.drop("nm_2"), TEXT, AS_OF)
    with pytest.raises(ValueError, match="mart lacks columns \\['end_date'\\]"):
        scd2_merge(text_mart.drop("end_date"), text_increment, TEXT, AS_OF)


def test_configured_merge_of_a_catalog_table(spark, tmp_path, text_mart, text_increment):
    spec = {
        "database": "default",
        "table": "scd2_mart",
        "join_cols": ["id"],
        "sensitive_cols": ["id", "attr", "nm_1", "nm_2"],
        "insensitive_cols": ["start_date"],
        "effective_from_col_name": "start_date",
        "effective_to_col_name": "end_date",
        "date_format": "yyyy-MM-dd",
    }
    path = tmp_path / "job.json"
    path.write_text(json.dumps(spec))
    cfg = Scd2Config.from_json(str(path))
    assert (cfg.keys, cfg.tracked) == (["id"], ["attr", "nm_1", "nm_2"])
    insert_table(text_mart, "scd2_mart", mode="overwrite")
    merged = scd2_layer(spark, text_increment, cfg, AS_OF)
    insert_table(merged, "scd2_mart_next", mode="overwrite")
    assert rows(spark.table("scd2_mart_next")) == sorted(HISTORY + KEPT + CLOSED + OPENED, key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_several_open_rows_per_key_are_refused(text_mart, text_increment, small):
    twice = text_mart.union(text_mart)
    with pytest.raises(Exception, match="several open mart rows for key"):
        scd2_merge(twice, text_increment, TEXT, AS_OF, small_increment=small).collect()


def test_closing_before_the_start_is_refused(spark, text_mart, text_increment):
    with pytest.raises(Exception, match="starts after"):
        scd2_merge(text_mart, text_increment, TEXT, dt.date(2018, 1, 1)).collect()
    cfg = Scd2Config(keys=["id"], tracked=["v"], active_col="act")
    schema = "id int, v string, effective_from_dt date, effective_to_dt date, act boolean"
    mart = spark.createDataFrame([(1, "a", AS_OF, dt.date(9999, 12, 31), True)], schema)
    increment = spark.createDataFrame([(1, "b")], "id int, v string")
    assert len(scd2_merge(mart, increment, cfg, AS_OF).collect()) == 2
    with pytest.raises(Exception, match="starts after"):
        scd2_merge(mart, increment, cfg, AS_OF - dt.timedelta(1)).collect()


def _brute_force(mart, increment, as_of, end):
    """The rules applied row by row, independently of Spark."""
    out, current = [], {}
    for row in mart:
        if row[-1] == end:
            current[row[:2]] = row
        else:
            out.append(row)
    incoming = {row[:2]: row for row in increment}
    for key in current.keys() | incoming.keys():
        old, new = current.get(key), incoming.get(key)
        if old is not None and (new is None or new[2:] == old[2:4]):
            out.append(old)
            continue
        if old is not None:
            out.append((*old[:5], as_of))
        out.append((*new, as_of, end))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_marts_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    end = dt.date(9999, 12, 31)
    value = lambda: rng.choice(["a", "b", None])
    keys = [(i, c) for i in range(40) for c in "xy"]
    mart, increment = [], []
    for key in keys:
        for _ in range(rng.randrange(3)):
            mart.append((*key, value(), value(), dt.date(2020, 1, 1), dt.date(2021, 1, rng.randint(1, 28))))
        if rng.random() < 0.7:
            mart.append((*key, value(), value(), dt.date(2022, 1, 1), end))
        if rng.random() < 0.7:
            increment.append((*key, value(), value()))
    cfg = Scd2Config(keys=["k1", "k2"], tracked=["a", "b"])
    schema = "k1 int, k2 string, a string, b string"
    mart_df = spark.createDataFrame(mart, f"{schema}, effective_from_dt date, effective_to_dt date")
    increment_df = spark.createDataFrame(increment, schema)
    expected = _brute_force(mart, increment, AS_OF, end)
    for small in (False, True):
        merged = rows(scd2_merge(mart_df, increment_df, cfg, AS_OF, small_increment=small))
        assert merged == expected
        assert {r[:2] for r in merged} == {r[:2] for r in mart} | {r[:2] for r in increment}
        open_keys = [r[:2] for r in merged if r[-1] == end]
        assert len(open_keys) == len(set(open_keys))


def test_history_is_not_shuffled_and_there_is_one_join(spark, plan_of, text_mart, text_increment):
    plan = plan_of(scd2_merge(text_mart, text_increment, TEXT, AS_OF))
    assert plan.count("SortMergeJoin") == 1
    assert plan.count("Exchange") == 2


def test_small_increment_leaves_the_mart_unshuffled(spark, plan_of, tmp_path, text_mart, text_increment):
    text_mart.write.parquet(str(tmp_path / "mart"))
    text_increment.write.parquet(str(tmp_path / "increment"))
    mart = spark.read.parquet(str(tmp_path / "mart"))
    increment = spark.read.parquet(str(tmp_path / "increment"))
    merged = scd2_merge(mart, increment, TEXT, AS_OF, small_increment=True)
    plan = plan_of(merged)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3
    # Only the increment is exchanged by key.
    assert all("end_date" not in line for line in plan.splitlines() if "hashpartitioning" in line)
    assert rows(merged) == sorted(HISTORY + KEPT + CLOSED + OPENED, key=repr)


def test_bucketed_mart_is_joined_where_it_lies(spark, plan_of, text_mart, text_increment):
    text_mart.write.mode("overwrite").bucketBy(16, "id").sortBy("id").saveAsTable("bucketed_mart")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        merged = scd2_merge(spark.table("bucketed_mart"), text_increment, TEXT, AS_OF)
        # The mart's scan comes first below the join, with no exchange above it.
        above, below = plan_of(merged).split("SortMergeJoin")
        assert "Bucketed: true" in below.split("Exchange")[0]
        assert rows(merged) == sorted(HISTORY + KEPT + CLOSED + OPENED, key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_text_ends_may_carry_a_time_and_null_ends_are_history(spark):
    cfg = Scd2Config(keys=["id"], tracked=["a"], from_col="b_dt", to_col="e_dt")
    mart = spark.createDataFrame(
        [(1, "x", "2020-01-01", "9999-12-31 00:00:00"), (2, "y", "2020-01-01", None)],
        "id int, a string, b_dt string, e_dt string",
    )
    increment = spark.createDataFrame([(1, "x")], "id int, a string")
    assert rows(scd2_changes(mart, increment, cfg)) == [(1, "unchanged")]
    assert rows(scd2_merge(mart, increment, cfg, AS_OF)) == rows(mart)


def test_increment_columns_the_mart_does_not_know_are_not_shuffled(text_mart, text_increment, plan_of):
    from pyspark.sql import functions as F

    wide = text_increment.withColumn("noise", F.uuid())
    assert "noise" not in plan_of(scd2_merge(text_mart, wide, TEXT, AS_OF))


def _snapshot(spark, changed: int):
    rng = random.Random(8)
    value = lambda: rng.choice([None, "", "a", "b", "1"])
    open_rows = [(k, value(), value()) for k in range(4000)]
    mart = spark.createDataFrame([(*r, "2020-01-01", "9999-12-31") for r in open_rows], "id int, a string, b string, start_date string, end_date string")
    moved = {k: (k, f"new{k}", None) for k in rng.sample(range(4000), changed)}
    increment = [moved.get(k, (k, a, b)) for k, a, b in open_rows if k % 1000 != 3] + [(9001, None, "n")]
    rng.shuffle(increment)
    return mart, spark.createDataFrame(increment, "id int, a string, b string")


DIGESTS = Scd2Config(keys=["id"], tracked=["a", "b"], from_col="start_date", to_col="end_date")


@pytest.mark.parametrize("buckets", [1, 50, 5000])
@pytest.mark.parametrize("changed", [0, 40, 2000])
def test_digests_change_no_result(spark, changed, buckets):
    mart, increment = _snapshot(spark, changed)
    plain = rows(scd2_changes(mart, increment, DIGESTS))
    assert rows(scd2_changes(mart, increment, DIGESTS, buckets=buckets)) == plain
    assert rows(scd2_merge(mart, increment, DIGESTS, AS_OF, buckets=buckets)) == rows(scd2_merge(mart, increment, DIGESTS, AS_OF))


def test_equal_buckets_are_not_joined(spark, plan_of):
    mart, increment = _snapshot(spark, 40)
    differ = differing_buckets(mart, increment, ["id"], ["a", "b"], 2000)
    assert 30 <= differ.count() <= 45  # 40 changed, 4 missing, 1 new, of 2000
    nulls = spark.createDataFrame([(1, None, "x")], "id int, a string, b string")
    assert differing_buckets(nulls, spark.createDataFrame([(1, "x", None)], nulls.schema), ["id"], ["a", "b"], 7).count() == 1
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(scd2_changes(mart, increment, DIGESTS, buckets=2000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # the mart passes the buckets that differ before anything of it is shuffled by key
    assert "LeftSemi" in plan.split("hashpartitioning(id#")[1].split("Exchange")[0]
    with pytest.raises(ValueError, match="buckets"):
        differing_buckets(mart, increment, ["id"], ["a"], 0)
    broken = increment.unionByName(spark.createDataFrame([(None, "a", "b")], increment.schema))
    with pytest.raises(Exception, match="without a key"):
        scd2_changes(mart, broken, DIGESTS, buckets=50).collect()
