"""Salted, band and array-membership joins against plain and brute-force results."""

from __future__ import annotations

import itertools
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rowforge.operators import array_membership_join, band_join, band_join_avg, hot_keys, hot_values, salted_join
from rowforge.operators.joins import SALT, band_edges


@pytest.fixture
def skewed(spark):
    """Key 0 holds a third of the rows, some of them exact copies; some keys are null."""
    rng = random.Random(7)
    data = [(0, "copy")] * 100 + [(0, f"v{i}") for i in range(100)]
    data += [(rng.randint(1, 40), f"w{i}") for i in range(340)] + [(None, f"n{i}") for i in range(60)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "key int, payload string").repartition(8)


@pytest.fixture(params=["broadcast", "shuffled"])
def each_way(spark, request):
    """With Spark's own threshold for broadcasts, and without any."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold if request.param == "broadcast" else "-1")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.fixture
def dimension(spark):
    data = [(i, f"d{i}") for i in range(0, 30)] + [(0, "second"), (99, "alone"), (None, "null")]
    return spark.createDataFrame(data, "key int, name string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_share", [None, 0.2])
def test_salted_join_equals_plain_join(spark, skewed, dimension, how, hot_share):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        salted = salted_join(skewed, dimension, ["key"], how, hot_share=hot_share)
        plain = skewed.join(dimension, ["key"], how)
        assert salted.columns == plain.columns
        assert rows(salted) == rows(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_salt_splits_exact_copies_and_survives_a_rerun(skewed):
    salt = F.pmod(F.spark_partition_id(), F.lit(20))
    salted = skewed.where("payload = 'copy'").withColumn(SALT, salt)
    first = rows(salted.groupBy(SALT).count())
    assert len(first) == 8
    assert rows(salted.groupBy(SALT).count()) == first


def test_both_sides_share_one_broadcast_of_hot_keys(spark, skewed, dimension, plan_of, tmp_path):
    skewed.write.parquet(str(tmp_path / "skewed"))
    joined = salted_join(spark.read.parquet(str(tmp_path / "skewed")), dimension, ["key"], hot_share=0.2)
    joined.collect()
    reused = [line for line in plan_of(joined).splitlines() if "ReusedExchange" in line]
    assert any("hot_key" in line and "BroadcastExchange" in line for line in reused)


def test_salted_join_refuses_what_it_cannot_do(skewed, dimension):
    with pytest.raises(ValueError, match="how"):
        salted_join(skewed, dimension, ["key"], "full")
    with pytest.raises(ValueError, match="salts"):
        salted_join(skewed, dimension, ["key"], salts=0)
    with pytest.raises(ValueError, match="both sides"):
        salted_join(skewed, dimension.withColumn("payload", F.lit("x")), ["key"])


def test_hot_keys(skewed):
    assert rows(hot_keys(skewed, ["key"], 0.2)) == [(0, 200)]
    for share in (0.01, 0.05, 0.5):
        assert hot_keys(skewed, ["key"], share).count() <= 1 / share
    with pytest.raises(ValueError):
        hot_keys(skewed, ["key"], 0)


@pytest.mark.parametrize("hot_share", [None, 0.2])
def test_repeated_rows_are_never_broadcast(skewed, dimension, plan_of, hot_share):
    """Their estimate leaves the repeats out, so a side below the threshold could fill the driver."""
    salted = salted_join(skewed, dimension, ["key"], hot_share=hot_share)
    assert rows(salted) == rows(skewed.join(dimension, ["key"]))
    last = next(line for line in plan_of(salted).splitlines() if "Join" in line)
    assert "SortMergeJoin" in last and "join_salt" in last


def test_two_key_columns(spark):
    left = spark.createDataFrame([("a", "bc", 1), ("ab", "c", 2), (None, "c", 3)], "k1 string, k2 string, v int")
    right = spark.createDataFrame([("a", "bc", "x"), ("ab", "c", "y")], "k1 string, k2 string, w string")
    expected = [("a", "bc", 1, "x"), ("ab", "c", 2, "y")]
    assert rows(salted_join(left, right, ["k1", "k2"])) == expected
    assert rows(salted_join(left, right, ["k1", "k2"], hot_share=0.1)) == expected


@pytest.mark.parametrize(("width", "scale"), [(0, 1), (1, 1), (7, 1), (0.1, 0.1), (0.3, 0.1), (2.5, 0.25)])
@pytest.mark.parametrize("salts", [1, 3])
def test_band_join_equals_brute_force(spark, each_way, width, scale, salts):
    rng = random.Random(11)
    draw = lambda: rng.choice([None, rng.randint(-60, 60) * scale])
    lefts = [(i, rng.choice("ab"), draw()) for i in range(80)] + [(100, "a", None), (101, "z", 1 * scale)]
    rights = [(i, rng.choice("ab"), draw()) for i in range(80)]
    kind = "int" if scale == 1 else "double"
    left = spark.createDataFrame(lefts, f"l_id int, k string, lv {kind}")
    right = spark.createDataFrame(rights, f"r_id int, k string, rv {kind}")

    def near(a, b):
        return a[1] == b[1] and None not in (a[2], b[2]) and abs(a[2] - b[2]) <= width

    pairs = [(*a, b[0], b[2]) for a in lefts for b in rights if near(a, b)]
    joined = band_join(left, right, ["k"], "lv", "rv", width, salts=salts)
    assert rows(joined) == sorted(pairs, key=repr)
    alone = [(*a, None, None) for a in lefts if not any(near(a, b) for b in rights)]
    outer = band_join(left, right, ["k"], "lv", "rv", width, "left", salts=salts)
    assert rows(outer) == sorted(pairs + alone, key=repr)


def test_band_join_avg(spark, each_way):
    people = spark.createDataFrame(
        [("p1", "it", "rome", 3), ("p2", "it", "rome", 5), ("p3", "art", "rome", 3), ("p1", "it", "oslo", 1)],
        "id string, category string, city string, level int",
    )
    offers = spark.createDataFrame(
        [
            ("it", "rome", 2, 10.0), ("it", "rome", 2, 20.0), ("it", "rome", 4, 60.0), ("it", "rome", 9, 1.0),
            ("art", "rome", 3, None), ("it", "oslo", 1, 110.0),
        ],
        "category string, city string, offer_level int, price double",
    )
    averages = band_join_avg(
        people, offers, ["id"], ["category", "city"], "level", "offer_level", 1, "price", "avg_price"
    )
    assert rows(averages) == [("p1", 50.0), ("p2", 60.0), ("p3", None)]


def test_band_join_avg_sums_a_small_right_side_first(spark, plan_of):
    """Each left row meets a band value of its key once, however many right rows share it."""
    rng = random.Random(4)
    lefts = [(i, rng.choice(["a", "b", None]), rng.choice([None, *range(6)])) for i in range(60)]
    rights = [(rng.choice(["a", "b", None]), rng.choice([None, *range(6)]), rng.choice([None, *range(9)])) for _ in range(900)]
    left, right = spark.createDataFrame(lefts, "id int, k string, lv int"), spark.createDataFrame(rights, "k string, rv int, v int")
    averages = band_join_avg(left, right, ["id"], ["k"], "lv", "rv", 1, "v", "avg_v")
    wanted = []
    for i, k, lv in lefts:
        met = [v for q, rv, v in rights if None not in (k, lv, rv) and q == k and abs(lv - rv) <= 1]
        if met:
            known = [v for v in met if v is not None]
            wanted.append((i, sum(known) / len(known) if known else None))
    assert rows(averages) == sorted(wanted, key=repr)
    few = spark.range(900).selectExpr("id % 2 AS k", "id % 7 AS rv", "id AS v")
    small = band_join_avg(spark.range(50).selectExpr("id", "id % 2 AS k", "id % 5 AS lv"), few, ["id"], ["k"], "lv", "rv", 1, "v", "avg_v")
    plan = plan_of(small)
    assert "BroadcastHashJoin" in plan and "value_sum" in plan.split("BroadcastExchange")[0]


@pytest.mark.parametrize("each_way", ["shuffled"], indirect=True)
def test_band_cells_follow_the_data(spark, plan_of, each_way):
    """One key with most rows, bunched in a tenth of its range; the rest of the keys are cut nowhere."""
    rng = random.Random(2)
    dense = [("hot", rng.choice([rng.uniform(0, 10), rng.uniform(0, 100)])) for _ in range(3000)]
    sparse = [(f"k{i % 400}", rng.uniform(0, 100)) for i in range(1200)]
    right = spark.createDataFrame(dense + sparse, "k string, rv double")
    edges = {r["k"]: r["band_edges"] for r in band_edges(right, ["k"], "rv", 0.05).collect()}
    assert set(edges) == {"hot"} and 40 < len(edges["hot"]) <= 64
    assert all(b - a >= 0.2 for a, b in itertools.pairwise(edges["hot"]))
    assert sum(e < 10 for e in edges["hot"]) > 25
    left = spark.createDataFrame([("hot", 0.1 * i) for i in range(1000)] + [("k3", 50.0), ("none", 1.0)], "k string, lv double")
    near = band_join(left, right, ["k"], "lv", "rv", 0.05)
    assert "NestedLoop" not in plan_of(near)
    plain = left.join(right, "k").where("abs(lv - rv) <= 0.05").select("k", "lv", "rv")
    assert rows(near.select("k", "lv", "rv")) == rows(plain)


def test_band_join_of_a_small_side_is_the_plain_join(spark, plan_of):
    left = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("lv"))
    right = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("rv"))
    plan = plan_of(band_join(left, right, ["k"], "lv", "rv", 1))
    assert "band_cell" not in plan and "BroadcastHashJoin" in plan


CUSTOMERS = [(11, "Nora@mail.test", [70, 72]), (12, "ivo@mail.test", []), (13, "Lea@mail.test", [71, 99])]
ORDERS = [(70, "ladder", 2, 40.25), (71, "paint", 6, 7.5), (71, "brush", 3, 2.2), (72, "lamp", 1, 18.0), (73, "rope", 9, 1.0)]


def _sales(pairs):
    filled = pairs.na.fill({"product": "-", "quantity": 0, "price": 0.0})
    price = F.round(F.col("quantity") * F.col("price"), 2)
    return rows(filled.select(F.lower("email"), "product", price))


def test_array_membership_join(spark):
    customers = spark.createDataFrame(CUSTOMERS, "id int, email string, orders array<int>")
    orders = spark.createDataFrame(ORDERS, "order_id int, product string, quantity int, price double")
    sales = [
        ("lea@mail.test", "brush", 6.6),
        ("lea@mail.test", "paint", 45.0),
        ("nora@mail.test", "ladder", 80.5),
        ("nora@mail.test", "lamp", 18.0),
    ]
    assert _sales(array_membership_join(customers, orders, "orders", "order_id")) == sales
    outer = array_membership_join(customers, orders, "orders", "order_id", "left", left_id=["id"], salts=3)
    assert _sales(outer) == sorted([*sales, ("ivo@mail.test", "-", 0.0)])


def test_array_membership_counts_a_value_once_and_keeps_unmatched_rows_once(spark):
    left = spark.createDataFrame(
        [(1, [5, 5, 99]), (2, [98, 99]), (3, None), (4, [None, 6])], "id int, members array<int>"
    )
    right = spark.createDataFrame([(5, "five"), (6, "six"), (None, "null")], "key int, name string")
    joined = array_membership_join(left, right, "members", "key", "left", left_id=["id"])
    assert rows(joined.select("id", "name")) == [(1, "five"), (2, None), (3, None), (4, "six")]
    with pytest.raises(ValueError, match="left_id"):
        array_membership_join(left, right, "members", "key", "left")


def test_array_membership_keeps_a_matched_row_with_a_null_id_once(spark):
    left = spark.createDataFrame([(None, [5]), (2, [9])], "id int, members array<int>")
    right = spark.createDataFrame([(5, "five")], "key int, name string")
    joined = array_membership_join(left, right, "members", "key", "left", left_id=["id"])
    assert rows(joined.select("id", "name")) == [(2, None), (None, "five")]


def test_a_hot_key_gets_many_salts_within_one_partition(spark, plan_of):
    left = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("v")).coalesce(1)
    right = spark.createDataFrame([(1, "x")], "k int, name string")
    assert salted_join(left, right, ["k"]).count() == 4000
    salts = left.select(F.pmod(F.xxhash64(F.spark_partition_id(), "k", "v"), F.lit(20)).alias("s")).distinct()
    assert salts.count() == 20
    with pytest.raises(ValueError, match="hot_share"):
        salted_join(left, right, ["k"], hot_share=1e-8)


def test_array_membership_is_an_equi_join(spark, plan_of):
    left = spark.createDataFrame([(1, [1])], "id int, members array<int>")
    right = spark.createDataFrame([(1, "x")], "key int, name string")
    assert "NestedLoop" in plan_of(left.join(right, F.array_contains("members", F.col("key")), "outer"))
    for how in ("inner", "left"):
        assert "NestedLoop" not in plan_of(
            array_membership_join(left, right, "members", "key", how, left_id=["id"])
        )


def test_basic_types(spark):
    links = spark.createDataFrame([(i, f"id{i}") for i in range(10)], "key int, link string")
    values = spark.createDataFrame([(i, float(i)) for i in range(-1, 8)], "id int, value double")
    same = values["id"] == links["key"]
    counts = {how: links.join(values, same, how).count() for how in ("inner", "full", "left", "right", "left_semi")}
    assert counts == {"inner": 8, "full": 11, "left": 10, "right": 9, "left_semi": 8}


def _brute_membership(left, right, how):
    out, used = [], set()
    for identity, members in left:
        found = [(i, r) for i, r in enumerate(right) if r[0] is not None and r[0] in (members or [])]
        used |= {i for i, _ in found}
        out += [(identity, *r) for _, r in found]
        if not found and how in ("left", "full"):
            out.append((identity, None, None))
    if how in ("right", "full"):
        out += [(None, *r) for i, r in enumerate(right) if i not in used]
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_array_membership_equals_brute_force(spark, plan_of, how):
    """Repeated rows, repeated and null members, empty and null arrays, null ids and keys, a hot key."""
    rng = random.Random(5)
    left = [(i, rng.sample(range(60), rng.randint(0, 9)) + rng.choice([[], [7, 7], [None], [901]])) for i in range(150)]
    left += [(500, [7]), (501, None), (502, []), (503, [None]), (504, [900, 901]), (504, [900, 901]), (None, [7, 901])]
    right = [(k, f"r{k}") for k in range(0, 70, 2)] + [(7, "seven"), (7, "seven"), (None, "null"), (None, "null")]
    frames = spark.createDataFrame(left, "id int, members array<int>"), spark.createDataFrame(right, "key int, name string")
    joined = array_membership_join(*frames, "members", "key", how, left_id=["id"])
    assert joined.columns == ["id", "members", "key", "name"]
    assert rows(joined.select("id", "key", "name")) == _brute_membership(left, right, how)
    plan = plan_of(joined.select("id", "key", "name"))
    assert plan.count("LocalTableScan") + plan.count("Scan ExistingRDD") == 2
    if how in ("right", "full"):
        with pytest.raises(ValueError, match="salted"):
            array_membership_join(*frames, "members", "key", how, left_id=["id"], salts=2)


def test_membership_does_not_shuffle_the_array(spark, tmp_path, plan_of):
    spark.range(50).selectExpr("id", "array(id, id + 1) AS members").write.parquet(str(tmp_path / "l"))
    left = spark.read.parquet(str(tmp_path / "l"))
    right = spark.range(30).selectExpr("id AS key", "'x' AS name")
    plan = plan_of(array_membership_join(left, right, "members", "key", "full", left_id=["id"]).select("id", "name"))
    assert plan.count("FileScan") == 1
    for line in plan.splitlines():
        if "Project" in line and "member_place" in line:
            assert "members#" not in line


@pytest.mark.parametrize("share", [0.3, 0.05, 0.004])
def test_hot_keys_equal_a_full_count(spark, plan_of, share):
    """Keys on both sides of the share, many rare ones, null keys that count as rows, two key columns."""
    rng = random.Random(3)
    data = [(k, k % 3) for k in range(6000)] + [(-1, 0)] * 5000 + [(-2, 1)] * 700 + [(None, 0)] * 900
    data += [(-k, 2) for k in range(3, 60) for _ in range(10 + k)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "a int, b int").repartition(13)
    counts = {}
    for key in data:
        counts[key] = counts.get(key, 0) + 1
    wanted = sorted((*k, n) for k, n in counts.items() if k[0] is not None and n >= share * len(data))
    found = hot_keys(df, ["a", "b"], share)
    assert rows(found) == sorted(wanted, key=repr)
    # the only exchange by the key comes after the candidates were met
    assert "BroadcastHashJoin" in plan_of(found).split("hashpartitioning(a#")[1]


def test_hot_values_of_several_columns(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), (None, 1), ("y", 1)], "s string, n int")
    assert rows(hot_values(df, ["s", "n"], 0.5)) == [("n", "1", 3), ("s", "x", 2)]
    assert hot_keys(df.limit(0), ["s"], 0.5).count() == 0
    with pytest.raises(ValueError, match="min_share"):
        hot_keys(df, ["s"], 0)
