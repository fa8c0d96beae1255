"""Readers and writers, by round trip through fresh folders."""

from __future__ import annotations

import glob

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from rowforge.operators import add_constants, co_partition, partition_balance, reused
from rowforge.sinks import insert_table, write_csv, write_json, write_parquet
from rowforge.sources import (
    TextField,
    extract_table,
    parse_delimited,
    parse_json_lines,
    read_csv,
    read_json,
    read_lines,
    split_corrupt,
)


@pytest.fixture
def folder(tmp_path):
    def write(name: str, text: str) -> str:
        path = tmp_path / name
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


def test_csv_schema_modes(spark, folder):
    path = folder("cars.csv", 'id,date_of_purchase,miles\n1,2008 12 02,5.5\n2,"a, b",\n')
    fixed = read_csv(spark, path, "id int, dateOfPurchase string, miles double")
    assert fixed.columns == ["id", "dateOfPurchase", "miles"]  # bound by position
    assert rows(fixed) == [(1, "2008 12 02", 5.5), (2, "a, b", None)]
    assert dict(read_csv(spark, path, infer=True).dtypes)["miles"] == "double"
    assert {kind for _, kind in read_csv(spark, path).dtypes} == {"string"}
    assert read_csv(spark, path, header=False).columns == ["_c0", "_c1", "_c2"]


def test_csv_separator_and_multi_line(spark, folder):
    path = folder("notes.csv", 'id;note\n1;"two\nlines"\n2;one\n')
    assert rows(read_csv(spark, path, "id int, note string", sep=";", multi_line=True)) == [(1, "two\nlines"), (2, "one")]


def test_csv_blank_lines_and_filter(spark, folder):
    path = folder("stores.csv", 'state,place\nAlabama,"AL 36832, US"\nAlaska,x\n\n\n')
    stores = read_csv(spark, path, "state string, place string").where(F.col("state") == "Alabama")
    assert rows(stores) == [("Alabama", "AL 36832, US")]


def test_json_nested_and_inferred(spark, folder):
    path = folder("r.json", '{"name":"x","user_rating":{"votes":"12","text":"good"}}\n{"name":"y"}\n')
    schema = "name string, user_rating struct<votes:string,text:string>, cost int"
    nested = read_json(spark, path, schema).select("name", F.col("user_rating.votes"), "cost")
    assert rows(nested) == [("x", "12", None), ("y", None, None)]
    assert set(read_json(spark, path).columns) == {"name", "user_rating"}


def test_json_lines_with_quarantine(spark, folder):
    path = folder(
        "p.json",
        '{"uniq_id":"a","price":"1","reviews":2}\n{"uniq_id":"b"}\n{"uniq_id":"c"\nnot json\n{"uniq_id":"d","reviews":"many"}\n',
    )
    schema = StructType(
        [StructField("uniq_id", StringType()), StructField("price", StringType()), StructField("reviews", IntegerType())]
    )
    good, bad = split_corrupt(parse_json_lines(read_lines(spark, path), schema))
    assert rows(good) == sorted([("a", "1", 2), ("b", None, None)], key=repr)
    assert rows(bad.select("corrupt_record")) == sorted(
        [('{"uniq_id":"c"',), ("not json",), ('{"uniq_id":"d","reviews":"many"}',)], key=repr
    )


def test_delimited_lines(spark, folder):
    path = folder("logs.txt", "1,h,100,GET,/a,200,12\nx,h,y,GET,,404\n,h,100,GET,/a,200,12\n7\n\n,,,\n9,,5,,,,\n")
    fields = [
        TextField("id", "int", -1), TextField("host"), TextField("time", "bigint", -1), TextField("method"),
        TextField("url"), TextField("response", "int", -1), TextField("bytes", "int", -1),
    ]
    assert rows(parse_delimited(read_lines(spark, path), fields)) == sorted(
        [
            (1, "h", 100, "GET", "/a", 200, 12),
            (-1, "h", -1, "GET", "", 404, -1),
            (7, "na", -1, "na", "na", -1, -1),
            (9, "", 5, "na", "na", -1, -1),
        ],
        key=repr,
    )


def test_file_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, 'q"q')], "id int, name string")
    write_csv(df, str(tmp_path / "csv"))
    write_csv(df, str(tmp_path / "csv"), files=1)
    assert len(glob.glob(str(tmp_path / "csv" / "part-*"))) == 1
    assert rows(read_csv(spark, str(tmp_path / "csv"), "id int, name string")) == rows(df)
    write_json(df, str(tmp_path / "json"))
    assert rows(read_json(spark, str(tmp_path / "json"), "id int, name string")) == rows(df)
    write_parquet(df, str(tmp_path / "parquet"))
    assert rows(spark.read.parquet(str(tmp_path / "parquet"))) == rows(df)
    with pytest.raises(ValueError):
        write_csv(df, str(tmp_path / "csv"), files=0)


def test_wanted_number_of_files(spark, tmp_path):
    write_csv(spark.range(1000).toDF("id"), str(tmp_path / "ten"), files=10)
    assert len(glob.glob(str(tmp_path / "ten" / "part-*"))) == 10


def test_extract_table(spark):
    insert_table(spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string"), "ext_t", mode="overwrite")
    assert rows(extract_table(spark, "ext_t", ["name"], "id > 1")) == [("b",)]
    assert rows(extract_table(spark, "ext_t", [F.upper("name").alias("n")])) == [("A",), ("B",)]
    for bad in (("", ["a"]), ("ext_t", []), ("absent_t", ["a"])):
        with pytest.raises(ValueError):
            extract_table(spark, *bad)


def test_insert_matches_columns_by_name_and_replaces_partitions(spark):
    day = lambda rows_: spark.createDataFrame(rows_, "id int, dt string")
    insert_table(day([(1, "d1"), (2, "d2")]), "ins_t", mode="overwrite", partition_cols=["dt"])
    insert_table(day([(3, "d2")]).select("dt", "id"), "ins_t")
    assert rows(spark.table("ins_t").select("id", "dt")) == [(1, "d1"), (2, "d2"), (3, "d2")]
    insert_table(day([(9, "d2")]), "ins_t", mode="overwrite")
    assert rows(spark.table("ins_t").select("id", "dt")) == [(1, "d1"), (9, "d2")]
    with pytest.raises(ValueError, match="partitioned by"):
        insert_table(day([(1, "d1")]), "ins_t", partition_cols=["id"])


def test_insert_is_checked(spark):
    df = spark.createDataFrame([(1,)], "id int")
    for bad in ({"table": ""}, {"table": "t", "fmt": "orc"}, {"table": "t", "mode": "upsert"}):
        with pytest.raises(ValueError):
            insert_table(df, **bad)


def test_layout(spark, plan_of):
    df = spark.range(100).toDF("id")
    assert rows(add_constants(df.limit(1), {"a": "n", "b": 1})) == [(0, "n", 1)]
    assert sum(r["rows"] for r in partition_balance(df.repartition(6)).collect()) == 100
    left, right = co_partition(df, df.withColumn("x", F.lit(1)), ["id"], 4)
    joined = left.join(right, ["id"])
    assert joined.count() == 100 and plan_of(joined).count("hashpartitioning(id") == 2


def test_reused_releases_its_own_frame_only(spark):
    mine, other = spark.range(10).toDF("a"), spark.range(10).toDF("b").persist()
    with reused(mine) as kept:
        assert kept.is_cached and kept.count() == 10
    assert not mine.is_cached and other.is_cached
    other.unpersist()


def test_sample_is_for_sampling_and_emptiness_is_exact(spark):
    one = spark.range(1)
    assert not one.isEmpty() and one.where("id < 0").isEmpty()
    sampled = spark.range(1000).sample(fraction=0.1, seed=3)
    assert sampled.count() == spark.range(1000).sample(fraction=0.1, seed=3).count() < 1000
