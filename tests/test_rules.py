"""Validation, code tables, units, classification."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rowforge.functions import convert_unit, decode_value, first_match, is_at_least, starts_with_any
from rowforge.operators import (
    accepted,
    decode_join,
    in_range,
    quarantined,
    required,
    strong_password,
    validate,
)


@pytest.mark.parametrize(
    ("password", "strong"),
    [
        ("90871xyzQ!", False),
        ("90871xyzQ#", True),
        ("aB3$", False),
        ("aB3$aB3$", True),
        ("aB3$" * 5, True),
        ("aB3$" * 5 + "x", False),
        ("aB3$ aB3$", False),
        ("AB3$AB3$", False),
        ("ab3$ab3$", False),
        ("aBc$aBc$", False),
        ("", False),
    ],
)
def test_strong_password(spark, password, strong):
    df = spark.createDataFrame([(password,)], "p string")
    assert df.select(strong_password("p")).first()[0] is strong


def test_validate_accepts_or_quarantines_every_row(spark):
    users = spark.createDataFrame(
        [("ann", 16), ("bob", 86), ("", 85), (None, None), ("eve", 15)], "name string, age int"
    )
    checked = validate(users, {"name": required("name"), "age": in_range("age", 16, 85)})
    assert rows(accepted(checked)) == [("ann", 16)]
    assert rows(quarantined(checked)) == sorted(
        [("bob", 86, ["age"]), ("", 85, ["name"]), (None, None, ["name", "age"]), ("eve", 15, ["age"])], key=repr
    )
    with pytest.raises(ValueError):
        validate(users, {})


def test_decode(spark):
    codes = spark.createDataFrame([("N1",), ("N2",), ("N9",), (None,)], "code string")
    decoded = codes.select(decode_value("code", {"N1": "north", "N2": "south"}, "Unknown"))
    assert [r[0] for r in decoded.collect()] == ["north", "south", "Unknown", "Unknown"]
    table = spark.createDataFrame([("N1", "north"), ("N2", "south")], "id string, country string")
    joined = decode_join(codes, "code", table, "id", "country", "Unknown")
    assert rows(joined) == sorted(
        [("N1", "north"), ("N2", "south"), ("N9", "Unknown"), (None, "Unknown")], key=repr
    )


def test_decode_refuses_a_repeated_code(spark):
    codes = spark.createDataFrame([("N1",)], "code string")
    table = spark.createDataFrame([("N1", "north"), ("N2", "a"), ("N2", "b"), (None, "c"), (None, "d")], "id string, country string")
    with pytest.raises(Exception, match="several rows for code N2"):
        decode_join(codes, "code", table, "id", "country", "?").collect()
    assert rows(decode_join(codes, "code", table.where("id <> 'N2' OR id IS NULL"), "id", "country", "?")) == [("N1", "north")]


def test_units(spark):
    lengths = spark.createDataFrame(
        [(2.0, "km"), (312.5, "m"), (180.0, "cm"), (150.0, "cm"), (1.0, "mile")], "v double, u string"
    )
    converted = lengths.select(convert_unit("v", "u", "m"), convert_unit("v", "u", "cm"), is_at_least("v", "u"))
    assert [tuple(r) for r in converted.collect()] == [
        (2000.0, 200000.0, True),
        (312.5, 31250.0, True),
        (2.0, 180.0, True),
        (2.0, 150.0, False),
        (None, None, None),
    ]
    with pytest.raises(ValueError):
        convert_unit("v", "u", "mile")


def test_first_match(spark):
    orders = spark.createDataFrame(
        [(False, True, 5, 1), (True, False, 5, 1), (True, True, 1, 5), (True, True, 5, 5), (True, None, 5, 1)],
        "stock boolean, method boolean, balance int, price int",
    )
    status = first_match(
        [
            (~F.col("stock"), "OutOfStock"),
            (~F.col("method"), "PaymentMethodMissing"),
            (F.col("balance") < F.col("price"), "InsufficientBalance"),
        ],
        "OrderPlaced",
    )
    assert [r[0] for r in orders.select(status).collect()] == [
        "OutOfStock", "PaymentMethodMissing", "InsufficientBalance", "OrderPlaced", "OrderPlaced"
    ]


def test_starts_with_any(spark):
    names = spark.createDataFrame([("BI Developer",), ("it support",), ("IT Manager",), ("Orbit",), (None,)], "p string")
    assert rows(names.where(starts_with_any("p", ["BI", "it"]))) == [("BI Developer",), ("IT Manager",), ("it support",)]
    assert names.where(starts_with_any("p", [])).count() == 0
