"""Row rules: validation, code tables, units, ordered classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowforge.functions import convert_unit, decode_value, first_match, is_at_least
from rowforge.operators import (
    accepted,
    decode_join,
    in_range,
    quarantined,
    required,
    rule_counts,
    strong_password,
    validate,
)
from rowforge.operators.rules import AGE_RANGE, VERIFICATION_AGE
from rowforge.plans.registry import Table, query

_USERS_SQL = """
    SELECT c_custkey, nullif(c_mktsegment, 'FURNITURE') AS name, c_nationkey + 10 AS age,
           c_mktsegment || CASE WHEN c_acctbal < 0 THEN ' ' ELSE '#' END
             || lower(c_mktsegment) || c_nationkey::VARCHAR AS password
    FROM customer
"""
_CHECKED_SQL = rf"""
    SELECT c_custkey, name, age, password,
           concat_ws(',',
             CASE WHEN coalesce(name, '') = '' THEN 'name' END,
             CASE WHEN age NOT BETWEEN 16 AND 85 THEN 'age' END,
             CASE WHEN NOT (length(password) BETWEEN 8 AND 20
                            AND regexp_matches(password, '[0-9]') AND regexp_matches(password, '[a-z]')
                            AND regexp_matches(password, '[A-Z]')
                            AND regexp_matches(password, '[@#$%^&+=]')
                            AND regexp_matches(password, '^\S+$')) THEN 'password' END) AS errors
    FROM ({_USERS_SQL})
"""


def _users(t: Table) -> DataFrame:
    segment = F.col("c_mktsegment")
    return t("customer").select(
        "c_custkey",
        F.nullif(segment, F.lit("FURNITURE")).alias("name"),
        (F.col("c_nationkey") + 10).alias("age"),
        F.concat(
            segment,
            F.when(F.col("c_acctbal") < 0, " ").otherwise("#"),
            F.lower(segment),
            F.col("c_nationkey").cast("string"),
        ).alias("password"),
    )


def _user_rules() -> dict[str, Column]:
    return {
        "name": required("name"),
        "age": in_range("age", *AGE_RANGE),
        "password": strong_password("password"),
    }


def _checked_users(t: Table) -> DataFrame:
    return validate(_users(t), _user_rules())


@query(
    f"""
    SELECT rule, count(*) FILTER (list_contains(string_split(errors, ','), rule)) AS rows
    FROM ({_CHECKED_SQL}), (SELECT unnest(['name', 'age', 'password']) AS rule) GROUP BY rule
    """,
    name="rule_counts",
)
def user_rule_counts(t: Table) -> DataFrame:
    return rule_counts(_users(t), _user_rules())


@query(f"SELECT c_custkey, errors FROM ({_CHECKED_SQL})")
def validate_rows(t: Table) -> DataFrame:
    return _checked_users(t).select("c_custkey", F.concat_ws(",", "errors").alias("errors"))


@query(
    f"""
    SELECT c_custkey, name, age, password,
           CASE WHEN age > 18 THEN 'Verified' ELSE 'Unverified' END AS status
    FROM ({_CHECKED_SQL}) WHERE errors = ''
    """
)
def accepted_rows(t: Table) -> DataFrame:
    status = F.when(F.col("age") > VERIFICATION_AGE, "Verified").otherwise("Unverified")
    return accepted(_checked_users(t)).withColumn("status", status)


@query(f"SELECT c_custkey, name, age, password, errors FROM ({_CHECKED_SQL}) WHERE errors <> ''")
def quarantined_rows(t: Table) -> DataFrame:
    return quarantined(_checked_users(t)).withColumn("errors", F.concat_ws(",", "errors"))


@query(
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open'
                       ELSE 'Unknown' END AS status
    FROM orders
    """
)
def decode_labels(t: Table) -> DataFrame:
    status = decode_value("o_orderstatus", {"F": "Finished", "O": "Open"}, "Unknown")
    return t("orders").select("o_orderkey", status.alias("status"))


@query(
    """
    SELECT e.event_id, e.user_id, coalesce(c.c_name, 'Unknown') AS c_name
    FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
    """,
    name="decode_by_table",
)
def decode_users(t: Table) -> DataFrame:
    events = t("events").select("event_id", "user_id")
    return decode_join(events, "user_id", t("customer"), "c_custkey", "c_name", "Unknown")


_UNITS_SQL = """
    SELECT p_partkey, p_retailprice AS size,
           CASE p_type WHEN 'PROMO' THEN 'cm' WHEN 'SMALL' THEN 'cm' WHEN 'LARGE' THEN 'km'
                       WHEN 'ECONOMY' THEN 'inch' ELSE 'm' END AS unit
    FROM part
"""


@query(
    f"""
    SELECT p_partkey, unit,
           CASE unit WHEN 'm' THEN size WHEN 'cm' THEN round(size * 0.01::DOUBLE / 1.0::DOUBLE)
                     WHEN 'km' THEN round(size * 1000.0::DOUBLE / 1.0::DOUBLE) END AS metres,
           CASE unit WHEN 'm' THEN size >= 1.8 WHEN 'cm' THEN size * 0.01::DOUBLE >= 1.8::DOUBLE
                     WHEN 'km' THEN size * 1000.0::DOUBLE >= 1.8 END AS is_large
    FROM ({_UNITS_SQL})
    """
)
def unit_normalise(t: Table) -> DataFrame:
    units = {"PROMO": "cm", "SMALL": "cm", "LARGE": "km", "ECONOMY": "inch"}
    sized = t("part").select(
        "p_partkey", F.col("p_retailprice").alias("size"), decode_value("p_type", units, "m").alias("unit")
    )
    return sized.select(
        "p_partkey",
        "unit",
        convert_unit("size", "unit", "m").alias("metres"),
        is_at_least("size", "unit").alias("is_large"),
    )


@query(
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN 'OutOfStock'
                WHEN o_orderpriority = '5-LOW' THEN 'PaymentMethodMissing'
                WHEN c_acctbal < o_totalprice / 100 THEN 'InsufficientBalance'
                ELSE 'OrderPlaced' END AS order_status
    FROM orders JOIN customer ON o_custkey = c_custkey
    """
)
def classify_orders(t: Table) -> DataFrame:
    orders = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    status = first_match(
        [
            (F.col("o_orderstatus") == "P", "OutOfStock"),
            (F.col("o_orderpriority") == "5-LOW", "PaymentMethodMissing"),
            (F.col("c_acctbal") < F.col("o_totalprice") / 100, "InsufficientBalance"),
        ],
        "OrderPlaced",
    )
    return orders.select("o_orderkey", status.alias("order_status"))
