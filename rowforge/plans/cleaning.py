"""Dates in text, regular expressions, null handling, text and JSON lines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from rowforge.functions import age_in_years, parse_date
from rowforge.functions.dates import EPOCH
from rowforge.operators import (
    cast_columns,
    clean,
    dates_after,
    dedup_by_key,
    field_stats,
    project_filled,
    read_quality,
    replace_pattern,
)
from rowforge.plans.registry import Table, epoch_seconds, query
from rowforge.sources import TextField, parse_delimited, parse_json_lines

# Order dates written in three known spellings and an unknown one, by priority.
_DATE_TEXT_SQL = """
    SELECT o_orderkey, CASE o_orderpriority
        WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y %m %d')
        WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y %b %d')
        WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%d/%m/%Y')
        ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_text
    FROM orders
"""


def _orders_with_date_text(t: Table) -> DataFrame:
    def spelled(fmt: str) -> Column:
        return F.date_format("o_orderdate", fmt)

    priority = F.col("o_orderpriority")
    text = (
        F.when(priority == "2-HIGH", spelled("yyyy MM dd"))
        .when(priority == "3-MEDIUM", spelled("yyyy MMM dd"))
        .when(priority == "4-NOT SPECIFIED", spelled("dd/MM/yyyy"))
        .otherwise(spelled("yyyy-MM-dd"))
    )
    return t("orders").select("o_orderkey", text.alias("date_text"))


@query(
    f"""
    SELECT o_orderkey, date_text, d AS order_date, (DATE '2024-04-26' - d) // 365 AS years
    FROM (SELECT o_orderkey, date_text,
                 coalesce(try_strptime(date_text, '%Y-%m-%d'), try_strptime(date_text, '%Y %m %d'),
                          try_strptime(date_text, '%Y %b %d'), TIMESTAMP '1970-01-01')::DATE AS d
          FROM ({_DATE_TEXT_SQL}))
    """
)
def multi_format_dates(t: Table) -> DataFrame:
    dated = _orders_with_date_text(t).withColumn("order_date", parse_date("date_text", default=EPOCH))
    return dated.withColumn("years", age_in_years("order_date", dt.date(2024, 4, 26)).cast("long"))


@query(
    f"""
    SELECT o_orderkey, date_text FROM ({_DATE_TEXT_SQL})
    WHERE coalesce(try_strptime(date_text, '%Y-%m-%d')::DATE, DATE '1900-01-01') > DATE '1998-02-11'
    """,
    name="dates_after",
)
def orders_after_date(t: Table) -> DataFrame:
    return dates_after(_orders_with_date_text(t), "date_text", dt.date(1998, 2, 11))


@query(
    r"""
    SELECT p_partkey, regexp_replace(p_name, '[\n    ]', '', 'g') AS p_name,
           try_cast(regexp_replace(coalesce(p_brand, 'n/a'), '\D+', '', 'g') AS INTEGER) AS p_brand,
           coalesce(nullif(p_type, 'PROMO'), '0') AS p_type
    FROM part
    """
)
def regex_clean(t: Table) -> DataFrame:
    parts = t("part").withColumn("p_type", F.nullif("p_type", F.lit("PROMO")))
    return (
        parts.transform(project_filled, {"p_partkey": 0, "p_name": "n/a", "p_brand": "n/a", "p_type": "0"})
        .transform(replace_pattern, "p_name", "[\\n    ]")
        .transform(replace_pattern, "p_brand", "\\D+")
        .transform(cast_columns, {"p_brand": "int"})
    )


@query(
    r"""
    SELECT page_id, url_digits, page_param, compact_chars FROM (
        SELECT page_id, try_cast(regexp_replace(url, '\D+', '', 'g') AS INTEGER) AS url_digits,
               param AS page_param,
               length(regexp_replace(html, '[\n    ]', '', 'g')) AS compact_chars,
               row_number() OVER (PARTITION BY param ORDER BY page_id) AS rn
        FROM (SELECT *, regexp_split_to_array(url, '[?&=]')[3] AS param FROM pages))
    WHERE rn = 1 OR page_param IS NULL
    """
)
def extract_clean_dedup(t: Table) -> DataFrame:
    """Fill, strip by pattern, one row per key derived from a link (all rows without one), cast."""
    param = F.get(F.split("url", "[?&=]"), F.lit(2))
    return (
        t("pages")
        .transform(project_filled, {"page_id": -1, "url": "n/a", "html": "n/a"})
        .transform(replace_pattern, "html", "[\\n    ]")
        .withColumn("url_digits", F.col("url"))
        .transform(replace_pattern, "url_digits", "\\D+")
        .withColumn("compact_chars", F.length("html").cast("long"))
        .select("page_id", "url", "url_digits", "compact_chars")
        .transform(dedup_by_key, param, ["page_id"], key_name="page_param")
        .transform(cast_columns, {"url_digits": "int"})
        .drop("url")
    )


_GAPS_SQL = """
    SELECT c_custkey,
           CASE WHEN c_nationkey <> 3 THEN c_name END AS name,
           CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS reduced,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS price,
           CASE WHEN c_acctbal <= 5000 THEN c_nationkey END AS rating,
           CASE WHEN c_nationkey <= 20 THEN c_nationkey END AS sold,
           CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS buyer
    FROM customer
"""


@query(
    f"""
    SELECT c_custkey, name, coalesce(reduced, price) AS reduced, coalesce(price, 'n/a') AS price,
           coalesce(rating, 0) AS rating, coalesce(sold, -1) AS sold,
           coalesce(buyer, 'unknown') AS buyer
    FROM ({_GAPS_SQL}) WHERE name IS NOT NULL
    """
)
def fill_and_drop(t: Table) -> DataFrame:
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    gaps = t("customer").select(
        "c_custkey",
        F.when(nation != 3, F.col("c_name")).alias("name"),
        F.when(F.col("c_acctbal") >= 0, segment).alias("reduced"),
        F.when(segment != "BUILDING", F.col("c_name")).alias("price"),
        F.when(F.col("c_acctbal") <= 5000, nation).alias("rating"),
        F.when(nation <= 20, nation).alias("sold"),
        F.when(segment != "HOUSEHOLD", segment).alias("buyer"),
    )
    return clean(
        gaps,
        required=["c_custkey", "name"],
        fallback={"reduced": "price"},
        fill={"rating": 0, "sold": -1, "buyer": "unknown", "price": "n/a"},
    )


@query(
    """
    SELECT c_custkey, balance FROM (
        SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer)
    WHERE coalesce(balance, 0) > 15
    """
)
def null_as_zero_filter(t: Table) -> DataFrame:
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance")
    return t("customer").select("c_custkey", balance).where(F.coalesce("balance", F.lit(0.0)) > 15)


@query(
    """
    SELECT event_id,
           CASE WHEN event_type IN ('error', 'signup') THEN NULL
                ELSE CAST(props->>'k' AS INTEGER) END AS k,
           NULL::VARCHAR AS label,
           CASE WHEN event_type = 'error' THEN left(props, length(props) - 1) END AS corrupt_record
    FROM events
    """
)
def json_lines(t: Table) -> DataFrame:
    """Lines as they are, without the key, or cut short."""
    line = (
        F.when(F.col("event_type") == "error", F.expr("left(props, length(props) - 1)"))
        .when(F.col("event_type") == "signup", F.lit("{}"))
        .otherwise(F.col("props"))
    )
    schema = StructType([StructField("k", IntegerType()), StructField("label", StringType())])
    lines = t("events").select("event_id", line.alias("value"))
    return parse_json_lines(lines, schema, keep=["event_id"])


# Event rows written as delimited lines: some without a first field, some with
# an unreadable number, some cut short.
_FIELDS_SQL = """
    SELECT event_id AS id, event_type AS host, floor(epoch(ts))::BIGINT AS time,
           CASE WHEN event_type = 'error' THEN -1 ELSE user_id END AS response,
           CASE WHEN event_type = 'signup' THEN -1 ELSE CAST(props->>'k' AS INTEGER) END AS bytes
    FROM events WHERE value >= 1
"""


def _event_fields(t: Table) -> DataFrame:
    event = F.col("event_type")
    line = F.concat_ws(
        ",",
        F.when(F.col("value") < 1, "").otherwise(F.col("event_id").cast("string")),
        event,
        epoch_seconds("ts").cast("string"),
        F.when(event == "error", "x12").otherwise(F.col("user_id").cast("string")),
        F.when(event == "signup", "").otherwise(F.regexp_replace("props", "\\D+", "")),
    )
    fields = [
        TextField("id", "bigint", -1),
        TextField("host"),
        TextField("time", "bigint", -1),
        TextField("response", "bigint", -1),
        TextField("bytes", "int", -1),
    ]
    return parse_delimited(t("events").select(line.alias("value")), fields)


@query(_FIELDS_SQL)
def delimited_lines(t: Table) -> DataFrame:
    return _event_fields(t)


@query(
    f"""
    SELECT count(*) FILTER (WHERE bad) AS incorrect, count(*) FILTER (WHERE NOT bad) AS correct
    FROM (SELECT response = -1 OR bytes = -1 AS bad FROM ({_FIELDS_SQL}))
    """,
    name="read_quality",
)
def event_read_quality(t: Table) -> DataFrame:
    return read_quality(
        _event_fields(t), {"id": -1, "host": "na", "time": -1, "response": -1, "bytes": -1}
    )


@query(
    f"SELECT response, count(*) AS n FROM ({_FIELDS_SQL}) WHERE response <> -1 GROUP BY response"
)
def response_counts(t: Table) -> DataFrame:
    readable = _event_fields(t).where(F.col("response") != -1)
    return readable.groupBy("response").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""
    SELECT sum(bytes)::BIGINT AS total, min(bytes) AS least, max(bytes) AS greatest,
           sum(bytes)::DOUBLE / count(*) AS average, count(*) AS rows
    FROM ({_FIELDS_SQL}) WHERE bytes <> -1
    """
)
def bytes_stats(t: Table) -> DataFrame:
    return field_stats(_event_fields(t), "bytes", sentinel=-1)
