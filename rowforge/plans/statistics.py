"""Grouped, global, extreme-value and top-k statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowforge.functions import weekday_name
from rowforge.operators import (
    ExtremeOf,
    count_per_key,
    distinct_sketches,
    extreme_groups,
    field_stats,
    keys_with_distinct,
    most_frequent_month,
    top_counts,
    with_average,
)
from rowforge.plans.registry import Table, average, epoch_seconds, money, query


@query(
    """
    SELECT l_shipdate::DATE AS ship_day, min(l_quantity) AS min_quantity, max(l_quantity) AS max_quantity
    FROM lineitem GROUP BY ship_day
    """
)
def group_min_max(t: Table) -> DataFrame:
    """Extremes of a number held as text, per day."""
    lines = t("lineitem").select(
        F.col("l_shipdate").cast("date").alias("ship_day"),
        F.col("l_quantity").cast("string").try_cast("double").alias("quantity"),
    )
    return lines.groupBy("ship_day").agg(
        F.min("quantity").alias("min_quantity"), F.max("quantity").alias("max_quantity")
    )


@query("SELECT event_type, count(*) AS rows FROM events GROUP BY event_type")
def group_count(t: Table) -> DataFrame:
    return count_per_key(t("events"), ["event_type"])


@query(
    """
    SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE AS revenue
    FROM lineitem GROUP BY l_suppkey
    """
)
def group_sum(t: Table) -> DataFrame:
    revenue = F.sum(money("l_extendedprice")).cast("double")
    return t("lineitem").groupBy("l_suppkey").agg(revenue.alias("revenue"))


@query(
    """
    SELECT l_suppkey, sum(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE / count(*) AS avg_quantity
    FROM lineitem GROUP BY l_suppkey
    """
)
def avg_per_key(t: Table) -> DataFrame:
    mean = average(F.sum(money("l_quantity")), F.count("l_quantity"))
    return t("lineitem").groupBy("l_suppkey").agg(mean.alias("avg_quantity"))


def _extreme_sql(kind: str, key: str, extreme: str) -> str:
    order = "DESC" if extreme == "max" else "ASC"
    return f"""
        SELECT * FROM (
            SELECT {key}::VARCHAR AS name, '{kind}' AS stats_type, l_linestatus AS location,
                   {extreme}(l_extendedprice) AS value, '{extreme}' AS value_type
            FROM lineitem GROUP BY {key}, l_linestatus
            ORDER BY value {order}, name, location LIMIT 1)
    """


@query(
    " UNION ALL ".join(
        _extreme_sql(kind, key, extreme)
        for kind, key in (("flag", "l_returnflag"), ("supplier", "l_suppkey"))
        for extreme in ("max", "min")
    ),
    name="extreme_groups",
)
def extreme_prices(t: Table) -> DataFrame:
    wanted = [
        ExtremeOf(kind, key, "l_linestatus", extreme)
        for kind, key in (("flag", "l_returnflag"), ("supplier", "l_suppkey"))
        for extreme in ("max", "min")
    ]
    return extreme_groups(t("lineitem"), "l_extendedprice", wanted)


@query(
    """
    SELECT sum(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE AS total,
           sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity
    FROM lineitem
    """
)
def global_totals(t: Table) -> DataFrame:
    return t("lineitem").agg(
        F.sum(money("l_quantity") * money("l_extendedprice")).cast("double").alias("total"),
        F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
    )


@query(
    """
    SELECT l_suppkey,
           round(sum(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2))))::BIGINT
             AS total
    FROM lineitem GROUP BY l_suppkey
    """
)
def totals_per_key_rounded(t: Table) -> DataFrame:
    total = F.round(F.sum(money("l_quantity") * money("l_extendedprice")), 0).cast("long")
    return t("lineitem").groupBy("l_suppkey").agg(total.alias("total"))


@query(
    """
    SELECT sum(v)::DOUBLE AS total, min(v)::DOUBLE AS least, max(v)::DOUBLE AS greatest,
           sum(v)::DOUBLE / count(*) AS average, count(*) AS rows
    FROM (SELECT CAST(value AS DECIMAL(18,2)) AS v FROM events)
    """,
    name="field_stats",
)
def event_value_stats(t: Table) -> DataFrame:
    stats = field_stats(t("events").select(money("value").alias("value")), "value")
    doubles = {c: F.col(c).cast("double") for c in ("total", "least", "greatest")}
    return stats.withColumns(doubles)


@query(
    """
    SELECT (SELECT count(DISTINCT user_id) FROM events) AS users,
           (SELECT count(DISTINCT l_partkey) FROM lineitem) AS parts
    """
)
def distinct_count(t: Table) -> DataFrame:
    users = t("events").agg(F.countDistinct("user_id").alias("users"))
    parts = t("lineitem").agg(F.countDistinct("l_partkey"))
    return users.withColumn("parts", parts.scalar())


@query(
    """
    SELECT CASE strftime(o_orderdate, '%m')
             WHEN '01' THEN 'JANUARY' WHEN '02' THEN 'FEBRUARY' WHEN '03' THEN 'MARCH'
             WHEN '04' THEN 'APRIL' WHEN '05' THEN 'MAY' WHEN '06' THEN 'JUNE'
             WHEN '07' THEN 'JULY' WHEN '08' THEN 'AUGUST' WHEN '09' THEN 'SEPTEMBER'
             WHEN '10' THEN 'OCTOBER' WHEN '11' THEN 'NOVEMBER' WHEN '12' THEN 'DECEMBER'
           END AS month, count(*) AS rows
    FROM orders GROUP BY strftime(o_orderdate, '%m')
    ORDER BY rows DESC, strftime(o_orderdate, '%m') LIMIT 1
    """,
    name="most_frequent_month",
)
def busiest_month(t: Table) -> DataFrame:
    dated = t("orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return most_frequent_month(dated, "day")


@query(
    """
    SELECT c_custkey, balance::DOUBLE AS balance,
           (SELECT sum(CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) ELSE 0 END)::DOUBLE
                   / count(*) FROM customer) AS avg_balance
    FROM (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer)
    """
)
def avg_null_as_zero(t: Table) -> DataFrame:
    balance = F.when(F.col("c_acctbal") >= 0, money("c_acctbal")).alias("balance")
    averaged = with_average(t("customer").select("c_custkey", balance), "balance", "avg_balance")
    return averaged.withColumn("balance", F.col("balance").cast("double"))


@query(
    """
    SELECT user_id, count(*) AS rows FROM events GROUP BY user_id
    ORDER BY rows DESC, user_id LIMIT 3
    """
)
def top_keys(t: Table) -> DataFrame:
    return top_counts(t("events"), "user_id", 3, key_name="user_id")


@query(
    """
    SELECT upper(dayname(ts)) AS weekday, count(*) AS rows FROM events
    WHERE event_type = 'error' GROUP BY weekday ORDER BY rows DESC, weekday LIMIT 3
    """
)
def top_weekdays(t: Table) -> DataFrame:
    errors = t("events").where(F.col("event_type") == "error").select(epoch_seconds("ts").alias("time"))
    return top_counts(errors, weekday_name("time"), 3, key_name="weekday")


@query(
    """
    SELECT 'lang' AS field, lang AS name, count(*) AS rows FROM documents GROUP BY lang
    UNION ALL
    SELECT 'source', source, count(*) FROM documents GROUP BY source
    """
)
def skew_report(t: Table) -> DataFrame:
    """Rows per value of each candidate join key, the largest first; one scan for all of them."""
    fields = t("documents").select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(c).alias("field"), F.col(c).alias("name"))
                    for c in ("lang", "source")
                )
            )
        )
    )
    return count_per_key(fields, ["field", "name"]).orderBy(F.desc("rows"), "field", "name")


@query(
    """
    SELECT l_suppkey FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '2000-01-01'
    GROUP BY l_suppkey HAVING count(DISTINCT l_orderkey) >= 340
    """
)
def busy_suppliers(t: Table) -> DataFrame:
    """Suppliers in at least 340 orders over four years: daily sketches merged, exact counts near the threshold."""
    lines = t("lineitem").select(
        "l_suppkey", F.col("l_shipdate").cast("date").alias("day"), "l_orderkey"
    )
    sketches = distinct_sketches(lines, ["l_suppkey"], "day", "l_orderkey")
    years = F.col("day").between(F.lit("1996-01-01").cast("date"), F.lit("1999-12-31").cast("date"))
    return keys_with_distinct(sketches, lines, ["l_suppkey"], "l_orderkey", 340, years)
