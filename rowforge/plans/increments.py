"""What an incremental load still has to process."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowforge.functions import month_end
from rowforge.operators import flag_load_batches, late_rows, latest_values, missing_periods
from rowforge.plans.registry import Table, query

AS_OF = dt.date(1998, 6, 15)


@query(
    """
    SELECT DISTINCT last_day(o_orderdate::DATE) AS period FROM orders
    ORDER BY period DESC LIMIT 6
    """
)
def topk_latest_periods(t: Table) -> DataFrame:
    return latest_values(t("orders").select(month_end("o_orderdate").alias("period")), "period")


@query(
    """
    WITH sent AS (SELECT DISTINCT last_day(l_shipdate::DATE) AS period FROM lineitem
                  ORDER BY period DESC LIMIT 6),
         reported AS (SELECT DISTINCT last_day(o_orderdate::DATE) AS period FROM orders
                      ORDER BY period DESC LIMIT 6)
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate::DATE AS ship_day FROM lineitem
    WHERE last_day(l_shipdate::DATE) IN (SELECT period FROM sent EXCEPT SELECT period FROM reported)
    """,
    name="missing_periods",
)
def unreported_lines(t: Table) -> DataFrame:
    """Lines shipped in recent months for which there are no orders yet."""
    reported = t("orders").select(month_end("o_orderdate").alias("report_dt"))
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    unreported = missing_periods(lines, reported, "l_shipdate", "report_dt")
    return unreported.withColumn("ship_day", F.col("l_shipdate").cast("date")).drop("l_shipdate")


# An order is reported some days after it is loaded, the less urgent the later.
_BATCHES_SQL = """
    SELECT o_orderkey, o_orderdate::DATE AS load_day,
           last_day(o_orderdate::DATE + CAST(left(o_orderpriority, 1) AS INTEGER) * 5) AS report_dt
    FROM orders
"""
_FLAGGED_SQL = f"""
    SELECT o_orderkey, load_day, report_dt,
           CASE WHEN len(dates) = 1 AND list_contains(dates, DATE '1998-06-30') THEN 0 ELSE 1 END AS flag
    FROM ({_BATCHES_SQL})
    JOIN (SELECT load_day, list(DISTINCT report_dt) AS dates FROM ({_BATCHES_SQL}) GROUP BY load_day)
    USING (load_day)
"""


def _batches(t: Table) -> DataFrame:
    lag = F.left("o_orderpriority", F.lit(1)).cast("int") * 5
    day = F.col("o_orderdate").cast("date")
    return t("orders").select(
        "o_orderkey", day.alias("load_day"), F.last_day(F.date_add(day, lag)).alias("report_dt")
    )


@query(_FLAGGED_SQL)
def load_batch_flags(t: Table) -> DataFrame:
    return flag_load_batches(_batches(t), "load_day", "report_dt", AS_OF)


@query(f"SELECT * FROM ({_FLAGGED_SQL}) WHERE flag = 1 AND report_dt = DATE '1998-05-31'", name="late_rows")
def late_orders(t: Table) -> DataFrame:
    return late_rows(_batches(t), "load_day", "report_dt", AS_OF)
