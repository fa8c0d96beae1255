"""Type 2 merges: three marts built from the tables, each with an increment.

Rows before the first date are a mart's history, the latest row of a key
between the dates is its open row, and rows from the second date on are the
increment, which may hold several rows per key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowforge.operators import (
    Scd2Config,
    scd2_changes,
    scd2_closed,
    scd2_merge,
    scd2_new,
    scd2_unchanged,
)
from rowforge.operators.scd2 import OPEN_END_TIMESTAMP
from rowforge.plans.registry import Table, query


def _between(col: str, low: str | None, high: str | None) -> Column:
    at = F.col(col)
    lower = F.lit(True) if low is None else at >= F.lit(low).cast("timestamp_ntz")
    upper = F.lit(True) if high is None else at < F.lit(high).cast("timestamp_ntz")
    return lower & upper


def _latest(df: DataFrame, keys: list[str], order: list[str], cols: list[str]) -> DataFrame:
    row = F.max(F.struct(*order, F.struct(*cols).alias("row")))["row"]
    return df.groupBy(*keys).agg(row.alias("row")).select("row.*")


def _shown(rows: DataFrame, *times: str) -> DataFrame:
    """Times as text: open ends lie beyond what nanosecond timestamps can hold."""
    return rows.withColumns({c: F.col(c).cast("string") for c in times})


# ---- Flag variant: the latest order of each customer -----------------------

FLAG = Scd2Config(
    keys=["custkey"],
    tracked=["status", "priority"],
    active_col="is_active",
    open_end=OPEN_END_TIMESTAMP,
    latest_by=["ordered", "orderkey"],
)
FLAG_AS_OF = dt.datetime(2001, 9, 1)

_FLAG_SQL = """
    WITH o AS (SELECT o_custkey AS custkey, o_orderstatus AS status, o_orderpriority AS priority,
                      o_orderdate AS ordered, o_orderkey AS orderkey FROM orders),
    history AS (SELECT custkey, status, priority, ordered AS effective_from_dt,
                       TIMESTAMP '1998-01-01' AS effective_to_dt, FALSE AS is_active
                FROM o WHERE ordered < TIMESTAMP '1998-01-01'),
    cur AS (SELECT custkey, status, priority, ordered AS effective_from_dt,
                   TIMESTAMP '5999-12-31' AS effective_to_dt, TRUE AS is_active
            FROM o WHERE ordered >= TIMESTAMP '1998-01-01' AND ordered < TIMESTAMP '2000-06-01'
            QUALIFY row_number() OVER (PARTITION BY custkey ORDER BY ordered DESC, orderkey DESC) = 1),
    inc AS (SELECT custkey, status, priority FROM o WHERE ordered >= TIMESTAMP '2000-06-01'
            QUALIFY row_number() OVER (PARTITION BY custkey ORDER BY ordered DESC, orderkey DESC) = 1),
    unchanged AS (SELECT cur.* FROM cur LEFT JOIN inc USING (custkey)
                  WHERE inc.custkey IS NULL OR (inc.status = cur.status AND inc.priority = cur.priority)),
    closed AS (SELECT custkey, cur.status, cur.priority, effective_from_dt,
                      TIMESTAMP '2001-09-01' AS effective_to_dt, FALSE AS is_active
               FROM cur JOIN inc USING (custkey)
               WHERE inc.status <> cur.status OR inc.priority <> cur.priority),
    opened AS (SELECT custkey, inc.status, inc.priority, TIMESTAMP '2001-09-01' AS effective_from_dt,
                      TIMESTAMP '5999-12-31' AS effective_to_dt, TRUE AS is_active
               FROM inc LEFT JOIN cur USING (custkey)
               WHERE cur.custkey IS NULL OR inc.status <> cur.status OR inc.priority <> cur.priority)
"""
_SHOWN_FLAG = """
    SELECT * REPLACE (effective_from_dt::VARCHAR AS effective_from_dt,
                      effective_to_dt::VARCHAR AS effective_to_dt) FROM
"""
_FLAG_MERGE_SQL = (
    _FLAG_SQL
    + _SHOWN_FLAG
    + """(SELECT * FROM history UNION ALL SELECT * FROM unchanged
          UNION ALL SELECT * FROM closed UNION ALL SELECT * FROM opened)
    """
)


def customer_mart(t: Table) -> tuple[DataFrame, DataFrame]:
    orders = t("orders").select(
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("ordered"),
        F.col("o_orderkey").alias("orderkey"),
    )

    def versions(rows: DataFrame, end: str, active: bool) -> DataFrame:
        return rows.select(
            "custkey",
            "status",
            "priority",
            F.col("ordered").alias("effective_from_dt"),
            F.lit(end).cast("timestamp_ntz").alias("effective_to_dt"),
            F.lit(active).alias("is_active"),
        )

    history = versions(orders.where(_between("ordered", None, "1998-01-01")), "1998-01-01", False)
    recent = orders.where(_between("ordered", "1998-01-01", "2000-06-01"))
    newest = _latest(recent, ["custkey"], ["ordered", "orderkey"], ["custkey", "status", "priority", "ordered"])
    mart = history.unionByName(versions(newest, OPEN_END_TIMESTAMP, True))
    return mart, orders.where(_between("ordered", "2000-06-01", None))


@query(_FLAG_MERGE_SQL)
def scd2_merge_flag(t: Table) -> DataFrame:
    mart, increment = customer_mart(t)
    return _shown(scd2_merge(mart, increment, FLAG, FLAG_AS_OF), "effective_from_dt", "effective_to_dt")


@query(_FLAG_MERGE_SQL)
def scd2_merge_small_increment(t: Table) -> DataFrame:
    mart, increment = customer_mart(t)
    return _shown(scd2_merge(mart, increment, FLAG, FLAG_AS_OF, small_increment=True), "effective_from_dt", "effective_to_dt")


@query(
    _FLAG_SQL
    + """
    SELECT custkey, CASE WHEN cur.custkey IS NULL THEN 'new' WHEN inc.custkey IS NULL THEN 'missing'
                         WHEN inc.status <> cur.status OR inc.priority <> cur.priority THEN 'changed'
                         ELSE 'unchanged' END AS status
    FROM cur FULL JOIN inc USING (custkey)
    """,
    name="scd2_changes",
)
def customer_changes(t: Table) -> DataFrame:
    mart, increment = customer_mart(t)
    return scd2_changes(mart, increment, FLAG)


@query(_FLAG_SQL + _SHOWN_FLAG + "closed", name="scd2_closed")
def customer_closed(t: Table) -> DataFrame:
    mart, increment = customer_mart(t)
    return _shown(scd2_closed(mart, increment, FLAG, FLAG_AS_OF), "effective_from_dt", "effective_to_dt")


@query(_FLAG_SQL + _SHOWN_FLAG + "opened", name="scd2_new")
def customer_new(t: Table) -> DataFrame:
    mart, increment = customer_mart(t)
    return _shown(scd2_new(mart, increment, FLAG, FLAG_AS_OF), "effective_from_dt", "effective_to_dt")


@query(_FLAG_SQL + _SHOWN_FLAG + "unchanged", name="scd2_unchanged")
def customer_unchanged(t: Table) -> DataFrame:
    mart, increment = customer_mart(t)
    return _shown(scd2_unchanged(mart, increment, FLAG, FLAG_AS_OF), "effective_from_dt", "effective_to_dt")


# ---- Date variant: the latest shipment of each part by each supplier --------

DATE = Scd2Config(
    keys=["partkey", "suppkey"],
    tracked=["returnflag", "linestatus"],
    from_col="start_date",
    to_col="end_date",
    latest_by=["shipped", "orderkey", "linenumber"],
)
DATE_AS_OF = dt.date(2001, 12, 1)


@query(
    """
    WITH l AS (SELECT l_partkey AS partkey, l_suppkey AS suppkey, l_returnflag AS returnflag,
                      l_linestatus AS linestatus, l_quantity AS quantity, l_shipdate::DATE AS shipped,
                      l_orderkey AS orderkey, l_linenumber AS linenumber FROM lineitem),
    history AS (SELECT partkey, suppkey, returnflag, linestatus, quantity, shipped AS start_date,
                       DATE '1997-01-01' AS end_date FROM l WHERE shipped < DATE '1997-01-01'),
    cur AS (SELECT partkey, suppkey, returnflag, linestatus, quantity, shipped AS start_date,
                   DATE '9999-12-31' AS end_date
            FROM l WHERE shipped >= DATE '1997-01-01' AND shipped < DATE '1999-06-01'
            QUALIFY row_number() OVER (PARTITION BY partkey, suppkey
                                       ORDER BY shipped DESC, orderkey DESC, linenumber DESC) = 1),
    inc AS (SELECT * FROM l WHERE shipped >= DATE '1999-06-01'
            QUALIFY row_number() OVER (PARTITION BY partkey, suppkey
                                       ORDER BY shipped DESC, orderkey DESC, linenumber DESC) = 1)
    SELECT * REPLACE (end_date::VARCHAR AS end_date) FROM (
    SELECT * FROM history
    UNION ALL
    SELECT cur.* FROM cur LEFT JOIN inc USING (partkey, suppkey)
    WHERE inc.partkey IS NULL OR (inc.returnflag = cur.returnflag AND inc.linestatus = cur.linestatus)
    UNION ALL
    SELECT partkey, suppkey, cur.returnflag, cur.linestatus, cur.quantity, start_date, DATE '2001-12-01'
    FROM cur JOIN inc USING (partkey, suppkey)
    WHERE inc.returnflag <> cur.returnflag OR inc.linestatus <> cur.linestatus
    UNION ALL
    SELECT partkey, suppkey, inc.returnflag, inc.linestatus, inc.quantity,
           DATE '2001-12-01', DATE '9999-12-31'
    FROM inc LEFT JOIN cur USING (partkey, suppkey)
    WHERE cur.partkey IS NULL OR inc.returnflag <> cur.returnflag OR inc.linestatus <> cur.linestatus)
    """
)
def scd2_merge_date(t: Table) -> DataFrame:
    lines = t("lineitem").select(
        F.col("l_partkey").alias("partkey"),
        F.col("l_suppkey").alias("suppkey"),
        F.col("l_returnflag").alias("returnflag"),
        F.col("l_linestatus").alias("linestatus"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_shipdate").alias("shipped"),
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_linenumber").alias("linenumber"),
    )
    keys, rest = list(DATE.keys), [*DATE.tracked, "quantity"]

    def versions(rows: DataFrame, end: str) -> DataFrame:
        return rows.select(
            *keys,
            *rest,
            F.col("shipped").cast("date").alias("start_date"),
            F.lit(end).cast("date").alias("end_date"),
        )

    history = versions(lines.where(_between("shipped", None, "1997-01-01")), "1997-01-01")
    recent = lines.where(_between("shipped", "1997-01-01", "1999-06-01"))
    newest = _latest(recent, keys, list(DATE.latest_by), [*keys, *rest, "shipped"])
    mart = history.unionByName(versions(newest, "9999-12-31"))
    increment = lines.where(_between("shipped", "1999-06-01", None))
    return _shown(scd2_merge(mart, increment, DATE, DATE_AS_OF), "end_date")


# ---- Audit variant: the latest event of each user ---------------------------

AUDIT = Scd2Config(
    keys=["user_id"],
    tracked=["event_type"],
    latest_by=["ts", "event_id"],
    audit={"load_dttm": dt.datetime(2024, 2, 1, 12), "load_dt": dt.date(2024, 2, 1)},
)
AUDIT_AS_OF = dt.date(2024, 2, 1)


@query(
    """
    WITH history AS (
        SELECT user_id, event_type, value, ts::DATE AS effective_from_dt,
               DATE '2024-01-10' AS effective_to_dt, TIMESTAMP '2024-01-10' AS load_dttm,
               DATE '2024-01-10' AS load_dt
        FROM events WHERE ts < TIMESTAMP '2024-01-10'),
    cur AS (SELECT user_id, event_type, value, ts::DATE AS effective_from_dt,
                   DATE '9999-12-31' AS effective_to_dt
            FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-29'
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
    inc AS (SELECT user_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-29'
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
    emitted AS (
        SELECT cur.* FROM cur LEFT JOIN inc USING (user_id)
        WHERE inc.user_id IS NULL OR inc.event_type = cur.event_type
        UNION ALL
        SELECT user_id, cur.event_type, cur.value, effective_from_dt, DATE '2024-02-01'
        FROM cur JOIN inc USING (user_id) WHERE inc.event_type <> cur.event_type
        UNION ALL
        SELECT user_id, inc.event_type, inc.value, DATE '2024-02-01', DATE '9999-12-31'
        FROM inc LEFT JOIN cur USING (user_id)
        WHERE cur.user_id IS NULL OR inc.event_type <> cur.event_type)
    SELECT * REPLACE (effective_to_dt::VARCHAR AS effective_to_dt,
                      load_dttm::VARCHAR AS load_dttm) FROM (
        SELECT * FROM history
        UNION ALL
        SELECT *, TIMESTAMP '2024-02-01 12:00:00', DATE '2024-02-01' FROM emitted)
    """
)
def scd2_merge_audit(t: Table) -> DataFrame:
    events = t("events").select("user_id", "event_type", "value", "ts", "event_id")

    def versions(rows: DataFrame, end: str) -> DataFrame:
        return rows.select(
            "user_id",
            "event_type",
            "value",
            F.col("ts").cast("date").alias("effective_from_dt"),
            F.lit(end).cast("date").alias("effective_to_dt"),
            F.lit("2024-01-10").cast("timestamp_ntz").alias("load_dttm"),
            F.lit("2024-01-10").cast("date").alias("load_dt"),
        )

    history = versions(events.where(_between("ts", None, "2024-01-10")), "2024-01-10")
    recent = events.where(_between("ts", "2024-01-10", "2024-01-29"))
    newest = _latest(recent, ["user_id"], ["ts", "event_id"], ["user_id", "event_type", "value", "ts"])
    mart = history.unionByName(versions(newest, "9999-12-31"))
    increment = events.where(_between("ts", "2024-01-29", None))
    return _shown(scd2_merge(mart, increment, AUDIT, AUDIT_AS_OF), "effective_to_dt", "load_dttm")


# ---- Snapshots: all customers' latest orders a month later, with nulls in what is tracked ----

SNAPSHOT = Scd2Config(keys=["custkey"], tracked=["state", "priority"], active_col="is_active", open_end=OPEN_END_TIMESTAMP)
SNAPSHOT_BUCKETS = 4096

_SNAPSHOT_SQL = """
    WITH o AS (SELECT o_custkey AS custkey, CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS state,
                      nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority,
                      o_orderdate AS ordered, o_orderkey AS orderkey FROM orders),
    cur AS (SELECT * FROM o WHERE ordered < TIMESTAMP '2001-06-01'
            QUALIFY row_number() OVER (PARTITION BY custkey ORDER BY ordered DESC, orderkey DESC) = 1),
    inc AS (SELECT * FROM o WHERE ordered < TIMESTAMP '2001-07-01' AND custkey % 97 <> 5
            QUALIFY row_number() OVER (PARTITION BY custkey ORDER BY ordered DESC, orderkey DESC) = 1),
    met AS (SELECT coalesce(cur.custkey, inc.custkey) AS custkey, cur.state, cur.priority, cur.ordered,
                   inc.state AS new_state, inc.priority AS new_priority,
                   CASE WHEN cur.custkey IS NULL THEN 'new' WHEN inc.custkey IS NULL THEN 'missing'
                        WHEN cur.state IS DISTINCT FROM inc.state OR cur.priority IS DISTINCT FROM inc.priority
                        THEN 'changed' ELSE 'unchanged' END AS status
            FROM cur FULL JOIN inc ON cur.custkey = inc.custkey)
"""


def customer_snapshots(t: Table) -> tuple[DataFrame, DataFrame]:
    status = F.col("o_orderstatus")
    orders = t("orders").select(
        F.col("o_custkey").alias("custkey"),
        F.when(status != "O", status).alias("state"),
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("priority"),
        F.col("o_orderdate").alias("ordered"),
        F.col("o_orderkey").alias("orderkey"),
    )

    def latest(high: str) -> DataFrame:
        rows = orders.where(_between("ordered", None, high))
        return _latest(rows, ["custkey"], ["ordered", "orderkey"], ["custkey", "state", "priority", "ordered"])

    mart = latest("2001-06-01").select(
        "custkey",
        "state",
        "priority",
        F.col("ordered").alias("effective_from_dt"),
        F.lit(OPEN_END_TIMESTAMP).cast("timestamp_ntz").alias("effective_to_dt"),
        F.lit(True).alias("is_active"),
    )
    return mart, latest("2001-07-01").where("custkey % 97 <> 5").drop("ordered")


@query(_SNAPSHOT_SQL + "SELECT custkey, status FROM met")
def scd2_changes_by_digest(t: Table) -> DataFrame:
    """A snapshot that repeats nearly the whole mart: only buckets of keys that differ are joined."""
    mart, snapshot = customer_snapshots(t)
    return scd2_changes(mart, snapshot, SNAPSHOT, buckets=SNAPSHOT_BUCKETS)


@query(
    _SNAPSHOT_SQL
    + """
    SELECT custkey, state, priority, ordered::VARCHAR AS effective_from_dt,
           CASE WHEN status = 'changed' THEN '2001-09-01 00:00:00' ELSE '5999-12-31 00:00:00' END AS effective_to_dt,
           status <> 'changed' AS is_active
    FROM met WHERE status <> 'new'
    UNION ALL
    SELECT custkey, new_state, new_priority, '2001-09-01 00:00:00', '5999-12-31 00:00:00', TRUE
    FROM met WHERE status IN ('new', 'changed')
    """
)
def scd2_merge_nulls(t: Table) -> DataFrame:
    """Values that become null, and nulls that become values, are changes; equal nulls are not."""
    mart, snapshot = customer_snapshots(t)
    merged = scd2_merge(mart, snapshot, SNAPSHOT, FLAG_AS_OF, buckets=SNAPSHOT_BUCKETS)
    return _shown(merged, "effective_from_dt", "effective_to_dt")
