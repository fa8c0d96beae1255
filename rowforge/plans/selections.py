"""Projections, filters, conditional columns, duplicates, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowforge.functions import decode_value, fingerprint, starts_with_any
from rowforge.operators import add_constants, dedup_by_key, partition_balance
from rowforge.plans.registry import Table, average, money, query


@query(
    """
    SELECT count(*) AS n FROM customer
    WHERE c_mktsegment = 'BUILDING' AND try_cast(c_acctbal AS DOUBLE) > 0
    """
)
def select_filter_count(t: Table) -> DataFrame:
    balance = F.col("c_acctbal").cast("string").try_cast("double")
    rows = t("customer").select("c_mktsegment", "c_acctbal")
    kept = rows.where((F.col("c_mktsegment") == "BUILDING") & (balance > 0.0))
    return kept.agg(F.count(F.lit(1)).alias("n"))


@query(
    """
    SELECT p_brand, size,
           round(CAST(CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / count(*)
                      AS DECIMAL(20,6)), 1)::DOUBLE AS avg_price,
           count(*) AS n,
           CASE p_brand WHEN 'Brand#1' THEN 1 WHEN 'Brand#2' THEN 0 ELSE -1 END AS brand_code
    FROM (SELECT p_brand, p_size + 2 AS size, p_retailprice FROM part)
    WHERE size BETWEEN 30 AND 35
    GROUP BY p_brand, size
    """
)
def between_group_avg(t: Table) -> DataFrame:
    sized = t("part").select("p_brand", (F.col("p_size") + 2).alias("size"), "p_retailprice")
    mean = average(F.sum(money("p_retailprice")), F.count(F.lit(1)))
    return (
        sized.where(F.col("size").between(30, 35))
        .groupBy("p_brand", "size")
        .agg(
            F.round(mean.cast("decimal(20,6)"), 1).cast("double").alias("avg_price"),
            F.count(F.lit(1)).alias("n"),
        )
        .withColumn("brand_code", decode_value("p_brand", {"Brand#1": 1, "Brand#2": 0}, -1))
        .orderBy("p_brand", "size")
    )


@query(
    """
    SELECT DISTINCT o_orderstatus, o_orderpriority,
           CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS is_due,
           CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE -1 END AS status_code
    FROM orders
    """
)
def conditional_code(t: Table) -> DataFrame:
    done = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")
    return (
        t("orders")
        .select("o_orderstatus", "o_orderpriority")
        .distinct()
        .withColumn("is_due", F.when(done, 0).otherwise(1))
        .withColumn("status_code", decode_value("o_orderstatus", {"F": 1, "O": 0}, -1))
    )


@query(
    """
    SELECT DISTINCT p_name, p_type FROM part
    WHERE lower(p_name) LIKE 'red%' OR lower(p_name) LIKE 'small%'
    """
)
def prefix_any_filter(t: Table) -> DataFrame:
    return t("part").select("p_name", "p_type").distinct().where(starts_with_any("p_name", ["RED", "small"]))


@query(
    "SELECT c_custkey, "
    + ", ".join(f"'n' AS col_{i}" for i in range(1, 11))
    + " FROM customer"
)
def many_literal_columns(t: Table) -> DataFrame:
    return t("customer").select("c_custkey").transform(
        add_constants, {f"col_{i}": "n" for i in range(1, 11)}
    )


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem", name="distinct_projection")
def distinct_projection(t: Table) -> DataFrame:
    return t("lineitem").select("l_returnflag", "l_linestatus").distinct()


@query(
    """
    SELECT page_id, url, host FROM (
        SELECT page_id, url, regexp_split_to_array(url, '[/?#]+')[2] AS host,
               row_number() OVER (PARTITION BY regexp_split_to_array(url, '[/?#]+')[2]
                                  ORDER BY page_id) AS rn
        FROM pages)
    WHERE rn = 1
    """,
    name="dedup_by_key",
)
def one_page_per_host(t: Table) -> DataFrame:
    host = F.get(F.split("url", "[/?#]+"), F.lit(1))
    return dedup_by_key(t("pages").select("page_id", "url"), host, ["page_id"], key_name="host")


@query(
    """
    SELECT p_partkey, p_partkey::VARCHAR AS packed_0, p_name AS packed_1,
           p_brand AS packed_2, p_size::VARCHAR AS packed_3, NULL::VARCHAR AS packed_4,
           p_type, p_size
    FROM part
    """
)
def pack_unpack(t: Table) -> DataFrame:
    """Columns through an array (by position) and through a struct (by name) and back."""
    packed = t("part").select(
        "p_partkey",
        F.split(F.concat_ws(",", "p_partkey", "p_name", "p_brand", "p_size"), ",").alias("packed"),
        F.struct("p_type", "p_size").alias("payload"),
    )
    return packed.select(
        "p_partkey",
        *(F.get("packed", F.lit(i)).alias(f"packed_{i}") for i in range(5)),
        "payload.*",
    )


@query(
    """
    SELECT c_custkey,
           sha1(coalesce(length(c_name)::VARCHAR || ':' || c_name, '-') || '|' ||
                coalesce(length(segment)::VARCHAR || ':' || segment, '-')) AS row_sha1,
           sha256(coalesce(length(c_name)::VARCHAR || ':' || c_name, '-') || '|' ||
                  coalesce(length(segment)::VARCHAR || ':' || segment, '-')) AS row_sha256
    FROM (SELECT c_custkey, c_name, nullif(c_mktsegment, 'MACHINERY') AS segment FROM customer)
    """,
    name="fingerprint",
)
def customer_fingerprints(t: Table) -> DataFrame:
    rows = t("customer").select(
        "c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment")
    )
    fields = ["c_name", "segment"]
    return rows.select(
        "c_custkey",
        fingerprint(fields).alias("row_sha1"),
        fingerprint(fields, "sha256").alias("row_sha256"),
    )


@query("SELECT 6 AS partitions, count(*) AS rows FROM lineitem", name="partition_balance")
def lineitem_balance(t: Table) -> DataFrame:
    """How rows lie is Spark's choice, so the report is summed up to what it must account for."""
    balance = partition_balance(t("lineitem").repartition(6))
    return balance.agg(F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("rows"))
