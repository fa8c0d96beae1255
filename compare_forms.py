"""Time each operator against the plain way of writing the same job.

For every pair both forms run on the same tables in the same session, their
results are compared, and the better of two timed runs is reported. Results
that the plain form gets wrong are noted, not compared. Usage:

    python compare_forms.py [sf_dir] [pair ...]
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

import bench
from rowforge.operators import (
    ExtremeOf,
    array_membership_join,
    band_join_avg,
    dedup_by_key,
    extreme_groups,
    flag_load_batches,
    salted_join,
    scd2_merge,
)
from rowforge.operators.scd2 import OPEN_END_TIMESTAMP
from rowforge.plans.history import FLAG, FLAG_AS_OF, customer_mart
from rowforge.plans.increments import AS_OF, _batches
from rowforge.plans.joins import _customers_and_suppliers, _documents_and_vocabulary


def scd2(t):
    """One join against: filters, detection join, semi-join, union, global sort."""
    mart, increment = customer_mart(t)
    newest = Window.partitionBy("custkey").orderBy(F.desc("ordered"), F.desc("orderkey"))
    one = increment.withColumn("n", F.row_number().over(newest)).where("n = 1")
    one = one.select("custkey", "status", "priority")

    open_rows = mart.where("is_active")
    version = F.struct("status", "priority")
    old = open_rows.select(F.col("custkey").alias("old_key"), version.alias("old_version"))
    pairs = old.join(one.withColumn("new_version", version), F.col("old_key") == F.col("custkey"), "full")
    differs = "custkey IS NOT NULL AND NOT (old_version <=> new_version)"
    changed = pairs.where(differs).select("custkey", "status", "priority")
    now = F.lit(FLAG_AS_OF).cast("timestamp_ntz")
    closed = open_rows.join(changed, "custkey", "left_semi").withColumns(
        {"effective_to_dt": now, "is_active": F.lit(False)}
    )
    opened = changed.withColumns(
        {
            "effective_from_dt": now,
            "effective_to_dt": F.lit(OPEN_END_TIMESTAMP).cast("timestamp_ntz"),
            "is_active": F.lit(True),
        }
    )
    kept = open_rows.join(changed, "custkey", "left_anti")
    plain = mart.where("NOT is_active").unionByName(kept).unionByName(closed).unionByName(opened)
    return plain.orderBy("custkey"), scd2_merge(mart, increment, FLAG, FLAG_AS_OF)


def skewed_join(t, **options):
    """Plain sort-merge join against a salted one; one key holds a third of the lines and 26 parts."""
    key = F.when(F.col("l_returnflag") == "A", 0).otherwise(F.col("l_partkey")).alias("partkey")
    lines = t("lineitem").select(key, "l_orderkey", "l_linenumber")
    parts = t("part").select(F.col("p_partkey").alias("partkey"), F.col("p_brand").alias("name"))
    parts = parts.unionByName(t("nation").select(F.lit(0).alias("partkey"), F.col("n_name").alias("name")))
    return lines.join(parts, ["partkey"]), salted_join(lines, parts, ["partkey"], **options)


def skewed_join_hot_only(t):
    return skewed_join(t, hot_share=0.05)


def band_average(t):
    """All partners joined, filtered and averaged, against partners summed first and met by cell."""
    customers, suppliers = _customers_and_suppliers(t)
    near = F.abs(F.col("c_level") - F.col("s_level")) <= 1
    pairs = customers.join(suppliers, ["nationkey"]).where(near)
    mean = F.sum("balance").cast("double") / F.count("balance")
    plain = pairs.groupBy("c_custkey").agg(mean.alias("average"))
    return plain, band_join_avg(
        customers, suppliers, ["c_custkey"], ["nationkey"], "c_level", "s_level", 1, "balance", "average"
    )


def membership(t):
    """A join condition on the array against the exploded equi-join."""
    documents, vocabulary = _documents_and_vocabulary(t)
    plain = documents.join(vocabulary, F.array_contains("words", F.col("word")))
    ours = array_membership_join(documents, vocabulary, "words", "word")
    return plain.select("doc_id", "word", "cnt"), ours.select("doc_id", "word", "cnt")


def extremes(t):
    """Four grouped, sorted and limited scans united, against one aggregate."""
    lines = t("lineitem")
    wanted = [
        ExtremeOf(kind, key, "l_linestatus", extreme)
        for kind, key in (("flag", "l_returnflag"), ("supplier", "l_suppkey"))
        for extreme in ("max", "min")
    ]

    def single(entry: ExtremeOf) -> DataFrame:
        name, greatest = F.col(entry.key).cast("string"), entry.extreme == "max"
        value = (F.max if greatest else F.min)("l_extendedprice").alias("value")
        groups = lines.groupBy(name.alias("name"), F.col("l_linestatus").alias("location")).agg(value)
        order = F.desc("value") if greatest else F.asc("value")
        top = groups.orderBy(order, "name", "location").limit(1)
        return top.select("name", F.lit(entry.kind).alias("stats_type"), "location", "value",
                          F.lit(entry.extreme).alias("value_type"))

    first, *others = [single(entry) for entry in wanted]
    for other in others:
        first = first.unionByName(other)
    return first, extreme_groups(lines, "l_extendedprice", wanted)


def load_batches(t):
    """A window gathering each day's dates against two extremes per day."""
    batches = _batches(t)
    month_end = F.last_day(F.lit(AS_OF))
    days = F.collect_set("report_dt").over(Window.partitionBy("load_day"))
    alone = F.array_contains("days", month_end) & (F.size("days") == 1)
    plain = batches.withColumn("days", days).withColumn("flag", F.when(alone, 0).otherwise(1)).drop("days")
    return plain, flag_load_batches(batches, "load_day", "report_dt", AS_OF)


def deduplicate(t):
    """A ranking window against a minimum over row structs; three keys hold all rows."""
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = t("lineitem").select("l_returnflag", *order)
    rank = F.row_number().over(Window.partitionBy("l_returnflag").orderBy(*order))
    plain = lines.withColumn("n", rank).where("n = 1").drop("n")
    return plain, dedup_by_key(lines, "l_returnflag", order, keep_null_keys=False)


PAIRS = {
    f.__name__: f
    for f in (
        scd2,
        skewed_join,
        skewed_join_hot_only,
        band_average,
        membership,
        extremes,
        load_batches,
        deduplicate,
    )
}
# Compared with broadcast joins off, as the joins at stake are between large sides.
SHUFFLED = ("skewed_join", "skewed_join_hot_only")


def same(a: DataFrame, b: DataFrame) -> bool:
    """Whether row counts and the sums of row hashes agree."""

    def summary(df: DataFrame) -> tuple:
        row = F.xxhash64(*(F.col(c) for c in sorted(a.columns))).cast("decimal(38,0)")
        return tuple(df.agg(F.count(F.lit(1)), F.sum(row)).first())

    return summary(a) == summary(b)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = bench.session("8")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for name in sys.argv[2:] or PAIRS:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1" if name in SHUFFLED else threshold)
        plain, ours = PAIRS[name](lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))
        times = [min(bench.run(df) for _ in range(2)) for df in (plain, ours)]
        agree = "equal" if same(plain, ours) else "DIFFERENT"
        print(f"{name:22} plain {times[0]:7.2f} s   rowforge {times[1]:7.2f} s   results {agree}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
