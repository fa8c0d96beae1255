"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[BENCH_CPUS]``.
Every query is run to the last row into Spark's no-op sink, three times in a row; the
best run counts, so that a figure does not hold the first compilation of a plan.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "scd2_merge_flag",
    "scd2_merge_date",
    "scd2_merge_audit",
    "scd2_merge_small_increment",
    "scd2_changes",
    "missing_periods",
    "load_batch_flags",
    "band_join_avg",
    "band_join",
    "salted_join",
    "salted_join_hot",
    "array_membership_join",
    "array_membership_keep_empty",
    "co_partitioned_join",
    "join_inner",
    "word_counts",
    "ranked_words",
    "extreme_groups",
    "group_sum",
    "totals_per_key_rounded",
    "field_stats",
    "read_quality",
    "multi_format_dates",
    "extract_clean_dedup",
    "fill_and_drop",
    "validate_rows",
    "array_membership_full",
    "hot_values",
    "word_ranks",
    "dense_row_numbers",
    "scd2_changes_by_digest",
    "scd2_merge_nulls",
    "busy_suppliers",
    "sample_per_group",
    "rule_counts",
)
RUNS = 3


def session(cpus: str):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rowforge-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def run(df) -> float:
    """Seconds to compute every row and column of a frame."""
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def timed(query, spark, sf_dir: str) -> float:
    """Seconds to plan a query and compute its result."""
    start = time.perf_counter()
    run(query(spark, sf_dir))
    return time.perf_counter() - start


def main() -> None:
    from rowforge.plans import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    timed(QUERIES["group_count"], spark, sf_dir)
    seconds = {}
    for name in names:
        seconds[name] = round(min(timed(QUERIES[name], spark, sf_dir) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_best_of_3",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
