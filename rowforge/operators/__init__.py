"""Table operators: DataFrame in, lazy DataFrame out."""

from rowforge.operators.clean import (
    cast_columns,
    clean,
    dates_after,
    dedup_by_key,
    project_filled,
    repeat_rows,
    replace_pattern,
)
from rowforge.operators.distinct import distinct_estimates, distinct_sketches, keys_with_distinct
from rowforge.operators.incremental import (
    flag_load_batches,
    late_rows,
    latest_values,
    missing_periods,
)
from rowforge.operators.joins import (
    array_membership_join,
    band_join,
    band_join_avg,
    hot_keys,
    hot_values,
    salted_join,
)
from rowforge.operators.layout import add_constants, co_partition, partition_balance, reused
from rowforge.operators.numbering import dense_row_numbers, hash_sample
from rowforge.operators.quality import QualityCounts, rule_counts, write_validated
from rowforge.operators.rules import (
    accepted,
    decode_join,
    in_range,
    quarantined,
    required,
    strong_password,
    validate,
)
from rowforge.operators.scd2 import (
    Scd2Config,
    differing_buckets,
    scd2_changes,
    scd2_closed,
    scd2_history,
    scd2_land,
    scd2_layer,
    scd2_merge,
    scd2_new,
    scd2_unchanged,
)
from rowforge.operators.stats import (
    ExtremeOf,
    count_per_key,
    extreme_groups,
    field_stats,
    most_frequent_month,
    read_quality,
    top_counts,
    with_average,
)
from rowforge.operators.words import paired_top_words, top_words, word_counts, word_ranks, words

__all__ = [
    "ExtremeOf",
    "QualityCounts",
    "Scd2Config",
    "accepted",
    "add_constants",
    "array_membership_join",
    "band_join",
    "band_join_avg",
    "cast_columns",
    "clean",
    "co_partition",
    "count_per_key",
    "dates_after",
    "decode_join",
    "dedup_by_key",
    "dense_row_numbers",
    "differing_buckets",
    "distinct_estimates",
    "distinct_sketches",
    "extreme_groups",
    "field_stats",
    "flag_load_batches",
    "hash_sample",
    "hot_keys",
    "hot_values",
    "in_range",
    "keys_with_distinct",
    "late_rows",
    "latest_values",
    "missing_periods",
    "most_frequent_month",
    "paired_top_words",
    "partition_balance",
    "project_filled",
    "quarantined",
    "read_quality",
    "repeat_rows",
    "replace_pattern",
    "required",
    "reused",
    "rule_counts",
    "salted_join",
    "scd2_changes",
    "scd2_closed",
    "scd2_history",
    "scd2_land",
    "scd2_layer",
    "scd2_merge",
    "scd2_new",
    "scd2_unchanged",
    "strong_password",
    "top_counts",
    "top_words",
    "validate",
    "with_average",
    "word_counts",
    "word_ranks",
    "words",
    "write_validated",
]
