"""Word frequencies over whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pyspark.sql import functions as F

from rowforge.operators import dense_row_numbers, hash_sample, paired_top_words, word_counts, word_ranks
from rowforge.plans.registry import Table, query


def _counts_sql(table: str) -> str:
    return rf"""
        SELECT word, count(*) AS cnt
        FROM (SELECT unnest(regexp_split_to_array(lower(text), '\W+')) AS word FROM {table})
        WHERE word <> '' AND NOT (regexp_full_match(word, '[0-9]{{1,10}}')
                                  AND try_cast(word AS BIGINT) <= 2147483647)
        GROUP BY word
    """


def _ranked_sql(table: str) -> str:
    return f"""
        SELECT word, cnt, row_number() OVER (ORDER BY cnt DESC, word) - 1 AS id
        FROM ({_counts_sql(table)}) QUALIFY id < 20
    """


@query(_counts_sql("documents"), name="word_counts")
def document_words(t: Table) -> DataFrame:
    return word_counts(t("documents"), "text")


@query(
    f"""
    SELECT id, a.word AS w_s1, a.cnt AS cnt_s1, b.word AS w_s2, b.cnt AS cnt_s2
    FROM ({_ranked_sql('documents')}) a JOIN ({_ranked_sql('conversations')}) b USING (id)
    """
)
def ranked_words(t: Table) -> DataFrame:
    return paired_top_words(t("documents"), t("conversations"), "text")


@query(
    f"SELECT word, cnt, row_number() OVER (ORDER BY cnt DESC, word) - 1 AS id FROM ({_counts_sql('documents')})",
    name="word_ranks",
)
def document_word_ranks(t: Table) -> DataFrame:
    """The rank of every word, not only of the first ones."""
    return word_ranks(t("documents"), "text")


@query(
    """
    SELECT l_orderkey, l_linenumber,
           row_number() OVER (ORDER BY l_shipdate DESC, l_orderkey, l_linenumber) AS line_number_by_day
    FROM lineitem
    """,
    name="dense_row_numbers",
)
def line_numbers(t: Table) -> DataFrame:
    """All lines numbered from the last shipped on."""
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    order = [F.desc("l_shipdate"), F.asc("l_orderkey"), F.asc("l_linenumber")]
    return dense_row_numbers(lines, order, "line_number_by_day").drop("l_shipdate")


@query(
    """
    SELECT event_id, event_type, user_id FROM (
        SELECT event_id, event_type, user_id,
               row_number() OVER (PARTITION BY event_type ORDER BY md5('7' || event_id::VARCHAR), event_id) AS n
        FROM events) WHERE n <= 40
    """
)
def sample_per_group(t: Table) -> DataFrame:
    """Forty events of each type, the same whatever the partitioning."""
    events = t("events").select("event_id", "event_type", "user_id")
    return hash_sample(events, "event_id", 40, by=["event_type"], seed="7")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(o_custkey::VARCHAR), o_custkey, o_orderkey LIMIT 100")
def sample_by_key(t: Table) -> DataFrame:
    """A hundred orders of the customers with the least hashes."""
    orders = t("orders").select("o_custkey", "o_orderkey")
    return hash_sample(orders, "o_custkey", 100)
