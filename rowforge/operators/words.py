"""Word frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowforge.functions.numbers import parse_integer
from rowforge.operators.numbering import dense_row_numbers

# What separates words, and how many top words are ranked.
WORD_SEPARATOR = r"\W+"
TOP_WORDS = 20


def words(df: DataFrame, text: str, word: str = "word") -> DataFrame:
    """One row per lower-cased word; empty tokens and integers are left out."""
    tokens = df.select(F.explode(F.split(F.lower(F.col(text)), WORD_SEPARATOR)).alias(word))
    return tokens.where((F.col(word) != "") & parse_integer(word).isNull())


def word_counts(df: DataFrame, text: str, word: str = "word", count: str = "cnt") -> DataFrame:
    return words(df, text, word).groupBy(word).agg(F.count(F.lit(1)).alias(count))


def top_words(
    df: DataFrame, text: str, word: str = "word", count: str = "cnt", k: int = TOP_WORDS
) -> DataFrame:
    """The ``k`` most frequent words with their rank ``id`` from 0, ties by word.

    The rank window has no partition, but runs over the ``k`` rows left by the
    limit only.
    """
    order = [F.desc(count), F.asc(word)]
    top = word_counts(df, text, word, count).orderBy(*order).limit(k)
    rank = F.row_number().over(Window.orderBy(*order)) - 1
    return top.select(rank.cast("long").alias("id"), word, count)


def word_ranks(df: DataFrame, text: str, word: str = "word", count: str = "cnt") -> DataFrame:
    """Every word with its rank ``id`` from 0, most frequent first, ties by word."""
    counted = word_counts(df, text, word, count)
    return dense_row_numbers(counted, [F.desc(count), F.asc(word)], "id", start=0)


def paired_top_words(first: DataFrame, second: DataFrame, text: str, k: int = TOP_WORDS) -> DataFrame:
    """Top words of two corpora side by side, joined on rank."""
    left = top_words(first, text, "w_s1", "cnt_s1", k)
    return left.join(top_words(second, text, "w_s2", "cnt_s2", k), ["id"])
