"""A corpus pipeline of five stages; each reads what the one before it wrote.

Every stage takes (spark, docs, sf_dir) and all but the last return the columns of documents.
``ORACLE_SQL`` is None: classification, retrieval and packing are not expressible in SQL, so
the tests hold the pipeline against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowforge.llm import decontaminate, linededup, neardup, packing, toxicity
from rowforge.llm.queries import MIN_SITES, TOKENS, table, tokenizer_path
from rowforge.llm.shared import written

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    model = toxicity.train(docs, toxicity.training_labels(table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).filter("toxic_pred = 0").drop("toxic_score", "toxic_pred")


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many sites share; only documents of nothing else keep them."""
    return linededup.remove_boilerplate(docs, MIN_SITES, None).drop("n_lines", "n_removed").withColumn("n_chars", F.length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    gone = neardup.near_duplicates(docs).filter("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    gone = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document left."""
    cut = packing.pieces(docs, tokenizer_path(), TOKENS)
    return packing.assign(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), TOKENS)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
