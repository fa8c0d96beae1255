"""The operators applied to the whole given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowforge.llm import ann, chat, decontaminate, divergence, exactdedup, html_text, langid, linededup, neardup, packing, pii, ranked, toxicity
from rowforge.llm.shared import fold

MIN_SITES, TOKENS = 8, 2048


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents: doc_id, item_id, share of the item's words found in order."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; fold 1 of 3 is held out of learning."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(fold(F.col("doc_id"), 3) != 1))
    out = langid.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op5_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2048 tokens."""
    cut = packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path(), TOKENS)
    return packing.assign(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), TOKENS)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that at least eight sites share."""
    return linededup.remove_boilerplate(table(spark, sf_dir, "documents"), MIN_SITES)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; fold 0 of 5 is held out of learning."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, toxicity.training_labels(table(spark, sf_dir, "labels")))
    out = toxicity.score(docs, model)
    return out.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), F.col("toxic_score").alias("score"), F.col("toxic_pred").alias("predicted"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under five-word shingles and a similarity of 0.75."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, and of conversation -1, whose texts hold control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.digests(chat.format_records(chat.records_of(rows.unionByName(extra)), ready="turns"))


def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with validated personal data replaced by pseudonyms of the same format."""
    return pii.pseudonymise(table(spark, sf_dir, "documents"), "rowforge-key-1")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for every document, among texts equal but for case."""
    return exactdedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language diverge, and the terms that each uses most above it."""
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return ranked.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_nearest_neighbours, op2_main_text, op3_decontaminate, op4_language_id, op5_pattern_packing, op6_line_dedup, op7_toxicity,
        op8_chat_format, op9_near_duplicates, op10_pseudonyms, op11_exact_dedup, op12_source_divergence, op13_ranked_search,
    )
}
ORACLES = {
    "op6_line_dedup": linededup.boilerplate_sql("documents", MIN_SITES),
    "op8_chat_format": chat.DIGEST_SQL,
    "op11_exact_dedup": exactdedup.duplicates_sql("documents"),
    "op12_source_divergence": divergence.divergence_sql("documents"),
    "op13_ranked_search": ranked.ranked_sql("documents", "benchmark"),
}
