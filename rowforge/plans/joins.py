"""Basic join types, and the skew-salted, band and array-membership joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowforge.operators import (
    array_membership_join,
    band_join,
    band_join_avg,
    co_partition,
    hot_keys,
    hot_values,
    salted_join,
    word_counts,
)
from rowforge.operators.words import WORD_SEPARATOR
from rowforge.plans.registry import Table, money, query


@query(
    """
    SELECT o_orderkey, c_name, o_totalprice
    FROM orders JOIN customer ON o_custkey = c_custkey
    """
)
def join_inner(t: Table) -> DataFrame:
    orders, customer = t("orders"), t("customer")
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "inner")
    return joined.select("o_orderkey", "c_name", "o_totalprice")


def _labels_and_vectors(t: Table) -> tuple[DataFrame, DataFrame]:
    return t("labels"), t("embeddings").select("vec_id", "label")


@query(
    """
    SELECT doc_id, quality, vec_id, label FROM labels FULL JOIN embeddings ON doc_id = vec_id
    """
)
def join_full(t: Table) -> DataFrame:
    labels, vectors = _labels_and_vectors(t)
    joined = labels.join(vectors, labels["doc_id"] == vectors["vec_id"], "full")
    return joined.select("doc_id", "quality", "vec_id", "label")


@query("SELECT doc_id, quality, vec_id, label FROM labels LEFT JOIN embeddings ON doc_id = vec_id")
def join_left(t: Table) -> DataFrame:
    labels, vectors = _labels_and_vectors(t)
    joined = labels.join(vectors, labels["doc_id"] == vectors["vec_id"], "left")
    return joined.select("doc_id", "quality", "vec_id", "label")


@query("SELECT doc_id, quality, vec_id, label FROM labels RIGHT JOIN embeddings ON doc_id = vec_id")
def join_right(t: Table) -> DataFrame:
    labels, vectors = _labels_and_vectors(t)
    joined = labels.join(vectors, labels["doc_id"] == vectors["vec_id"], "right")
    return joined.select("doc_id", "quality", "vec_id", "label")


@query(
    """
    SELECT doc_id, lang, source, n_chars FROM documents
    WHERE EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id
                  AND labels.quality = CASE WHEN documents.lang = 'en' THEN 1 ELSE 0 END)
    """
)
def join_semi(t: Table) -> DataFrame:
    """Semi-join on a condition over two columns."""
    documents = t("documents").select("doc_id", "lang", "source", "n_chars")
    expected = F.when(F.col("lang") == "en", 1).otherwise(0)
    documents = documents.withColumn("expected", expected)
    labels = t("labels").withColumnsRenamed({"doc_id": "labelled"})
    same = (F.col("doc_id") == F.col("labelled")) & (F.col("expected") == F.col("quality"))
    return documents.join(labels, same, "left_semi").drop("expected")


@query(
    """
    SELECT doc_id, lang, source, n_chars FROM documents
    WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)
    """
)
def join_anti(t: Table) -> DataFrame:
    documents = t("documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(t("labels"), ["doc_id"], "left_anti")


@query("SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)")
def join_using(t: Table) -> DataFrame:
    return t("documents").select("doc_id", "lang").join(t("labels"), ["doc_id"])


@query(
    """
    SELECT o_orderpriority, count(*) AS n,
           sum(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE AS quantity
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderpriority
    """
)
def co_partitioned_join(t: Table) -> DataFrame:
    orders = t("orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderpriority")
    lines = t("lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_quantity")
    orders, lines = co_partition(orders, lines, ["orderkey"])
    return (
        orders.join(lines, ["orderkey"])
        .groupBy("o_orderpriority")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(money("l_quantity")).cast("double").alias("quantity"),
        )
    )


# Whole texts against the words of the benchmark texts.
_MEMBERS_SQL = r"""
    WITH vocabulary AS (
        SELECT word, count(*) AS cnt
        FROM (SELECT unnest(regexp_split_to_array(lower(text), '\W+')) AS word FROM benchmark)
        WHERE word <> '' AND NOT (regexp_full_match(word, '[0-9]{1,10}')
                                  AND try_cast(word AS BIGINT) <= 2147483647)
        GROUP BY word),
    members AS (
        SELECT doc_id, unnest(list_distinct(regexp_split_to_array(lower(text), '\W+'))) AS word
        FROM documents)
"""


def _documents_and_vocabulary(t: Table) -> tuple[DataFrame, DataFrame]:
    documents = t("documents").select(
        "doc_id", F.split(F.lower("text"), WORD_SEPARATOR).alias("words")
    )
    return documents, word_counts(t("benchmark"), "text")


@query(
    _MEMBERS_SQL
    + """
    SELECT doc_id, count(*) AS matched, sum(cnt)::BIGINT AS weight
    FROM members JOIN vocabulary USING (word) GROUP BY doc_id
    """,
    name="array_membership_join",
)
def vocabulary_matches(t: Table) -> DataFrame:
    documents, vocabulary = _documents_and_vocabulary(t)
    pairs = array_membership_join(documents, vocabulary, "words", "word")
    return pairs.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("matched"), F.sum("cnt").alias("weight")
    )


@query(
    _MEMBERS_SQL
    + """
    SELECT d.doc_id, coalesce(min(word), '-') AS first_word, coalesce(sum(cnt), 0)::BIGINT AS weight
    FROM documents d LEFT JOIN (SELECT * FROM members JOIN vocabulary USING (word)) m USING (doc_id)
    GROUP BY d.doc_id
    """
)
def array_membership_keep_empty(t: Table) -> DataFrame:
    documents, vocabulary = _documents_and_vocabulary(t)
    pairs = array_membership_join(documents, vocabulary, "words", "word", "left", left_id=["doc_id"])
    filled = pairs.na.fill({"word": "-", "cnt": 0})
    return filled.groupBy("doc_id").agg(
        F.min("word").alias("first_word"), F.sum("cnt").alias("weight")
    )


@query(
    """
    WITH books AS (
        SELECT l_suppkey, l_shipdate::DATE AS day, list(l_orderkey) AS orders FROM lineitem
        WHERE l_quantity >= 30 GROUP BY ALL),
    members AS (SELECT DISTINCT l_suppkey, day, unnest(orders) AS o_orderkey FROM books),
    pairs AS (SELECT l_suppkey, day, o_orderkey, o_totalprice
              FROM members FULL JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'F') USING (o_orderkey)),
    whole AS (SELECT l_suppkey, day, count(o_totalprice) AS n FROM pairs WHERE l_suppkey IS NOT NULL GROUP BY ALL)
    SELECT l_suppkey, day, o_orderkey, o_totalprice FROM pairs WHERE o_totalprice IS NOT NULL
    UNION ALL SELECT l_suppkey, day, NULL, NULL FROM whole WHERE n = 0
    """
)
def array_membership_full(t: Table) -> DataFrame:
    """Suppliers' daily lists of large orders against open orders; both keep what has no partner."""
    books = (
        t("lineitem")
        .where("l_quantity >= 30")
        .groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("day"))
        .agg(F.collect_list("l_orderkey").alias("orders"))
    )
    orders = t("orders").where("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice")
    joined = array_membership_join(
        books, orders, "orders", "o_orderkey", "full", left_id=["l_suppkey", "day"]
    )
    return joined.drop("orders")


def _customers_and_suppliers(t: Table) -> tuple[DataFrame, DataFrame]:
    customers = t("customer").select(
        "c_custkey",
        F.col("c_nationkey").alias("nationkey"),
        F.floor(F.col("c_acctbal") / 1000).alias("c_level"),
    )
    suppliers = t("supplier").select(
        "s_suppkey",
        F.col("s_nationkey").alias("nationkey"),
        F.floor(F.col("s_acctbal") / 1000).alias("s_level"),
        money("s_acctbal").alias("balance"),
    )
    return customers, suppliers


@query(
    """
    SELECT c_custkey, sum(CAST(s_acctbal AS DECIMAL(18,2)))::DOUBLE / count(*) AS avg_balance
    FROM customer JOIN supplier ON c_nationkey = s_nationkey
     AND abs(floor(c_acctbal / 1000) - floor(s_acctbal / 1000)) <= 1
    GROUP BY c_custkey
    """,
    name="band_join_avg",
)
def band_partner_average(t: Table) -> DataFrame:
    """Average balance of the suppliers of a customer's nation at most one level away."""
    customers, suppliers = _customers_and_suppliers(t)
    averages = band_join_avg(
        customers, suppliers, ["c_custkey"], ["nationkey"], "c_level", "s_level", 1, "balance", "avg_balance"
    )
    return averages.orderBy(F.desc("c_custkey"))


@query(
    """
    SELECT l_orderkey, l_linenumber, ship_day, order_day FROM (
        SELECT *, date_diff('day', DATE '1970-01-01', l_shipdate::DATE)::INTEGER AS ship_day,
               date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::INTEGER AS order_day
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    WHERE abs(ship_day - order_day) <= 30
    """,
    name="band_join",
)
def lines_shipped_near_order(t: Table) -> DataFrame:
    """Lines shipped at most 30 days from their order; both as days since 1970."""
    lines = t("lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        "l_linenumber",
        F.unix_date(F.col("l_shipdate").cast("date")).alias("ship_day"),
    )
    orders = t("orders").select(
        F.col("o_orderkey").alias("orderkey"),
        F.unix_date(F.col("o_orderdate").cast("date")).alias("order_day"),
    )
    near = band_join(lines, orders, ["orderkey"], "ship_day", "order_day", 30)
    return near.withColumnRenamed("orderkey", "l_orderkey")


@query(
    """
    SELECT p_brand, count(*) AS n, sum(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE AS quantity
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
    """,
    name="salted_join",
)
def brand_quantities(t: Table) -> DataFrame:
    lines = t("lineitem").select(F.col("l_partkey").alias("partkey"), "l_quantity")
    parts = t("part").select(F.col("p_partkey").alias("partkey"), "p_brand")
    return (
        salted_join(lines, parts, ["partkey"])
        .groupBy("p_brand")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(money("l_quantity")).cast("double").alias("quantity"),
        )
    )


@query(
    """
    SELECT doc_id, lang, texts, greatest_chars
    FROM documents JOIN (SELECT lang, count(*) AS texts, max(n_chars) AS greatest_chars
                         FROM documents GROUP BY lang) USING (lang)
    """
)
def salted_join_hot(t: Table) -> DataFrame:
    """Join on a language most rows share; only such languages are spread."""
    documents = t("documents").select("doc_id", "lang")
    languages = t("documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("texts"), F.max("n_chars").alias("greatest_chars")
    )
    return salted_join(documents, languages, ["lang"], hot_share=0.2, salt_on=["doc_id"])


@query(
    """
    SELECT lang, count(*) AS rows FROM documents GROUP BY lang
    HAVING count(*) >= 0.2 * (SELECT count(*) FROM documents)
    """,
    name="hot_keys",
)
def hot_languages(t: Table) -> DataFrame:
    return hot_keys(t("documents"), ["lang"], 0.2)


@query(
    """
    WITH fields AS (SELECT unnest(['lang', 'source']) AS field, unnest([lang, source]) AS name FROM documents)
    SELECT field, name, count(*) AS rows FROM fields WHERE name IS NOT NULL GROUP BY field, name
    HAVING count(*) >= 0.06 * (SELECT count(*) FROM documents)
    """,
    name="hot_values",
)
def hot_document_values(t: Table) -> DataFrame:
    """Languages and sources that hold at least 6 % of the documents."""
    return hot_values(t("documents"), ["lang", "source"], 0.06)
