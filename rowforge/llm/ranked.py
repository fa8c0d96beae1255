"""Ranked search over whole texts, term at a time with a limit on accumulators.

Terms are runs of letters, digits and non-ASCII characters, A-Z lower-cased. The documents are
read once into a forward index of the terms that items ask for; each document then carries
its accumulators, so no posting or accumulator is ever shuffled. Terms of an item are taken rarest
first, in rounds cut where its remaining bound (the sum of the greatest scores that its other terms reach
anywhere) has fallen to fixed shares. After each round the k-th largest partial score of
each item is known. Once it exceeds the remaining bound, a document without an accumulator
cannot reach the first k any more: no new ones are made, those that cannot reach it either are
let go, and the survivors are updated exactly with all terms left. The bounds are strict,
so equal scores are never lost and the result is that of scoring every document.

Items are worked off in blocks of about ``BLOCK_PAIRS`` pairs of item and term: this bounds
what is sent to tasks and to the driver (vocabulary, frequencies and bounds of a block).

Null and empty texts have no terms: such documents are not counted, such items return nothing. Every row is
a document or an item of its own, repeated ids included; items that share an id share their ranks, so
the ids of items should be distinct. Equal scores go by ascending doc_id, null ids
last. Other columns are ignored. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowforge.llm.shared import discard, written

BLOCK_PAIRS, EXPANDED = 1_000_000, 2_000_000
SHARES = (0.6, 0.45, 0.35, 0.27, 0.2, 0.14, 0.08)
INDEX = "doc_id long, n long, terms array<int>, values array<long>, items array<int>, scores array<long>"
#: Bytes to themselves, A-Z to lower case, all that separates terms to a blank.
TERM_BYTES = bytes(c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(TERM_BYTES).split() if text else []


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Row of each value, and the values, of a list column."""
    sizes = np.diff(column.offsets.to_numpy())
    return np.repeat(np.arange(len(column)), sizes), column.flatten().to_numpy()


def _batch(ids, n, terms, values, items, scores) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids, n, terms, values, items, scores], ["doc_id", "n", "terms", "values", "items", "scores"])


def _index(vocabulary):
    """Number of terms and, for each term asked for, how often the document holds it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.value.get
        for batch in batches:
            lengths, found, counts = [], [], []
            for text in batch.column(1):
                words = terms_of(text.as_py())
                ids, tf = np.unique(np.array([i for i in map(get, words) if i is not None], np.int32), return_counts=True)
                lengths.append(len(words))
                found.append(ids)
                counts.append(tf)
            sizes = [len(x) for x in found]
            none = _lists(np.zeros(0, np.int32), np.zeros(len(sizes), np.int32), pa.int32())
            whole = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found, counts)]
            yield _batch(batch.column(0), pa.array(lengths, pa.int64()), _lists(whole[0], sizes, pa.int32()), _lists(whole[1], sizes, pa.int64()), none, none.cast(pa.list_(pa.int64())))

    return read


def _frequencies(size: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at])], ["term", "df"])

    return count


def _priced(weights, docs: int, total: int):
    """Frequencies in documents turned into scores."""

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(1).to_numpy()
            m = 10 + (90 * n * docs) // max(total, 1)
            row, term = _flat(batch.column(2))
            tf = batch.column(3).flatten().to_numpy()
            score = weights.value[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            yield _batch(batch.column(0), batch.column(1), batch.column(2), _lists(score, sizes, pa.int64()), batch.column(4), batch.column(5))

    return price


def _greatest(size: int):
    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros(size, np.int64)
        for batch in batches:
            np.maximum.at(best, batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy())
        at = np.flatnonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(best[at])], ["term", "bound"])

    return top


def _slices(batch: pa.RecordBatch, many: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose postings meet at most about ``EXPANDED`` items, one row at least."""
    row, term = _flat(batch.column(2))
    done = np.cumsum(np.bincount(row, weights=many[term], minlength=batch.num_rows)) // EXPANDED
    cuts = [0, *(np.flatnonzero(np.diff(done)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def _spread(starts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each chosen row of a table of lists: its position among the chosen, and the places of its entries."""
    times = starts[chosen + 1] - starts[chosen]
    before = np.cumsum(times) - times
    return np.repeat(np.arange(len(chosen)), times), np.repeat(starts[chosen] - before, times) + np.arange(times.sum())


def _advanced(plan):
    """Accumulators of each document after one more round of every item's terms.

    ``plan`` holds, for this round, the open items of each term, the terms of each closed item, and the
    partial score below which each item lets a document go. Postings look for open items and may
    create accumulators; accumulators of closed items look for their postings.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, of, item_starts, terms_of_item, opened, floor = plan.value
        many, width, size = np.diff(starts), len(opened), len(starts) - 1
        for batch in (piece for whole in batches for piece in _slices(whole, many)):
            row, item = _flat(batch.column(4))
            held = batch.column(5).flatten().to_numpy()
            keep = held >= floor[item]
            row, item, held = row[keep], item[keep], held[keep]
            at, term = _flat(batch.column(2))
            score = batch.column(3).flatten().to_numpy()
            pair, entry = _spread(item_starts, item)
            sought, postings = row[pair] * size + terms_of_item[entry], at * size + term
            place = np.minimum(np.searchsorted(postings, sought), max(len(postings) - 1, 0))
            hit = postings[place] == sought if len(postings) else np.zeros(len(sought), bool)
            held = held.copy()
            np.add.at(held, pair[hit], score[place[hit]])
            posting, entry = _spread(starts, term)
            keys, where = np.unique(np.concatenate([row * width + item, at[posting] * width + of[entry]]), return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, where, np.concatenate([held, score[posting]]))
            sizes = np.bincount(keys // width, minlength=batch.num_rows)
            yield _batch(*(batch.column(k) for k in range(4)), _lists((keys % width).astype(np.int32), sizes, pa.int32()), _lists(total, sizes, pa.int64()))

    return step


def _grouped(pairs: list[tuple[int, int]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and values of the lists that the pairs make by their first number."""
    pairs = np.array(sorted(pairs), np.int64).reshape(-1, 2)
    return np.searchsorted(pairs[:, 0], np.arange(size + 1)), pairs[:, 1]


def _leaders(k: int, least):
    """Of each item the k best partial scores of a task, those below ``least`` left out; ties by id, null ids last."""

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = least.value
        items, scores, docs, blank = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        for batch in batches:
            row, item = _flat(batch.column(1))
            score = batch.column(2).flatten().to_numpy()
            take = (score > 0) & (score >= floor[item])
            doc, null = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False)
            items, scores = np.concatenate([items, item[take]]), np.concatenate([scores, score[take]])
            docs, blank = np.concatenate([docs, doc[row[take]]]), np.concatenate([blank, null[row[take]]])
            order = np.lexsort((docs, blank, -scores, items))
            items, scores, docs, blank = items[order], scores[order], docs[order], blank[order]
            first = np.searchsorted(items, items)
            best = np.arange(len(items)) - first < k
            items, scores, docs, blank = items[best], scores[best], docs[best], blank[best]
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int32()), pa.array(scores), pa.array(docs, mask=blank)], ["item", "score", "doc_id"])

    return lead


def _rounds(items: list[list[int]], df: np.ndarray, bound: np.ndarray) -> tuple[list[list[list[int]]], np.ndarray]:
    """The terms of each item, rarest first, cut into rounds; and each item's bound after each round."""
    cut = [[[] for _ in items] for _ in range(len(SHARES) + 1)]
    left = np.zeros((len(SHARES) + 1, len(items)), np.int64)
    for i, terms in enumerate(items):
        terms = sorted((t for t in terms if bound[t] > 0), key=lambda t: (df[t], t))
        whole = rest = int(sum(bound[t] for t in terms))
        at = 0
        for r, share in enumerate((*SHARES, 0.0)):
            while at < len(terms) and rest > share * whole:
                cut[r][i].append(terms[at])
                rest -= int(bound[terms[at]])
                at += 1
            left[r, i] = rest
    return cut, left


def _search_block(docs: DataFrame, block: DataFrame, k: int) -> DataFrame:
    """_item (number in the block), doc_id, score: the best k documents of every task, exactly scored."""
    spark = docs.sparkSession
    pairs = block.toArrow().to_pydict()
    numbers = {u: i for i, u in enumerate(pairs["_uid"])}
    vocabulary = {t: i for i, t in enumerate(sorted({t for terms in pairs["_terms"] for t in terms}))}
    items = [[vocabulary[t] for t in terms] for terms in pairs["_terms"]]
    size, send = len(vocabulary), spark.sparkContext.broadcast
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    held = written(read.mapInArrow(_index(send(vocabulary)), INDEX), "ranked-index")
    n_docs, total = held.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(size, np.int64)
    for term, n in held.select("terms").mapInArrow(_frequencies(size), "term int, df long").groupBy("term").agg(F.sum("df")).collect():
        df[term] = n
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    priced = written(held.mapInArrow(_priced(send(weights), n_docs, total), INDEX), "ranked-index")
    discard(held)
    bound = np.zeros(size, np.int64)
    for term, n in priced.select("terms", "values").mapInArrow(_greatest(size), "term int, bound long").groupBy("term").agg(F.max("bound")).collect():
        bound[term] = n
    cut, left = _rounds(items, df, bound)
    kth, opened, floor = np.zeros(len(items), np.int64), np.ones(len(items), bool), np.zeros(len(items), np.int64)
    held = priced
    best = Window.partitionBy("item").orderBy(F.desc("score"))
    for r, terms in enumerate(cut):
        creating = _grouped([(t, i) for i, ts in enumerate(terms) if opened[i] for t in ts], size)
        updating = _grouped([(i, t) for i, ts in enumerate(terms) if not opened[i] for t in ts], len(items))
        plan = send((*creating, *updating, opened.copy(), floor.copy()))
        after = written(held.mapInArrow(_advanced(plan), INDEX), "ranked-scores")
        discard(held)
        held = after
        leaders = held.select("doc_id", "items", "scores").mapInArrow(_leaders(k, send(kth.copy())), "item int, score long, doc_id long")
        if r == len(cut) - 1:
            break
        ranked = leaders.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k)
        for item, score in ranked.select("item", "score").collect():
            kth[item] = max(kth[item], score)
        opened, floor = left[r] >= kth, np.maximum(kth - left[r], 0)
    by_number = spark.createDataFrame(list(zip(numbers.values(), numbers.keys(), strict=True)), "item int, _uid long")
    return leaders.join(by_number, "item").select("_uid", "doc_id", "score")


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [sorted(set(terms_of(t.as_py()))) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.binary())), pa.array([len(t) for t in terms], pa.int64())], ["item_id", "_terms", "_n"])


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, *, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents (doc_id, text) of each item (item_id, text)."""
    kind = items.schema["item_id"].dataType.simpleString()
    asked = items.select("item_id", F.col("text").cast("binary").alias("text")).mapInArrow(_query_terms, f"item_id {kind}, _terms array<binary>, _n long")
    asked = written(asked.filter("_n > 0").withColumn("_uid", F.monotonically_increasing_id()), "ranked-items")
    pairs = asked.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    blocks = -(-pairs // block_pairs)
    found = None
    for b in range(blocks):
        block = asked.filter(F.pmod(F.xxhash64("_uid"), F.lit(blocks)) == b)
        hits = _search_block(docs, block.select("_uid", "_terms"), k) if blocks == 1 or not block.isEmpty() else None
        found = hits if found is None else found if hits is None else found.unionByName(hits)
    if found is None:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    order = Window.partitionBy("_uid").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(asked.select("_uid", "item_id"), "_uid").select("item_id", "rank", "doc_id", "score")


def ranked_sql(docs: str, items: str, k: int = 10) -> str:
    """The same ranking in SQL by scoring every document, over views with doc_id and item_id, and text."""
    letters = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    terms = rf"regexp_extract_all({letters}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
    WITH d AS (SELECT doc_id, unnest({terms}) AS term FROM {docs}),
    lengths AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
    total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
    tfs AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
    weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, total GROUP BY term, docs),
    asked AS (SELECT DISTINCT item_id, unnest({terms}) AS term FROM {items}),
    scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + ((90 * n * docs) // terms)))))::BIGINT AS score
               FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), total GROUP BY item_id, doc_id)
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= {k}"""
