"""How far the sources of a language diverge in their words, by one-hot products of count levels.

Terms are runs of letters and non-ASCII characters, A-Z lower-cased. Each language keeps the terms that
at least ``MIN_DOCS`` of its documents hold. A source's probability of a term depends only
on its count of it, the level. So each block of terms becomes an indicator matrix with a row for each term and
a column for each (source, level), and the product of its transpose with itself is, for every two sources at
once, the table of how many terms lie on each pair of levels: whole numbers, held exactly. ``joint_tables``
returns these tables; ``divergence`` prices each entry by the distance of the two probabilities and sums.

Terms are dealt into blocks by their total, so that a block has few levels, and sources into blocks of
``GROUPS``; any two blocks of sources meet in one task for each block of terms. Nothing is held
for a whole language. Counts are combined by term in the tasks that read the texts, then on the map side.

Null text, language and source count as empty text; empty texts hold no terms, but their group occurs. Every
row is a document, repeated ids included. Equal values are ranked by item in the order of UTF-8 bytes. A language that keeps
no term has distances of 0. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowforge.llm.shared import written

MIN_DOCS, TOP, SCALE, PRIOR = 30, 50, 1_000_000_000, 5
GROUPS, COLUMNS, FLUSH = 32, 2048, 300_000
#: A-Z to lower case, a-z and all bytes of other alphabets to themselves, the rest to blanks.
LETTER_BYTES = bytes(c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term in each group, combined until ``FLUSH`` terms are held."""
    said: dict[tuple[str, str], Counter] = {}
    held: dict[tuple[str, str], Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        while said:
            (lang, source), counts = said.popitem()
            docs = held.pop((lang, source))
            n = len(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64()), pa.array(map(docs.__getitem__, counts), pa.int64())],
                ["lang", "source", "term", "n", "docs"],
            )

    for batch in batches:
        for lang, source, text in zip(*(batch.column(k) for k in range(3)), strict=True):
            group = lang.as_py(), source.as_py()
            words = text.as_py().translate(LETTER_BYTES).split()
            said.setdefault(group, Counter()).update(words)
            held.setdefault(group, Counter()).update(set(words))
            if len(words) > FLUSH:
                yield from flush()
        if sum(map(len, said.values())) > FLUSH:
            yield from flush()
    yield from flush()


def _joint(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The product of a block: joint counts of columns, and each column's group, level and price.

    Rows without a term tell the groups of the block and the price of level 0.
    """
    blank = frame["term"].isna()
    groups = frame[blank].sort_values("gid")
    gids, sources = groups["gid"].to_numpy(np.int64), groups["source"].to_numpy()
    cells = frame[~blank]
    term, names = pd.factorize(cells["term"])
    at = np.searchsorted(gids, cells["gid"].to_numpy(np.int64))
    # terms of the block that none of these groups holds are one more row, of level 0 and that weight
    absent = int(groups["size"].iloc[0]) - len(names)
    rows = len(names) + (absent > 0)
    weight = np.array([1] * len(names) + [absent] * (absent > 0), np.float32)
    level = np.zeros((rows, len(gids)), np.int64)
    price = np.tile(groups["p"].to_numpy(np.int64), (rows, 1))
    level[term, at], price[term, at] = cells["n"], cells["p"]
    starts, levels, prices, column = [0], [], [], np.empty(level.shape, np.int64)
    for g in range(len(gids)):
        found, first, where = np.unique(level[:, g], return_index=True, return_inverse=True)
        column[:, g] = starts[-1] + where
        starts.append(starts[-1] + len(found))
        levels.append(found)
        prices.append(price[first, g])
    marks = np.zeros((rows, starts[-1]), np.float32)  # whole numbers below 2^24 are exact
    marks[np.arange(rows)[:, None], column] = 1
    joint = (marks.T @ (marks * weight[:, None])).astype(np.int64)
    return joint, gids, sources, np.array(starts), np.concatenate(levels), np.concatenate(prices)


def _pairs(frame: pd.DataFrame, gids: np.ndarray) -> np.ndarray:
    """Which pairs of groups this task answers for: those of its two blocks of groups, each pair once."""
    block = gids // GROUPS
    i, j = int(frame["bi"].iloc[0]), int(frame["bj"].iloc[0])
    return (block[:, None] == i) & (block[None, :] == j) | (block[:, None] == j) & (block[None, :] == i)


def _priced(frame: pd.DataFrame) -> pd.DataFrame:
    lang = frame["lang"].iloc[0]
    if not frame["size"].max():
        gids, sources = (frame.sort_values("gid")[c].to_numpy() for c in ("gid", "source"))
        sums = np.zeros((len(gids), len(gids)), np.int64)
    else:
        joint, gids, sources, starts, _, price = _joint(frame)
        value = joint * np.abs(price[:, None] - price[None, :])
        sums = np.add.reduceat(np.add.reduceat(value, starts[:-1], 0), starts[:-1], 1)
    wanted = _pairs(frame, gids) & ~np.eye(len(gids), dtype=bool)
    a, b = np.nonzero(wanted)
    return pd.DataFrame({"lang": lang, "source": sources[a], "item": sources[b], "value": sums[a, b]})


def _tables(frame: pd.DataFrame) -> pd.DataFrame:
    names = ["lang", "source", "level", "other", "other_level", "terms"]
    if not frame["size"].max():
        return pd.DataFrame([], columns=names)
    joint, gids, sources, starts, level, _ = _joint(frame)
    group = np.repeat(np.arange(len(gids)), np.diff(starts))
    a, b = np.nonzero((joint > 0) & _pairs(frame, gids)[group][:, group] & (group[:, None] != group[None, :]))
    return pd.DataFrame(dict(zip(names, (frame["lang"].iloc[0], sources[group[a]], level[a], sources[group[b]], level[b], joint[a, b]), strict=True)))


def _price(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * kept)) in exact decimals; 1 where nothing is kept."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (n + PRIOR).cast("decimal(20,0)")
    under = (total + PRIOR * kept).cast("decimal(20,0)")
    whole = (top - top % F.when(under > 0, under)) / under
    return F.coalesce(whole.cast("long") + 1, F.lit(1).cast("long"))


class Levels:
    """The counts of all groups, written once: cells of kept terms with their prices, groups, and languages."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS):
        blank = F.lit("")
        base = docs.select(F.coalesce("lang", blank).alias("lang"), F.coalesce("source", blank).alias("source"), F.coalesce("text", blank).cast("binary").alias("text"))
        counted = base.mapInArrow(_count, "lang string, source string, term binary, n long, docs long")
        counts = written(counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "levels-counts")
        terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
        octave = F.floor(F.log2("total")).cast("int").alias("octave")
        terms = written(terms.select("lang", "term", "total", octave), "levels-terms")
        cells = written(counts.select("lang", "term", "source", "n").join(terms, ["lang", "term"]), "levels-cells")
        langs = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("all"))
        sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("sum"))
        groups = base.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
        gid = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
        zero = F.lit(0).cast("long")
        self.groups = written(
            groups.select("lang", "source", gid.cast("long").alias("gid"), *(F.coalesce(c, zero).alias(c) for c in ("sum", "kept", "all"))), "levels-groups"
        )
        self.terms, self.cells = terms, cells

    def blocks(self) -> DataFrame:
        """Cells and groups of every (block of terms, two blocks of groups): the rows of one product."""
        many = self.groups.groupBy("lang").agg((F.max("gid") + 1).alias("many"))
        side = F.least("many", F.lit(GROUPS).cast("long"))
        rows = F.greatest(F.lit(16).cast("long"), F.floor(F.lit(COLUMNS) / side))
        sizes = self.terms.groupBy("lang", "octave").agg(F.count("*").alias("n")).join(many, "lang")
        sizes = sizes.select("lang", "octave", F.ceil(F.col("n") / rows).alias("slices"))
        slice_of = F.pmod(F.xxhash64("term"), "slices").alias("slice")
        every = self.terms.join(sizes, ["lang", "octave"]).groupBy("lang", "octave", slice_of).agg(F.count("*").alias("size"))
        # a language without kept terms still has its groups
        none = F.lit(0).cast("long")
        bare = many.join(sizes, "lang", "left_anti").select("lang", F.lit(-1).alias("octave"), none.alias("slice"), none.alias("size"))
        places = every.unionByName(bare)
        own = F.floor(F.col("gid") / GROUPS)
        last = F.floor((F.col("many") - 1) / GROUPS)
        # block b meets every block x: (x, b) below it, (b, x) from it on
        meet = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), last), lambda x: F.struct(F.least(x, own).alias("bi"), F.greatest(x, own).alias("bj"))))
        groups = self.groups.join(many, "lang")
        price = _price(F.coalesce("n", F.lit(0).cast("long")), F.col("sum"), F.col("kept")).alias("p")
        head = groups.join(places, "lang").withColumn("n", F.lit(0).cast("long")).withColumn("term", F.lit(None).cast("binary"))
        body = self.cells.join(groups, ["lang", "source"]).join(sizes, ["lang", "octave"])
        body = body.withColumn("slice", slice_of).withColumn("size", F.lit(None).cast("long"))
        kept = ("lang", "octave", "slice", "size", "term", "source", "gid", "n", price, meet.alias("_meet"))
        return head.select(*kept).unionByName(body.select(*kept)).select("*", "_meet.*").drop("_meet")


BLOCK = ("lang", "octave", "slice", "bi", "bj")


def joint_tables(levels: Levels) -> DataFrame:
    """lang, source, level, other, other_level, terms: how many kept terms lie on each pair of levels, every pair of sources both ways."""
    kind = "lang string, source string, level long, other string, other_level long, terms long"
    part = levels.blocks().groupBy(*BLOCK).applyInPandas(_tables, kind)
    return part.groupBy("lang", "source", "level", "other", "other_level").agg(F.sum("terms").alias("terms"))


def distances(levels: Levels) -> DataFrame:
    """lang, source, item, value: the summed distance of two sources' probabilities, every pair both ways."""
    part = levels.blocks().groupBy(*BLOCK).applyInPandas(_priced, "lang string, source string, item string, value long")
    return part.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def excesses(levels: Levels, top: int = TOP) -> DataFrame:
    """lang, source, item, value, rank: the terms that a source uses most above its language, ``top`` of each."""
    cells = levels.cells.join(levels.groups, ["lang", "source"])
    over = _price(F.col("n"), F.col("sum"), F.col("kept")) - _price(F.col("total"), F.col("all"), F.col("kept"))
    found = cells.select("lang", "source", F.col("term").cast("string").alias("item"), over.alias("value")).filter("value > 0")
    return _ranked(found).filter(F.col("rank") <= top)


def _ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return found.withColumn("rank", F.row_number().over(order))


def divergence(docs: DataFrame, *, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank for every group of ``docs`` (text, lang, source)."""
    levels = Levels(docs, min_docs)
    parts = (("pair", _ranked(distances(levels))), ("term", excesses(levels, top)))
    pair, term = (f.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, f in parts)
    return pair.unionByName(term)


def divergence_sql(table: str, min_docs: int = MIN_DOCS, top: int = TOP) -> str:
    """The same audit in SQL, over a view with text, lang and source."""
    letters = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    p = "1 + ({scale} * ({n} + {prior})) // ({total} + {prior} * kept)"
    own, whole = (p.format(scale=f"{SCALE}::HUGEINT", prior=PRIOR, n=n, total=t) for n, t in (("n", "total"), ("all_n", "all_total")))
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                      regexp_extract_all({letters}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM {table}),
    w AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
    vocabulary AS (SELECT lang, term, count(*) AS all_n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {min_docs}),
    langs AS (SELECT lang, count(*) AS kept, sum(all_n) AS all_total FROM vocabulary GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM d),
    counts AS (SELECT g.lang, g.source, v.term, v.all_n, coalesce(c.n, 0) AS n FROM groups g JOIN vocabulary v USING (lang)
               LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL) c USING (lang, source, term)),
    totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source),
    priced AS (SELECT lang, source, term, n, {own} AS p, {whole} AS q FROM counts JOIN totals USING (lang, source) JOIN langs USING (lang)),
    sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
             FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
              FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
    words AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM priced WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM words) QUALIFY part = 'pair' OR rank <= {top}"""
