"""Exact duplicates found by an index of cuckoo filters over live digests.

Texts are equal when they agree after lower-casing A-Z only. An index holds every live row with
its content, and one cuckoo filter for each shard of the digests: buckets of four 16-bit
fingerprints, so a digest can be inserted, sought and deleted again. Rows that arrive are
combined by digest on the map side (at most ``SLICES`` arrivals a digest, however many copies
there are) and meet the filter of their shard. An arrival that the filter does not know is new: its content
is never looked at again. One that it seems to know is a hit, and so is an arrival of several rows; the contents
of the digests hit are compared in full, so neither equal fingerprints nor equal digests can
merge different texts. A filter that overflows is rebuilt from the stored keys of its shard with
twice the buckets; ``reshard`` rebuilds all of them when shards have grown too large.

Null text counts as empty, and empty texts are equal. Of equal texts the row with the largest id
stays; null ids are smaller than all others, and of rows that also share the id one stays. Rows with one id and
different texts are different rows. Repeated rows come back as often as they were given. Other
columns are ignored, whatever their names. An empty table gives an empty index and an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowforge.llm.shared import discard, sliced, written

SLOTS, KICKS, SLICES, PER_SHARD = 4, 200, 16, 8192
EXPLODE, SENT = 1 << 16, 1 << 20
STEP = "shard long, kind string, key binary, log2 int, live long, slots binary"
ARRIVED, HIT, BLOCK, OVERFLOW = "new", "hit", "block", "overflow"


class CuckooFilter:
    """Fingerprints of keys in buckets of four; each key has two buckets, each found from the other."""

    def __init__(self, log2: int, slots: bytes | None = None, live: int = 0):
        import array

        self.log2, self.live, self.mask = log2, live, (1 << log2) - 1
        self.slots = array.array("H", slots or bytes(2 * SLOTS << log2))

    def _places(self, key: bytes) -> tuple[int, int, int]:
        import xxhash

        x = xxhash.xxh3_64_intdigest(key)
        mark = (x >> 48) or 1
        first = x & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995) & self.mask)

    def _slot(self, bucket: int, mark: int) -> int:
        """Where the bucket holds this fingerprint (0: where it is free), or -1."""
        for at in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
            if self.slots[at] == mark:
                return at
        return -1

    def __contains__(self, key: bytes) -> bool:
        mark, a, b = self._places(key)
        return self._slot(a, mark) >= 0 or self._slot(b, mark) >= 0

    def add(self, key: bytes) -> bool:
        """Whether the key found room; without room the filter is spoilt and must be rebuilt."""
        mark, a, b = self._places(key)
        self.live += 1
        bucket = a
        for kick in range(KICKS):
            for bucket in (a, b) if not kick else (bucket,):
                at = self._slot(bucket, 0)
                if at >= 0:
                    self.slots[at] = mark
                    return True
            at = SLOTS * bucket + (kick + mark) % SLOTS
            mark, self.slots[at] = self.slots[at], mark
            bucket = self._other(bucket, mark)
        return False

    def remove(self, key: bytes) -> bool:
        """Forget a key that was added."""
        mark, a, b = self._places(key)
        at = max(self._slot(a, mark), self._slot(b, mark))
        if at < 0:
            return False
        self.slots[at] = 0
        self.live -= 1
        return True

    @classmethod
    def of(cls, keys: list[bytes], log2: int) -> CuckooFilter:
        """A filter of these keys with at least 2^log2 buckets."""
        while True:
            made = cls(log2)
            if all(map(made.add, keys)):
                return made
            log2 += 1


@dataclass(frozen=True)
class DedupIndex:
    """Live rows with their content, the filters of all shards, and the keys that were ever hit."""

    shards: int
    key_bytes: int
    rows: DataFrame
    filters: DataFrame
    repeated: DataFrame


def _digests(key_bytes: int):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in sliced([(t or b"").lower() for t in batch.column(1).to_pylist()], 1 << 22):
                shas = [hashlib.sha256(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(texts)), pa.array([s.digest()[:key_bytes] for s in shas], pa.binary()), pa.array([s.hexdigest() for s in shas]), pa.array(texts, pa.binary())],
                    ["doc_id", "key", "text_sha256", "content"],
                )
                done += len(texts)

    return digest


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")


def _keyed(docs: DataFrame, index_shards: int, key_bytes: int) -> DataFrame:
    base = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    found = base.mapInArrow(_digests(key_bytes), f"doc_id {kind}, key binary, text_sha256 string, content binary")
    return found.select(_shard(index_shards), "key", "doc_id", "text_sha256", "content")


def _frame(shard: int, rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame([(shard, *r) for r in rows], columns=["shard", "kind", "key", "log2", "live", "slots"], dtype=object)


def _stored(frame: pd.DataFrame, log2: int) -> CuckooFilter:
    return CuckooFilter(int(frame["log2"][0]), bytes(frame["slots"][0]), int(frame["live"][0])) if len(frame) else CuckooFilter(log2)


def _inserted(log2: int):
    """Arrivals of a shard, largest ids first, against its filter: new or hit, and the filter after them."""

    def step(arrivals: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        source = arrivals if len(arrivals) else block
        shard, known, out = int(source["shard"][0]), _stored(block, log2), []
        arrivals = arrivals.sort_values("top", ascending=False, kind="stable", na_position="last")
        for key, n in zip(arrivals["key"], arrivals["n"], strict=True):
            key = bytes(key)
            if key in known:
                out.append((HIT, key, None, None, None))
                continue
            if not known.add(key):
                return _frame(shard, [(OVERFLOW, None, known.log2, None, None)])
            out.append((HIT if n > 1 else ARRIVED, key, None, None, None))
        return _frame(shard, [*out, (BLOCK, None, known.log2, known.live, known.slots.tobytes())])

    return step


def _forgotten(dead: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
    """The filter of a shard without its dead keys."""
    known = _stored(block, 0)
    for key in dead["key"]:
        known.remove(bytes(key))
    return _frame(int(block["shard"][0]), [(BLOCK, None, known.log2, known.live, known.slots.tobytes())]) if len(block) else _frame(0, [])


def _rebuilt(keys: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
    """The filter of a shard from its stored keys, with at least the buckets wanted."""
    if not len(wanted):
        return _frame(0, [])
    made = CuckooFilter.of([bytes(k) for k in keys["key"]], int(wanted["log2"][0]))
    return _frame(int(wanted["shard"][0]), [(BLOCK, None, made.log2, made.live, made.slots.tobytes())])


def _blocks(stepped: DataFrame) -> DataFrame:
    return stepped.filter(F.col("kind") == BLOCK).select("shard", "log2", "live", "slots")


def _by_shard(left: DataFrame, right: DataFrame, step) -> DataFrame:
    return left.groupBy("shard").cogroup(right.groupBy("shard")).applyInPandas(step, STEP)


def create(spark: SparkSession, like: DataFrame, expected_rows: int, *, per_shard: int = PER_SHARD, key_bytes: int = 32) -> DedupIndex:
    """An empty index for documents shaped ``like``, dealt into shards of about ``per_shard`` rows.

    ``key_bytes`` shortens digests, at most 32; results stay the same, as contents decide.
    """
    shards = max(1, -(-expected_rows // per_shard))
    rows = _keyed(like.limit(0), shards, key_bytes)
    return DedupIndex(shards, key_bytes, spark.createDataFrame([], rows.schema), spark.createDataFrame([], "shard long, log2 int, live long, slots binary"), spark.createDataFrame([], "key binary"))


def insert(index: DedupIndex, docs: DataFrame, *, log2: int = 10) -> DedupIndex:
    """The index with all rows of ``docs`` (doc_id, text); new filters start with 2^log2 buckets."""
    rows = written(_keyed(docs, index.shards, index.key_bytes), "dedup-rows")
    slices = F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)).alias("slice")
    arrivals = written(rows.groupBy("shard", "key", slices).agg(F.max("doc_id").alias("top"), F.count("*").alias("n")), "dedup-arrivals")
    pending, blocks, steps = arrivals, index.filters, []
    while True:
        stepped = written(_by_shard(pending.select("shard", "key", "top", "n"), blocks, _inserted(log2)), "dedup-step")
        steps.append(stepped)
        full = stepped.filter(F.col("kind") == OVERFLOW).select("shard", (F.col("log2") + 1).alias("log2"))
        if full.isEmpty():
            break
        keys = index.rows.select("shard", "key").join(full.select("shard"), "shard", "left_semi").distinct()
        blocks = written(_blocks(_by_shard(keys, full, _rebuilt)), "dedup-filters")
        pending = pending.join(full.select("shard"), "shard", "left_semi")
    every = steps[0]
    for more in steps[1:]:
        every = every.unionByName(more)
    # a shard without arrivals stepped too, as the cogroup holds its old filter
    filters = written(_blocks(every), "dedup-filters")
    hits = every.filter(F.col("kind") == HIT).select("key")
    repeated = written(index.repeated.unionByName(hits).distinct(), "dedup-repeated")
    for table in (*steps, arrivals):
        discard(table)
    return replace(index, rows=index.rows.unionByName(rows), filters=filters, repeated=repeated)


def delete(index: DedupIndex, docs: DataFrame) -> DedupIndex:
    """The index without the rows of ``docs`` (doc_id, text): all rows with that id and an equal text.

    Rows that the index does not hold change nothing. A digest leaves its filter with its last row.
    """
    gone = _keyed(docs, index.shards, index.key_bytes).select("key", F.col("doc_id").alias("_id"), F.col("content").alias("_content"))
    same = (F.col("rows.key") == F.col("gone.key")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("content") == F.col("_content"))
    left = written(index.rows.alias("rows").join(gone.alias("gone"), same, "left_anti"), "dedup-rows")
    before, after = (r.select("shard", "key").distinct() for r in (index.rows, left))
    dead = before.join(after.select("key"), "key", "left_anti").select("shard", "key")
    filters = written(_blocks(_by_shard(dead, index.filters, _forgotten)), "dedup-filters")
    return replace(index, rows=left, filters=filters)


def reshard(index: DedupIndex, shards: int, *, log2: int = 10) -> DedupIndex:
    """The index dealt into another number of shards, all filters rebuilt from the stored keys."""
    rows = index.rows.withColumn("shard", _shard(shards))
    keys = rows.select("shard", "key").distinct()
    wanted = keys.select("shard").distinct().withColumn("log2", F.lit(log2))
    filters = written(_blocks(_by_shard(keys, wanted, _rebuilt)), "dedup-filters")
    return replace(index, shards=shards, rows=rows, filters=filters)


def contains(index: DedupIndex, docs: DataFrame) -> DataFrame:
    """doc_id and ``found`` for each row of ``docs``: whether a live row has an equal text."""
    asked = written(_keyed(docs, index.shards, index.key_bytes), "dedup-asked")

    def look(questions: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        known = _stored(block, 0)
        rows = [(HIT, bytes(k), None, None, None) for k in questions["key"] if len(block) and bytes(k) in known]
        return _frame(int(questions["shard"][0]) if len(questions) else 0, rows)

    maybe = written(_by_shard(asked.select("shard", "key").distinct(), index.filters, look).select("key"), "dedup-maybe")
    live = _under(index.rows, maybe).select("key", "content").distinct().withColumn("found", F.lit(True))
    sought = asked.join(maybe, "key", "left_semi").select("key", "content").distinct()
    # equal contents, not equal digests, make an answer
    verified = sought.join(live, ["key", "content"]).select(F.col("key").alias("_key"), F.sha2("content", 256).alias("_sha"), "found")
    out = asked.select("doc_id", "key", "text_sha256").join(verified, (F.col("key") == F.col("_key")) & (F.col("text_sha256") == F.col("_sha")), "left")
    return out.select("doc_id", F.coalesce("found", F.lit(False)).alias("found"))


def _under(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key is among ``keys``, and perhaps a few whose key only has an equal hash.

    Up to ``SENT`` hashes are sent to all tasks, so that contents do not travel; beyond, they are joined.
    """
    hashes = keys.select(F.xxhash64("key").alias("_hash")).distinct()
    hashes = F.broadcast(hashes) if keys.count() <= SENT else hashes
    return rows.withColumn("_hash", F.xxhash64("key")).join(hashes, "_hash", "left_semi").drop("_hash")


def groups(index: DedupIndex) -> DataFrame:
    """Every live row: doc_id, keep_id, group_size, kept, text_sha256.

    Only contents under keys that were hit are read; equal ones are combined before they travel.
    """
    def classes(keys: DataFrame) -> DataFrame:
        return _under(index.rows, keys).groupBy("key", "content").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))

    one = classes(index.repeated).groupBy("key").agg(F.count("*").alias("texts"), F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"))
    one = written(one, "dedup-classes")
    # rows equal in id and text are told apart by number, in two steps as they may be many
    rows = index.rows.groupBy("key", "text_sha256", "doc_id").agg(F.count("*").alias("times"))
    light = rows.join(one, "key", "left")
    alone = F.col("texts").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id")
    # a row without partners, repeated in itself, was an arrival of several rows and so has a class
    members = light.filter(alone | (F.col("texts") == 1)).select("text_sha256", "doc_id", keep, F.coalesce("group_size", "times").alias("group_size"), "times")
    clash = one.filter("texts > 1").select("key")
    if not clash.isEmpty():
        # different texts under one digest: the rows look for their own text
        apart = _under(index.rows, clash).join(clash, "key", "left_semi").join(classes(clash), ["key", "content"])
        members = members.unionByName(apart.groupBy("text_sha256", "doc_id", "keep_id", "group_size").agg(F.count("*").alias("times")))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / EXPLODE)))
    here = F.least(F.lit(EXPLODE).cast("long"), F.col("times") - F.col("_part") * EXPLODE)
    number = F.explode(F.sequence(F.lit(1).cast("long"), here))
    out = members.withColumn("_part", part).withColumn("_number", number)
    first = (F.col("_part") == 0) & (F.col("_number") == 1)
    return out.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & first).alias("kept"), "text_sha256")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row of ``docs`` (doc_id, text)."""
    return groups(insert(create(docs.sparkSession, docs, docs.count()), docs))


def duplicates_sql(table: str) -> str:
    """The same groups in SQL, over a view with doc_id and text."""
    return f"""
    WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM {table})
    SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
           row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
    FROM t"""
