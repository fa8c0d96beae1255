"""Near-duplicate documents by MinHash bands and odd sketches, confirmed on full shingle sets.

Words are runs of non-space characters with A-Z in lower case; a document's set is its distinct
five-word shingles (fewer words: the whole sequence; none: empty, linked with nothing). Equal word
sequences are one class from the start, so copies are never paired. The minima of a class
give band keys and an odd sketch: a bitmap whose bits flip for each minimum, so that the XOR
of two bitmaps estimates how many minima differ. Bands propose pairs, sketches drop those
clearly below the threshold, and shingle sets decide.

Groups are not paired out. The classes of a bucket meet ``HEADS`` of them, the same
ones wherever possible in all buckets of a group. First each class
confirms the partner whose sketch is nearest, then, if many pairs are still apart, the nearest in another
component; then all that are apart. A bucket is done once its classes lie in one component, as most of a group then does.
Classes of one bucket that are still in different components are compared with each other, by finer sketches. A pair at the threshold shares no band with probability 4e-6; the first sketches
drop such a pair with about 2e-6 (4 of 2,000,000 simulated), the finer ones with less: their slack is five standard deviations.

Null and empty texts have no shingles and stay alone; rows without an id are left out. Rows that share
an id are one document, whose text is the one with the least digest if they differ; each of the rows comes
back. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowforge.llm.shared import discard, written

ROWS, BANDS, WORDS, BITS, SLACK = 6, 64, 5, 1024, 0.14
FINE, FINE_BITS, FINE_SLACK = 4096, 16384, 0.04
HEADS, RUN, MANY, SENT = 4, 1000, 4, 1 << 20
SKETCH = "doc_id long, key binary, n_shingles long, bands array<long>, odd array<long>"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8; bytes are lower-cased and split in ASCII only."""
    return text.lower().split() if text else []


class Shingler:
    """Sorted distinct 64-bit shingle hashes of a sequence of words; word hashes are remembered."""

    def __init__(self, keep: int = 150_000):
        import xxhash

        self.hash, self.keep, self.seen = xxhash.xxh3_64_intdigest, keep, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.seen) > self.keep:
            self.seen.clear()
        seen = self.seen
        for w in set(words):
            if w not in seen:
                seen[w] = self.hash(w)
        h = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
        n = min(WORDS, len(words))
        out = np.full(len(h) - n + 1, np.uint64(n))
        for k in range(n):
            out = _mix(out + h[k : len(h) - n + 1 + k])
        return np.unique(out)


_KEYS = _mix(np.arange(1, FINE + 1, dtype=np.uint64))
_LOW, _HIGH = _KEYS.astype(np.uint32) | np.uint32(1), (_KEYS >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_BAND = _mix(np.arange(7, 7 + ROWS, dtype=np.uint64)) | np.uint64(1)


def minima(shingles: np.ndarray, count: int = ROWS * BANDS) -> np.ndarray:
    """Minima of the set under ``count`` fixed multiply-add hashes of both halves of its members."""
    low, high = shingles.astype(np.uint32), (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(count, 2**32 - 1, np.uint32)
    step = max(1, 98304 // count)
    for k in range(0, len(shingles), step):
        x = low[k : k + step, None] * _LOW[:count]
        x += high[k : k + step, None] * _HIGH[:count]
        np.minimum(best, x.min(axis=0), out=best)
    return best.astype(np.uint64)


def odd_sketch(best: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The parity of how many minima fall on each of ``bits`` places."""
    at = _mix(best + np.arange(len(best), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(bits)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8))


def sketch_distance(threshold: float, slack: float = SLACK, count: int = ROWS * BANDS, bits: int = BITS) -> int:
    """XOR bits expected of sets ``slack`` less similar than the threshold: beyond it a pair is dropped."""
    differ = 2 * count * (1 - (threshold - slack))
    return int(bits / 2 * (1 - np.exp(-2 * differ / bits)))


def _digest(words: list[bytes]) -> bytes:
    return hashlib.md5(b" ".join(words)).digest()


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    """A list column of these rows."""
    ends = np.cumsum([0, *(len(r) for r in rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *rows])))


def _sketch(batches):
    shingle, known, none = Shingler(), {}, np.zeros(0, np.int64)
    for batch in batches:
        for k in range(0, batch.num_rows, 1024):
            part, keys, sizes, bands, odd = batch.slice(k, 1024), [], [], [], []
            for text in part.column(1):
                words = words_of(text.as_py())
                key = _digest(words)
                if key not in known:
                    found = shingle(words)
                    best = minima(found)
                    own = _mix(best.reshape(BANDS, ROWS) @ _BAND + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                    if len(known) >= 2048:
                        known.clear()
                    known[key] = len(found), own if len(found) else none, odd_sketch(best).view(np.int64)
                n, own, sketch = known[key]
                keys.append(key)
                sizes.append(n)
                bands.append(own)
                odd.append(sketch)
            columns = [part.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), _lists(bands), _lists(odd)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "n_shingles", "bands", "odd"])


def _with_digests(batches):
    for batch in batches:
        keys = [_digest(words_of(t.as_py())) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary())], ["cls", "text", "key"])


def _fine_sketch(batches):
    shingle = Shingler()
    for batch in batches:
        for k in range(0, batch.num_rows, 512):
            part = batch.slice(k, 512)
            found = [odd_sketch(minima(shingle(words_of(t.as_py())), FINE), FINE_BITS).view(np.int64) for t in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), _lists(found)], ["cls", "odd"])


def _confirm(threshold: float):
    top = round(threshold * 100)

    def check(batches):
        shingle, last, held = Shingler(), None, None
        for batch in batches:
            out = []
            for a, b, x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if a != last:
                    last, held = a, shingle(words_of(x.as_py()))
                other = shingle(words_of(y.as_py()))
                both = len(np.intersect1d(held, other, assume_unique=True))
                out.append(100 * both >= top * (len(held) + len(other) - both))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(out, pa.bool_())) for k in (0, 1)], ["a", "b"])

    return check


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable, for links a, b. Labels spread and jump until they rest."""
    both = written(links.select(F.col("a").alias("node"), F.col("b").alias("next")).union(links.select("b", "a")).distinct(), "links")
    label = written(both.groupBy("node").agg(F.min("next").alias("m")).select("node", F.least("node", "m").alias("root")), "roots")
    while True:
        near = both.join(label.select(F.col("node").alias("next"), F.col("root").alias("r")), "next").groupBy("node").agg(F.min("r").alias("r"))
        step = label.join(near, "node").select("node", "root", F.least("root", "r").alias("to"))
        jump = label.select(F.col("node").alias("to"), F.col("root").alias("far"))
        after = written(step.join(jump, "to", "left").select("node", F.least("to", "far").alias("root"), (F.least("to", "far") < F.col("root")).alias("moved")), "roots")
        discard(label)
        label = after
        if label.filter("moved").isEmpty():
            discard(both)
            return label.select("node", "root")


def _small(frame: DataFrame) -> DataFrame:
    """A written frame of one or two numbers a row, broadcast if it holds at most ``SENT`` rows."""
    return F.broadcast(frame) if frame.count() <= SENT else frame


class _Linker:
    """Confirmed links so far and the components they make, over the classes of one table of documents."""

    def __init__(self, docs: DataFrame, reps: DataFrame, classes: DataFrame, threshold: float):
        self.docs, self.reps, self.threshold = docs, reps, threshold
        self.odd = classes.select("cls", "odd")
        self.far = sketch_distance(threshold)
        none = docs.sparkSession.createDataFrame([], "a long, b long")
        self.links, self.roots = none, none.select(F.col("a").alias("node"), F.col("b").alias("root"))

    def rooted(self, frame: DataFrame, node: str) -> DataFrame:
        roots = self.roots.select(F.col("node").alias(node), F.col("root").alias(f"_{node}"))
        return frame.join(roots, node, "left").withColumn(f"_{node}", F.coalesce(f"_{node}", node))

    def apart(self, pairs: DataFrame) -> DataFrame:
        """Pairs a, b in different components."""
        return self.rooted(self.rooted(pairs, "a"), "b").filter("_a <> _b").drop("_a", "_b")

    def close(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sketches do not rule them out, and how many bits differ."""
        x = pairs.join(self.odd.select(F.col("cls").alias("a"), F.col("odd").alias("oa")), "a").join(self.odd.select(F.col("cls").alias("b"), F.col("odd").alias("ob")), "b")
        return x.select("a", "b", _differing("oa", "ob").alias("bits")).filter(F.col("bits") <= self.far)

    def texts(self, asked: DataFrame) -> DataFrame:
        """cls and text of the classes asked for, written; only these texts travel."""
        asked = written(asked.select("cls").distinct(), "asked")
        found = self.docs.select(F.col("doc_id").alias("cls"), "text").join(_small(asked), "cls", "left_semi")
        found = found.mapInArrow(_with_digests, "cls long, text binary, key binary")
        found = found.join(self.reps.select("cls", "key"), ["cls", "key"], "left_semi").dropDuplicates(["cls", "key"])
        out = written(found.select("cls", "text"), "texts")
        discard(asked)
        return out

    def refine(self, active: DataFrame) -> None:
        """From now on compare the classes that are still active by finer sketches."""
        texts = self.texts(active)
        self.odd = written(texts.mapInArrow(_fine_sketch, "cls long, odd array<long>"), "fine-sketches")
        discard(texts)
        self.far = sketch_distance(self.threshold, FINE_SLACK, FINE, FINE_BITS)

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose full sets reach the threshold, written. Partners of one class are dealt in runs of ``RUN``."""
        texts = self.texts(pairs.select(F.col("a").alias("cls")).union(pairs.select("b")))
        runs = pairs.groupBy("a").agg(F.ceil(F.count("*") / RUN).alias("runs"))
        dealt = pairs.join(runs, "a").select("a", "b", F.pmod(F.xxhash64("b"), "runs").alias("run"))
        heads = texts.join(runs, texts["cls"] == runs["a"]).select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("runs") - 1)).alias("run"), F.col("text").alias("ta"))
        x = dealt.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("tb")), "b").join(heads, ["a", "run"])
        out = written(x.select("a", "b", "ta", "tb").mapInArrow(_confirm(self.threshold), "a long, b long"), "confirmed")
        discard(texts)
        return out

    def add(self, pairs: DataFrame) -> None:
        """Confirm these written pairs and close the links."""
        new = self.confirm(pairs)
        if not new.isEmpty():
            self.links = self.links.unionByName(new)
            self.roots = components(self.links)

    def link(self, pairs: DataFrame) -> None:
        """Decide all close pairs: the nearest partner of each class, once more if many are left, then what is still apart."""
        left, many = written(self.close(pairs), "pairs"), 0
        for _ in range(2):
            if (size := left.count()) <= many or not size:
                break
            both = left.select(F.col("a").alias("node"), "bits", F.col("b").alias("other")).union(left.select("b", "bits", "a"))
            best = both.groupBy("node").agg(F.min(F.struct("bits", "other")).alias("best"))
            nearest = best.select(F.least("node", "best.other").alias("a"), F.greatest("node", "best.other").alias("b")).distinct()
            nearest = written(nearest, "nearest")
            self.add(nearest)
            after = written(self.apart(left.join(nearest, ["a", "b"], "left_anti")), "pairs")
            many = MANY * nearest.count()
            discard(left)
            discard(nearest)
            left = after
        if not left.isEmpty():
            self.add(left)
        discard(left)


def _differing(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)


def _heads(buckets: DataFrame) -> DataFrame:
    """Up to HEADS classes of each bucket: those nearest in number to fixed marks, and so often the same in many buckets."""
    marks = _mix(np.arange(1, HEADS + 1, dtype=np.uint64)) >> np.uint64(1)
    each = [F.min(F.col("cls").bitwiseXOR(F.lit(int(m)))).alias(f"h{i}") for i, m in enumerate(marks)]
    back = F.array(*(F.col(f"h{i}").bitwiseXOR(F.lit(int(m))) for i, m in enumerate(marks)))
    return buckets.groupBy("band").agg(F.count("*").alias("n"), *each).filter("n > 1").select("band", "n", F.array_distinct(back).alias("heads"))


def near_duplicates(docs: DataFrame, threshold: float = 0.75) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text)."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).filter("doc_id is not null")
    sketched = written(base.mapInArrow(_sketch, SKETCH), "sketches")
    members = written(sketched.groupBy("doc_id").agg(F.min("key").alias("key"), F.count("*").alias("times")), "members")
    # one class for each sequence of words, named by its smallest id
    reps = written(members.groupBy("key").agg(F.min("doc_id").alias("cls")), "classes")
    first = sketched.join(reps.select(F.col("cls").alias("doc_id"), "key"), ["doc_id", "key"], "left_semi").dropDuplicates(["doc_id", "key"])
    classes = written(first.select(F.col("doc_id").alias("cls"), "n_shingles", "bands", "odd"), "class-sketches")
    discard(sketched)
    linker = _Linker(base, reps, classes, threshold)
    buckets = classes.select("cls", F.explode("bands").alias("band"))
    met = buckets.join(_heads(buckets), "band")
    others = met.select("cls", F.explode(F.array_except("heads", F.array("cls"))).alias("head"))
    pairs = others.select(F.least("cls", "head").alias("a"), F.greatest("cls", "head").alias("b")).distinct()
    # heads have met their whole bucket and leave it
    left = written(met.filter(~F.array_contains("heads", F.col("cls"))).select("band", "cls"), "buckets")
    linker.link(pairs)
    apart = linker.rooted(left, "cls")
    mixed = apart.groupBy("band").agg(F.min("_cls").alias("lo"), F.max("_cls").alias("hi")).filter("lo < hi").select("band")
    active = written(apart.join(mixed, "band", "left_semi").select("band", "cls", "_cls"), "buckets")
    discard(left)
    if not active.isEmpty():
        linker.refine(active)
        rest = active.join(linker.odd, "cls").join(classes.select("cls", F.col("odd").alias("first")), "cls")
        left, right = (rest.select("band", *[F.col(c).alias(p + c) for c in ("cls", "_cls", "odd", "first")]) for p in ("a", "b"))
        near = (_differing("afirst", "bfirst") <= sketch_distance(threshold)) & (_differing("aodd", "bodd") <= linker.far)
        cross = left.join(right, "band").filter((F.col("acls") < F.col("bcls")) & (F.col("a_cls") != F.col("b_cls")) & near)
        cross = written(cross.select(F.col("acls").alias("a"), F.col("bcls").alias("b")).distinct(), "pairs")
        if not cross.isEmpty():
            linker.add(cross)
    final = linker.rooted(reps.withColumn("node", F.col("cls")), "node").select("key", "cls", F.col("_node").alias("component_id"))
    final = final.join(classes.select("cls", "n_shingles"), "cls")
    out = members.join(final, "key").withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    alone = F.col("n_shingles") == 0
    root = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", root.alias("component_id"), (F.col("doc_id") == root).alias("kept"))
