"""Benchmark decontamination by latent semantic retrieval.

Documents become streams of hashed words. Document frequencies weight them, and a distributed randomised
SVD of the TF-IDF matrix of passages gives each word a whitened latent vector: one pass
multiplies the Gram matrix with random vectors, another rotates the found space. Windows
as long as the items are compared with the items by cosine, from running sums of word vectors.
Candidates are confirmed by the longest common subsequence of words: an item leaks if the
window holds most of it in order, or half of it and its answer, the last words, in one run.
Answers are found exactly, by hashes of runs, and the words around each are confirmed whatever their cosine.
The subsequence cannot be longer than the number of the window's words that are the item's,
so candidates below that bound need no confirmation.

Null and empty texts hold no item, and items without a word are never found. Repeated rows are reported
for each row, an item found twice in a document once, with its best match. Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowforge.llm.shared import parts, written

VOCABULARY, RANK, EXTRA, PASSAGE = 1 << 15, 64, 8, 32
RUN, BLOCK = 16_000, 16  # words of texts multiplied or searched together, and of a block of their sums
OFTEN = 12  # times in one run, from which on a word's passages are summed by a matrix product
PLACES = 2048  # of the words of an item, for the bound on its candidates
WORD = re.compile(r"\w+")
WINDOWS = (4, 6, 9, 13, 18, 26, 38, 55, 80, 120, 180, 270, 400)  # and on by half, up to the longest item


def _hashes(batches):
    """doc_id and the 32-bit hashes of the words of each text."""
    import xxhash

    class Seen(dict):
        def __missing__(self, w: str) -> int:
            found = self[w] = xxhash.xxh32_intdigest(w.encode("utf-8", "surrogatepass"))
            return found

    seen = Seen()
    for part in parts(batches):
        out = []
        for text in part.column(1):
            words = WORD.findall((text.as_py() or "").lower())
            if len(seen) > 150_000:
                seen.clear()
            out.append(np.fromiter(map(seen.__getitem__, words), np.uint32, len(words)).tobytes())
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.binary())], ["id", "words"])


def streams(frame: DataFrame, key: str) -> DataFrame:
    return frame.select(F.col(key).cast("long").alias("id"), "text").mapInArrow(_hashes, "id long, words binary")


def _arrays(batch):
    for raw in batch.column(0):
        if words := raw.as_py():
            yield np.frombuffer(words, np.uint32)


def weights(words: DataFrame) -> np.ndarray:
    """Inverse document frequency of each hashed word, over all documents."""

    def counts(batches):
        n = np.zeros(VOCABULARY + 1, np.int64)
        for batch in batches:
            for ids in _arrays(batch):
                n[:-1][np.unique(ids % VOCABULARY)] += 1
                n[-1] += 1
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["at", "n"])

    found = words.select("words").mapInArrow(counts, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(VOCABULARY + 1, np.int64)
    n[found.column("at").to_numpy()] = found.column("n").to_numpy()
    # above zero also for words that all documents hold
    return np.log1p((n[-1] + 1.0) / (n[:-1] + 1.0)).astype(np.float32)


def _passages(batch, scale, basis):
    """Hashed words of a batch, the passage of each, passage norms, and unit TF-IDF passages times the basis, whose rows come weighted.

    ``scale`` and ``basis`` end with a row of zeros, for no word.
    """
    run = []
    size = 0
    for ids in [*_arrays(batch), None]:
        if ids is not None:
            run.append((ids % VOCABULARY).astype(np.uint16))
            size += len(ids)
        if run and (ids is None or size > RUN):
            words = np.concatenate(run)
            lengths = np.array([len(x) for x in run])
            spans = -(-lengths // PASSAGE)
            # each text from the first place of a passage on; the places left over hold no word
            place = np.arange(len(words)) + np.repeat(PASSAGE * (np.cumsum(spans) - spans) - (np.cumsum(lengths) - lengths), lengths)
            laid = np.full(PASSAGE * spans.sum(), VOCABULARY, np.int64)
            laid[place] = words
            laid = laid.reshape(-1, PASSAGE)
            norm = (1.0 / np.sqrt(np.maximum(np.square(scale[laid]).sum(axis=1), 1e-6))).astype(np.float32)
            y = np.concatenate([basis.take(laid[k : k + 64], axis=0).sum(axis=1) for k in range(0, len(laid), 64)])
            yield words, place // PASSAGE, norm, y * norm[:, None]
            run, size = [], 0


def _add_passages(total, ids, owner, y):
    """Add to the row of each word the vectors of the passages that hold it, once for each time."""
    times = np.bincount(ids, minlength=len(total))
    often = np.flatnonzero(times > OFTEN)
    rank = np.full(len(total), -1, np.int64)
    rank[often] = np.arange(len(often))
    at = rank[ids]
    if len(often):
        for k in range(0, len(y), 512):
            lo, hi = np.searchsorted(owner, (k, k + 512))
            here = at[lo:hi] >= 0
            rows = len(y[k : k + 512])
            held = np.bincount((owner[lo:hi][here] - k) * len(often) + at[lo:hi][here], minlength=rows * len(often)).reshape(rows, -1)
            total[often] += held.astype(np.float32).T @ y[k : k + 512]
    rare = np.flatnonzero(at < 0)
    rare = rare[np.argsort(ids[rare], kind="stable")]
    first = np.flatnonzero(np.diff(ids[rare].astype(np.int32), prepend=-1))
    count = np.diff(np.append(first, len(rare)))
    while len(first):
        # no word twice in a round
        total[ids[rare[first]]] += y.take(owner[rare[first]], axis=0)
        more = count > 1
        first, count = first[more] + 1, count[more] - 1


def latent(words: DataFrame, scale: np.ndarray) -> np.ndarray:
    """Whitened latent vector of each hashed word, by two passes over all passages."""
    spark = words.sparkSession
    width = RANK + EXTRA
    start = np.random.default_rng(3).standard_normal((VOCABULARY, width)).astype(np.float32)
    none = np.zeros((1, width), np.float32)
    padded = np.append(scale, np.float32(0))
    sent = spark.sparkContext.broadcast((padded, np.concatenate([start * scale[:, None], none])))

    def spread(batches):
        scale, basis = sent.value
        total = np.zeros((VOCABULARY, width))
        for batch in batches:
            for ids, owner, norm, y in _passages(batch, scale, basis):
                _add_passages(total, ids, owner, y * norm[:, None])
        total = (total * scale[:-1, None]).astype(np.float32)
        at = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(total[at, k]) for k in range(width))], ["at", *(f"c{k}" for k in range(width))])

    shape = "at long, " + ", ".join(f"c{k} float" for k in range(width))
    sums = words.select("words").mapInArrow(spread, shape).groupBy("at").agg(*(F.sum(f"c{k}").alias(f"c{k}") for k in range(width))).toArrow()
    z = np.zeros((VOCABULARY, width))
    z[sums.column("at").to_numpy()] = np.column_stack([sums.column(f"c{k}").to_numpy() for k in range(width)]) if sums.num_rows else 0
    q = np.linalg.qr(z)[0].astype(np.float32)
    held = spark.sparkContext.broadcast((padded, np.concatenate([q * scale[:, None], none])))

    def rotate(batches):
        scale, basis = held.value
        total = np.zeros((width, width))
        for batch in batches:
            for *_, y in _passages(batch, scale, basis):
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], ["at", "v"])

    small = np.zeros(width * width)
    for r in words.select("words").mapInArrow(rotate, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        small[r["at"]] = r["v"]
    values, vectors = np.linalg.eigh(small.reshape(width, width))
    values, vectors = values[::-1][:RANK], vectors[:, ::-1][:, :RANK]
    # directions that small tables do not have are left out
    real = values > 1e-8 * max(values[0], 1e-6)
    return (scale[:, None] * (q @ (vectors * np.where(real, 1 / np.sqrt(np.maximum(values, 1e-6)), 0.0)))).astype(np.float32)


def common_in_order(item: list[int], window: list[int]) -> int:
    """Length of the longest common subsequence, a bit for each word of the item."""
    places: dict[int, int] = {}
    for k, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << k
    full = (1 << len(item)) - 1
    row = full
    for w in window:
        u = row & places.get(w, 0)
        row = ((row + u) | (row - u)) & full
    return len(item) - bin(row).count("1")


def matches(item: list[int], window: list[int], least: float, answer: int) -> float:
    """Share of the item held in order, or 0 if that is no leak."""
    # no more words can be held in order than occur at all
    there = set(window)
    held, tail = sum(map(there.__contains__, item)) / len(item), item[-answer:]
    if held < least and (held < 0.5 or not there.issuperset(tail)):
        return 0.0
    share = common_in_order(item, window) / len(item)
    if share >= least:
        return share
    if share >= 0.5 and len(item) > 2 * answer and any(window[k : k + answer] == tail for k in range(len(window) - answer + 1)):
        return share
    return 0.0


def tail_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    out = np.zeros(max(0, len(ids) - size + 1), np.uint64)
    for k in range(size if len(out) else 0):
        out = (out + ids[k : k + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, *, cosine: float = 0.5, least: float = 0.75, answer: int = 5, block: int = 20_000) -> DataFrame:
    """doc_id, item_id and share of every benchmark item found in a document.

    Items are taken in blocks of ``block``, so that what is broadcast is bounded.
    """
    spark = docs.sparkSession
    words = written(streams(docs, "doc_id"), "words")
    scale = weights(words)
    vectors = latent(words, scale)
    items = written(streams(benchmark.filter("item_id is not null"), "item_id").filter("length(words) > 0").repartitionByRange(1, "id"), "items") if benchmark.count() <= block else written(streams(benchmark.filter("item_id is not null"), "item_id").filter("length(words) > 0"), "items")
    blocks = max(1, -(-items.count() // block))
    out = None
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).collect()
        known = [(r.id, np.frombuffer(r.words, np.uint32)) for r in part]
        windows = list(WINDOWS)
        while windows[-1] < max((len(ids) for _, ids in known), default=0):
            windows.append(windows[-1] * 3 // 2)
        groups: dict[int, list[int]] = {}
        for n, (_, ids) in enumerate(known):
            groups.setdefault(min(windows, key=lambda w, size=len(ids): abs(np.log(w / size))), []).append(n)
        sent = spark.sparkContext.broadcast((vectors, known, groups))

        def search(batches, sent=sent):
            latent_of, known, groups = sent.value
            lists = [ids.tolist() for _, ids in known]
            lengths = np.array([len(x) for x in lists])
            holds = np.zeros((len(known), PLACES + 1), bool)  # the last place stands for no word
            tails: dict[int, list[int]] = {}
            for n, (_, ids) in enumerate(known):
                holds[n, ids % PLACES] = True
                if len(ids) > 2 * answer:
                    tails.setdefault(int(tail_hashes(ids[-answer:], answer)[0]), []).append(n)
            endings = np.array(sorted(tails), np.uint64)
            marks = {}
            for size, own in groups.items():
                m = np.stack([latent_of[known[n][1] % VOCABULARY].sum(axis=0) for n in own])
                marks[size] = (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)).T, np.array(own), max(size, *lengths[own])

            sizes = np.zeros(len(known), np.int64)
            for size, own in groups.items():
                sizes[own] = size

            def candidates(ids: np.ndarray):
                """Item and place of each window that holds the item's answer or is close to the item, and is not below the bound."""
                need = np.ceil(least * lengths - 1e-9)
                runs = tail_hashes(ids, answer)
                hits = np.flatnonzero(np.isin(runs, endings))
                for h in set(runs[hits].tolist()):
                    need[tails[h]] = np.minimum(need[tails[h]], np.ceil(0.5 * lengths[tails[h]]))
                for at in hits.tolist():
                    for n in tails[int(runs[at])]:
                        size, wide = int(sizes[n]), max(int(sizes[n]), int(lengths[n]))
                        # from windows that end with the answer to those that begin with it
                        for start in range(at + answer - wide - wide // 2, at + wide // 2 + 1, max(1, wide // 2)):
                            start = max(0, start)
                            if holds[n, ids[max(0, start - wide // 2) : start + wide + wide // 2] % PLACES].sum() >= need[n]:
                                yield n, start, size
                for lo in range(0, len(ids), 20_000):
                    stretch = ids[lo : lo + 20_000 + 2 * max(marks, default=1)]
                    sums = np.zeros((len(stretch) + 1, RANK), np.float32)
                    np.cumsum(latent_of[stretch % VOCABULARY], axis=0, out=sums[1:])
                    for size, (mark, own, wide) in marks.items():
                        step = max(1, size // 4)
                        starts = np.arange(0, max(1, min(len(stretch) - size, 20_000) + step), step)
                        starts = np.minimum(starts, max(0, len(stretch) - size))
                        window = sums[np.minimum(starts + size, len(stretch))] - sums[starts]
                        norm = np.sqrt(np.einsum("ij,ij->i", window, window))
                        s, n = np.nonzero(window @ mark >= cosine * np.maximum(norm, 1e-9)[:, None])
                        # the places of the words around each window
                        left, right = max(0, lo - wide), lo + len(stretch) + 2 * wide
                        near = np.full(len(stretch) + 3 * wide + 1, PLACES)
                        near[left - lo + wide :][: len(ids[left:right])] = ids[left:right] % PLACES
                        around = np.arange(wide - wide // 2, 2 * wide + wide // 2 + 1)
                        many = max(1, min(10_000, 8_000_000 // len(around)))
                        for k in range(0, len(s), many):
                            at, item = starts[s[k : k + many]], own[n[k : k + many]]
                            kept = holds[item[:, None], near[at[:, None] + around]].sum(axis=1) >= need[item]
                            yield from zip(item[kept].tolist(), (at[kept] + lo).tolist(), [size] * int(kept.sum()), strict=True)

            padded = np.concatenate([latent_of, np.zeros((1, RANK), np.float32)])
            held_places = holds.ravel().view(np.uint8)
            gap = max((wide + wide // 2 + 1 for _, _, wide in marks.values()), default=1)
            likely = np.zeros(1 << 16, bool)
            likely[(endings & np.uint64(0xFFFF)).astype(np.int64)] = True

            def together(texts: list[np.ndarray]):
                """Text, item, place and size of the candidates of many texts: as ``candidates`` finds them, but with all texts in one array."""
                flat, size_of = np.concatenate(texts), np.array([len(x) for x in texts])
                begin = np.cumsum(size_of) - size_of
                runs = tail_hashes(flat, answer)
                hits = np.flatnonzero(likely[(runs & np.uint64(0xFFFF)).astype(np.int64)])
                hits = hits[np.isin(runs[hits], endings)]
                holder = np.searchsorted(begin, hits, side="right") - 1
                alone = size_of > 20_000
                alone[holder[hits + answer <= (begin + size_of)[holder]]] = True
                for t in np.flatnonzero(alone).tolist():
                    for n, at, size in candidates(texts[t]):
                        yield t, n, at, size
                if alone.any():
                    texts = [x for x, out in zip(texts, alone.tolist(), strict=True) if not out]
                    if not texts:
                        return
                    flat, size_of = np.concatenate(texts), size_of[~alone]
                    begin = np.cumsum(size_of) - size_of
                number = np.flatnonzero(~alone)
                need = np.ceil(least * lengths - 1e-9)
                # sums of the vectors before each word and after the last one: within blocks, then over the blocks of a text
                blocks = -(-(size_of + 1) // BLOCK)
                row0 = BLOCK * (np.cumsum(blocks) - blocks)
                laid = np.full(BLOCK * blocks.sum(), VOCABULARY)
                laid[np.arange(len(flat)) + np.repeat(row0 + 1 - begin, size_of)] = flat % VOCABULARY
                inner = padded.take(laid, axis=0).reshape(-1, BLOCK, RANK)
                for k in range(1, BLOCK):
                    inner[:, k] += inner[:, k - 1]
                before = np.cumsum(inner[:, -1], axis=0, dtype=np.float64) - inner[:, -1]
                before -= np.repeat(before[row0 // BLOCK], blocks, axis=0)
                inner += before.astype(np.float32)[:, None]
                sums = inner.reshape(-1, RANK)
                # the places of the words, with room for the widest window around each text
                at0 = begin + gap * np.arange(1, len(size_of) + 1)
                near = np.full(len(flat) + gap * (len(size_of) + 1), PLACES, np.int32)
                near[np.arange(len(flat)) + np.repeat(at0 - begin, size_of)] = flat % PLACES
                for size, (mark, own, wide) in marks.items():
                    step = max(1, size // 4)
                    count = -(-np.maximum(1, size_of - size + step) // step)
                    owner = np.repeat(np.arange(len(size_of)), count)
                    starts = step * (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count))
                    starts = np.minimum(starts, np.maximum(0, size_of - size)[owner])
                    around = np.arange(-(wide // 2), wide + wide // 2 + 1)
                    many = max(1, min(10_000, 1_000_000 // len(around)))
                    rows = max(1, min(8192, 2_000_000 // len(own)))
                    for j in range(0, len(owner), rows):
                        who, start = owner[j : j + rows], starts[j : j + rows]
                        window = sums.take(row0[who] + np.minimum(start + size, size_of[who]), axis=0)
                        window -= sums.take(row0[who] + start, axis=0)
                        norm = np.sqrt(np.einsum("ij,ij->i", window, window))
                        s, n = np.divmod(np.flatnonzero(window @ mark >= cosine * np.maximum(norm, 1e-9)[:, None]), len(own))
                        for k in range(0, len(s), many):
                            w, item = s[k : k + many], own[n[k : k + many]]
                            places = near.take((at0[who[w]] + start[w])[:, None] + around) + (item * (PLACES + 1))[:, None]
                            kept = np.add.reduce(held_places.take(places), axis=1, dtype=np.int32) >= need[item]
                            yield from zip(number[who[w[kept]]].tolist(), item[kept].tolist(), start[w[kept]].tolist(), [size] * int(kept.sum()), strict=True)

            def texts_of(batch):
                """Keys and words of texts that hold words, about ``RUN`` words at a time."""
                keys, texts, size = [], [], 0
                for key, raw in zip(batch.column(0), batch.column(1), strict=True):
                    if ids := raw.as_py():
                        keys.append(key.as_py())
                        texts.append(np.frombuffer(ids, np.uint32))
                        size += len(texts[-1])
                    if size >= RUN:
                        yield keys, texts
                        keys, texts, size = [], [], 0
                if texts:
                    yield keys, texts

            for batch in batches:
                rows = []
                for keys, texts in texts_of(batch) if marks else ():
                    best: dict[tuple[int, int], float] = {}
                    for t, n, at, size in together(texts):
                        if best.get((t, n), 0.0) < 1.0:
                            wide = max(size, len(lists[n]))
                            share = matches(lists[n], texts[t][max(0, at - wide // 2) : at + wide + wide // 2].tolist(), least, answer)
                            if share:
                                best[t, n] = max(best.get((t, n), 0.0), share)
                    rows += [(keys[t], known[n][0], share) for (t, n), share in sorted(best.items())]
                if rows:
                    a, b, c = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())], ["doc_id", "item_id", "share"])

        found = words.mapInArrow(search, "doc_id long, item_id long, share double")
        out = found if out is None else out.union(found)
    return out
