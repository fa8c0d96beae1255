"""Pattern packing: pieces of token sequences are placed by a plan made from their histogram.

Texts are tokenised and cut into pieces of at most ``size`` ids. Only the histogram of piece
lengths (at most ``size`` bins) reaches the driver. There few-piece patterns that fill a sequence
are listed, their repeat counts fitted to the histogram by non-negative least squares and
rounded down, and the rest is packed best-fit in bulk by length. Every piece then finds its place
from its number among the pieces of its length; numbers are dealt in salted groups, so that
a length that most pieces share is spread over tasks.

A null text is empty: one piece that holds only the end id. Repeated rows are packed one by one; equal
lengths are interchangeable, and ties between them go by doc_id and piece. Without rows
the result is empty. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections import Counter
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowforge.llm.shared import parts, sliced, written

SALTS = 64
PIECES = "doc_id long, piece int, start long, length long, ids binary"


def _ids(encoded) -> bytes:
    return np.array(encoded.ids, "<u4").tobytes()


def whole_encoder(tokenizer):
    """The ids of each text, encoded as it stands, as little-endian unsigned 32-bit numbers."""
    return lambda texts: [_ids(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def word_encoder(tokenizer, keep: int = 600_000, longest: int = 64, mark: str = "\x01", run: int = 1000):
    """The ids of each text, word by word; the ids of words met before are remembered as bytes.

    New words are encoded many at a time, set apart by a control character whose own id shows where
    each ends; words that hold it, and tokenizers that have no such id, are encoded singly. Letters before one
    closing mark are a word of their own, if samples show that the tokenizer parts them, too. Words of letters need no
    such sign where the tokenizer itself marks the ends of words.
    """
    seen: dict[str, bytes] = {"": b""}
    sign = tokenizer.encode(mark, add_special_tokens=False).ids
    between = f" {mark} "

    def singly(words: list[str]) -> list[bytes]:
        return [_ids(x) for x in tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def together(words: list[str]) -> list[bytes]:
        joined = between.join(words)
        if len(sign) != 1 or joined.count(mark) != len(words) - 1:
            return singly(words)
        flat = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(flat == sign[0])
        if len(cuts) != len(words) - 1:
            return singly(words)
        data, starts, ends = flat.tobytes(), [0, *((cuts + 1) * 4).tolist()], [*(cuts * 4).tolist(), 4 * len(flat)]
        return [data[i:j] for i, j in zip(starts, ends, strict=True)]

    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    closing = np.array(sorted(v for k, v in tokenizer.get_vocab().items() if suffix and k.endswith(suffix)), np.int64)
    closes = np.zeros(int(closing.max(initial=0)) + 1, bool)
    closes[closing] = True

    def lettered(words: list[str]) -> list[bytes]:
        """Words of letters only: where the tokenizer marks the ends of words, these marks tell them apart."""
        if not suffix:
            return together(words)
        flat = np.array(tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = 4 * (np.flatnonzero(closes[np.minimum(flat, len(closes) - 1)]) + 1)
        if len(ends) != len(words) or ends[-1] != 4 * len(flat):
            return together(words)
        data, ends = flat.tobytes(), ends.tolist()
        return [data[i:j] for i, j in zip([0, *ends], ends, strict=False)]

    def parted(stop: str) -> bool:
        samples = ["a", "Ab", "the", "ends", "\u00e9t\u00e9", "zzqxkv"]
        return all(a == b + c for a, b, c in zip(singly([x + stop for x in samples]), singly(samples), singly([stop] * len(samples)), strict=True))

    stops = {x: singly([x])[0] for x in ".,;:!?" if parted(x)}

    def learn(new: list[str]) -> None:
        ends = {w: w[:-1] for w in new if w[-1:] in stops and w[:-1].isalpha()}
        letters = set(ends.values()).difference(seen)
        others = []
        for w in new:
            if w not in ends:
                letters.add(w) if w.isalpha() else others.append(w)
        for words, way in ((list(letters), lettered), (others, together)):
            for k in range(0, len(words), run):
                seen.update(zip(words[k : k + run], way(words[k : k + run]), strict=True))
        for w, word in ends.items():
            seen[w] = seen[word] + stops[w[-1]]

    def encode(texts: list[str]) -> list[bytes]:
        if len(seen) > keep:
            seen.clear()
            seen[""] = b""
        split = [x.replace("\n", " ").split(" ") for x in texts]
        new = list(set().union(*split).difference(seen))
        learn(new)
        out = [b"".join(itemgetter(*words, "")(seen)) for words in split]
        for w in new:
            if len(w) > longest:
                del seen[w]
        return out

    return encode


def pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, by_words: bool = True) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian unsigned 32-bit) of every piece.

    ``by_words`` is for tokenizers whose tokens never hold or depend on white space, as those that
    cut texts into words first; for others the texts must be encoded whole.
    """

    def cut(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        end = np.array([end_id], "<u4").tobytes()
        encode = word_encoder(Tokenizer.from_file(tokenizer)) if by_words else whole_encoder(Tokenizer.from_file(tokenizer))
        for batch in parts(batches):
            keys, texts = batch.column(0).to_pylist(), [x or "" for x in batch.column(1).to_pylist()]
            k = 0
            for run in sliced(texts):
                out: list[tuple] = []
                for key, found in zip(keys[k : k + len(run)], encode(run), strict=True):
                    ids = found + end
                    out += [(key, n, at, min(size, len(ids) // 4 - at), ids[4 * at : 4 * (at + size)]) for n, at in enumerate(range(0, len(ids) // 4, size))]
                k += len(run)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def patterns(histogram: np.ndarray, size: int) -> list[tuple[int, ...]]:
    """Pairs, triples and fours of present lengths that fill a sequence, or nearly."""
    present = np.flatnonzero(histogram)
    held = set(present.tolist())
    out = {(int(size),)} if size in held else set()
    common = present[np.argsort(-histogram[present], kind="stable")][:96].tolist()
    for a in present.tolist():
        for slack in range(4):
            if (b := size - a - slack) >= a and b in held:
                out.add((b, a))
        for c in common[:48]:
            if (b := size - a - c) > 0 and b in held:
                out.add(tuple(sorted((a, b, c), reverse=True)))
    for i, a in enumerate(common):
        for j, b in enumerate(common[i:48]):
            for c in common[i + j : 24]:
                if (d := size - a - b - c) > 0 and d in held:
                    out.add(tuple(sorted((a, b, c, d), reverse=True)))
    return sorted(out, reverse=True)


def fit(found: list[tuple[int, ...]], histogram: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - h|^2, by multiplicative updates."""
    owner = np.repeat(np.arange(len(found)), [len(p) for p in found])
    lengths = np.array([x for p in found for x in p])
    h = histogram.astype(float)
    target = np.bincount(owner, h[lengths], len(found))
    x = np.full(len(found), max(1.0, h.sum() / max(1, len(lengths))))
    for _ in range(rounds):
        covered = np.bincount(lengths, x[owner], len(h))
        x *= target / np.maximum(np.bincount(owner, covered[lengths], len(found)), 1e-9)
    return x


def best_fit(left: np.ndarray, size: int) -> Counter:
    """Bulk best-fit decreasing: sequences as tuples of lengths, with how many of each."""
    bins: list[dict] = [Counter() for _ in range(size + 1)]  # by free room
    for length in range(size, 0, -1):
        n = int(left[length])
        room = length
        while n and room <= size:
            moved = []
            for key in sorted(bins[room]) if bins[room] else ():
                take = min(n, bins[room][key])
                if take:
                    moved.append((key, take))
                    n -= take
            for key, take in moved:
                bins[room][key] -= take
                if not bins[room][key]:
                    del bins[room][key]
                bins[room - length][(*key, length)] += take
            room += 1
        while n > 0:
            per = size // length
            full, n = divmod(n, per)
            if full:
                bins[size - per * length][(length,) * per] += full
            if n:
                bins[size - n * length][(length,) * n] += 1
                n = 0
    out: Counter = Counter()
    for held in bins:
        out.update(held)
    return out


def plan(histogram: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and repeat counts that hold every piece; the share of fitted counts that packs best."""
    found = patterns(histogram, size)
    x = fit(found, histogram) if found else np.zeros(0)
    best = None
    for share in (1.0, 0.9, 0.7, 0.4, 0.0):
        left, use = histogram.copy(), Counter()
        for k in np.argsort(-x, kind="stable"):
            need = Counter(found[k])
            n = min(int(x[k] * share), *(int(left[v]) // m for v, m in need.items()))
            if n > 0:
                use[found[k]] += n
                for v, m in need.items():
                    left[v] -= n * m
        use.update(best_fit(left, size))
        if best is None or sum(use.values()) < sum(best.values()):
            best = use
    return sorted(best.items(), reverse=True)


def assign(cut: DataFrame, size: int = 2048) -> DataFrame:
    """Each piece with sequence_id and offset. ``cut`` has doc_id, piece, length and any payload."""
    cut = written(cut, "pieces")
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)).cast("int"))
    # at most size x SALTS counts
    counts = salted.groupBy("length", "_salt").agg(F.count("*").alias("n")).toArrow()
    table = np.zeros((size + 1, SALTS), np.int64)
    table[counts.column("length").to_numpy(), counts.column("_salt").to_numpy()] = counts.column("n").to_numpy()
    before = np.cumsum(table, axis=1) - table
    runs: dict[int, list[tuple[int, int, int, int, int]]] = {}
    dealt: Counter = Counter()
    sequence = 0
    for lengths, n in plan(table.sum(axis=1), size):
        offset = 0
        for value in dict.fromkeys(lengths):
            m = lengths.count(value)
            runs.setdefault(value, []).append((dealt[value], sequence, m, offset, value))
            dealt[value] += m * n
            offset += m * value
        sequence += n
    sent = cut.sparkSession.sparkContext.broadcast((before, {k: np.array(v, np.int64).T for k, v in runs.items()}))

    def place(batches):
        start, by_length = sent.value
        for batch in batches:
            length, salt, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "_salt", "_rank"))
            number = start[length, salt] + rank - 1
            where, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for value in np.unique(length):
                at = np.flatnonzero(length == value)
                first, base, m, begin, _ = (by_length[int(value)])
                k = np.searchsorted(first, number[at], side="right") - 1
                inner = number[at] - first[k]
                where[at] = base[k] + inner // m[k]
                offset[at] = begin[k] + inner % m[k] * value
            keep = [c for c in batch.schema.names if c not in ("_salt", "_rank")]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(where), pa.array(offset)], [*keep, "sequence_id", "offset"])

    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")
