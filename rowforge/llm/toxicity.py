"""Toxicity by a noisy channel: obfuscated spans are decoded, then the restored text is scored.

A character trigram model counted over the whole corpus stands for clean text. A span
written in leetspeak, spaced out or with stretched letters becomes a lattice: each mark has
the letters it may stand for, separators may vanish, runs may shrink. Viterbi decoding takes
the likeliest reading. The classifier is a list of words and word beginnings of restored
text with the share of toxic documents among those that hold them, fitted on labelled rows.

Null and empty texts have no evidence and get the rate of unexplained toxic documents.
Repeated rows are scored alike; ties cannot occur, as every row is scored by itself. Columns
other than the id and the text are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowforge.llm.shared import discard, fold, hash_share, parts, sliced, written

# The letters that each mark may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "(": "c"}
SEPARATORS = " .-_*~/"
EDGES = ".,;:!?\"'()[]{}<>…»«"
TRI_BITS, BI_BITS = 18, 16
_A, _B, _C = 0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35

_SPACED = re.compile(r"(?<![^\W_])[^\W_](?:[ .\-_*~]{1,2}[\w@$!|+€]){2,}(?![^\W_])|(?<!\S)[@$|+€](?:[ .\-_*~]{1,2}[\w@$!|+€]){2,}(?!\w)")
_STRETCHED = re.compile(r"(.)\1\1")
_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class CharModel:
    """Counts of hashed character trigrams and of their first two characters."""

    tri: np.ndarray
    bi: np.ndarray
    memo: dict = field(default_factory=dict)

    def cost(self, a: str, b: str, c: str) -> float:
        """Negative log probability of c after a and b."""
        key = a + b + c
        if (found := self.memo.get(key)) is None:
            if len(self.memo) >= 200_000:
                self.memo.clear()
            x, y, z = map(ord, key)
            three = self.tri[((x * _A + y * _B + z * _C) & 0xFFFFFFFF) >> (32 - TRI_BITS)]
            two = self.bi[((x * _A + y * _B) & 0xFFFFFFFF) >> (32 - BI_BITS)]
            found = self.memo[key] = -math.log((float(three) + 0.05) / (float(two) + 5.0))
        return found


def count_characters(docs: DataFrame, text: str = "text") -> CharModel:
    """The trigram model of all texts; what reaches the driver is bounded by the hash tables."""

    def counts(batches):
        tri, bi = np.zeros(1 << TRI_BITS, np.int64), np.zeros(1 << BI_BITS, np.int64)
        for batch in parts(batches):
            for run in sliced([x for x in batch.column(0).to_pylist() if x]):
                codes = np.frombuffer(("  ".join(run) + "  ").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
                for k in range(0, len(codes), 1 << 20):
                    c = codes[k : k + (1 << 20) + 2]
                    c = np.where(c <= 32, np.uint32(32), c)
                    pair = c[:-2] * np.uint32(_A) + c[1:-1] * np.uint32(_B)
                    bi += np.bincount(pair >> np.uint32(32 - BI_BITS), minlength=len(bi))
                    pair += c[2:] * np.uint32(_C)
                    tri += np.bincount(pair >> np.uint32(32 - TRI_BITS), minlength=len(tri))
        for kind, table in enumerate((tri, bi)):
            at = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(table[at])], ["kind", "at", "n"])

    rows = docs.select(text).mapInArrow(counts, "kind int, at int, n long").groupBy("kind", "at").agg(F.sum("n").alias("n")).toArrow()
    kind, at, n = (rows.column(c).to_numpy() for c in ("kind", "at", "n"))
    model = CharModel(np.zeros(1 << TRI_BITS, np.int64), np.zeros(1 << BI_BITS, np.int64))
    model.tri[at[kind == 0]] = n[kind == 0]
    model.bi[at[kind == 1]] = n[kind == 1]
    return model


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """For each run of one character, the strings it may stand for and what each reading costs."""
    out = []
    for run in re.finditer(r"(.)\1*", span, re.S):
        ch, n = run[1], len(run[0])
        if ch in SEPARATORS:
            out.append([("", 1.0), (" ", 1.0)])
        elif ch in LEET:
            out.append([(x, 1.5) for x in LEET[ch]] + [(x * 2, 2.0) for x in LEET[ch] if n > 1] + [(ch * n, 0.5)])
        elif n == 1 or not ch.isalpha():
            out.append([(ch * n, 0.0)])
        else:
            out.append([(ch, 0.5 if n > 2 else 2.5), (ch * 2, 0.5 if n > 2 else 0.0)])
    return out


def restore(span: str, model: CharModel) -> str:
    """The likeliest reading of a lower-case span under the model."""
    states = {"  ": (0.0, "")}
    for options in [*lattice(span), [(" ", 0.0)]]:
        after: dict[str, tuple[float, str]] = {}
        for last, (cost, said) in states.items():
            for text, price in options:
                total, tail = cost + price, last
                for c in text:
                    if c != " " or tail[1] != " ":
                        total += model.cost(tail[0], tail[1], c)
                        tail = tail[1] + c
                if (best := after.get(tail)) is None or (total, said + text) < best:
                    after[tail] = (total, said + text)
        states = after
    return min(states.values())[1].strip()


def token_words(token: str, model: CharModel) -> list[str]:
    """The words of one lower-case token, decoded where it looks obfuscated."""
    core = token.strip(EDGES)
    if not core or not any(map(str.isalpha, core)):
        # a token of marks alone has no reading that can be told from a number
        return []
    if core.isalpha() and not _STRETCHED.search(core):
        return [core]
    lead = "$" if token.startswith("$") and not core.startswith("$") else ""
    return list(dict.fromkeys(_LETTERS.findall(restore(lead + core, model))))


def word_features(word: str) -> tuple[str, ...]:
    """The word itself, and the beginnings that longer words share."""
    return (word, *(f"^{word[:n]}" for n in (4, 5, 6) if len(word) > n)) if len(word) > 2 else ()


class Reader:
    """Distinct features of restored texts, remembering the tokens it has read."""

    def __init__(self, model: CharModel, only: dict | None = None, keep: int = 120_000):
        self.model, self.only, self.keep, self.seen = model, only, keep, {}

    def token(self, token: str) -> tuple[str, ...]:
        if (found := self.seen.get(token)) is None:
            if len(self.seen) >= self.keep:
                self.seen.clear()
            names = [f for w in token_words(token, self.model) for f in word_features(w)]
            found = self.seen[token] = tuple(f for f in names if self.only is None or f in self.only)
        return found

    def features(self, text: str | None) -> set[str]:
        out: set[str] = set()
        if text:
            text = text.lower()
            for token in set(text.split()):
                if found := self.token(token):
                    out.update(found)
            for span in set(_SPACED.findall(text)):
                for word in _LETTERS.findall(restore(span, self.model)):
                    out.update(f for f in word_features(word) if self.only is None or f in self.only)
        return out


@dataclass
class ToxicityModel:
    chars: CharModel
    lexicon: dict[str, float]
    base: float

    def score(self, features: set[str]) -> float:
        """Chance that some feature marks a toxic document (noisy or), above the rate without evidence."""
        clean = 1.0 - self.base
        for f in sorted(features):
            clean *= 1.0 - self.lexicon.get(f, 0.0)
        return 1.0 - clean


def _features(sample: DataFrame, chars: CharModel) -> DataFrame:
    """Features and label of each sampled text, written: texts are decoded once for all passes."""

    def read(batches):
        reader = Reader(chars)
        for part in parts(batches, 256):
            found = [sorted(reader.features(text.as_py())) for text in part.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), part.column(1)], ["features", "toxic"])

    kind = sample.schema["toxic"].dataType.simpleString()
    return written(sample.select("text", "toxic").mapInArrow(read, f"features array<string>, toxic {kind}"), "toxic-features")


def _feature_counts(read: DataFrame, strong: dict[str, float]) -> DataFrame:
    """Documents and toxic documents of each feature, over sampled texts without strong features."""

    def counts(batches):
        n, t = Counter(), Counter()
        for batch in batches:
            for found, toxic in ((f.as_py(), t.as_py()) for f, t in zip(batch.column(0), batch.column(1), strict=True)):
                if strong.keys().isdisjoint(found):
                    n[""] += 1
                    t[""] += toxic
                    n.update(found)
                    if toxic:
                        t.update(found)
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([t[f] for f in n], pa.int64())], ["feature", "n", "t"])

    return read.mapInArrow(counts, "feature string, n long, t long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> ToxicityModel:
    """Fit on at most about ``max_rows`` labelled rows, chosen by the hash of their id.

    ``labels`` has doc_id and toxic. First come features that mark toxic documents widely;
    then those that mark what is left, so that other words of explained documents gain nothing.
    """
    chars = count_characters(docs)
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = known.count()
    share = min(1.0, max_rows / max(rows, 1))
    known = known.filter(hash_share(F.col("doc_id"), F.lit("toxicity")) < share)
    # equal texts count once, as toxic if one of them is
    sample = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    read = _features(sample, chars)
    lexicon: dict[str, float] = {}
    base = 0.05
    for precise in (0.95, 0.9, 0.9, 0.9):
        counted = _feature_counts(read, lexicon).persist()
        n, t = next(((r.n, r.t) for r in counted.filter("feature = ''").collect()), (0, 0))
        base = min(0.4, (t + 0.5) / (n + 2.0))
        # so many toxic documents that no feature holds them alone by chance
        least = max(3, math.ceil(math.log(max(2, counted.count())) / -math.log(max(base, 1e-9))), math.ceil(0.005 * t))
        found = counted.filter(f"feature <> '' and t >= {least} and t >= {precise} * n").collect()
        counted.unpersist()
        if not found:
            break
        lexicon |= {r.feature: (r.t + 0.5) / (r.n + 1.0) for r in found}
    discard(read)
    return ToxicityModel(chars, lexicon, base)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with toxic_score (0 to 1) and toxic_pred (1 from 0.5 on), every whole text read."""
    # plain values: a broadcast object would ask the workers for this package
    sent = docs.sparkSession.sparkContext.broadcast((model.chars.tri, model.chars.bi, model.lexicon, model.base))

    def scores(batches):
        tri, bi, lexicon, base = sent.value
        m = ToxicityModel(CharModel(tri, bi), lexicon, base)
        reader = Reader(m.chars, m.lexicon)
        for batch in parts(batches):
            out = [m.score(reader.features(x)) for x in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64()), pa.array([int(x >= 0.5) for x in out], pa.int32())], [*batch.schema.names, "toxic_score", "toxic_pred"])

    kept = docs.select(*[c for c in docs.columns if c not in ("toxic_score", "toxic_pred")])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(scores, f"{fields}, toxic_score double, toxic_pred int")


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels outside fold 0 of 5, the held-out one."""
    return labels.select("doc_id", "toxic").filter(fold(F.col("doc_id"), 5) != 0)
