"""Language identification with a blended-spectrum string kernel.

Each text is cut into windows of some hundred characters; a window is the presence vector of
its n-grams for n = 1, 2, 3, hashed to fixed places. The kernel of two windows is the mean over n
of the cosines of their presence vectors. Nyström landmarks, some windows of labelled
texts for each language, span the feature space, and one ridge regression for each language
against the rest is fitted there. A text is scored by products of its windows' presence
matrix with the landmarks; its languages' scores are the means over all windows.

Null texts and texts without a letter are ``und`` with score 0. If nothing could be learned,
every text is ``und``. Ties go to the language first in order of name. Columns other than the id
and the text are not read for a prediction, and every row is predicted by itself.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowforge.llm.shared import hash_share, sliced

WINDOW = 600
SIZES = (512, 1536, 2048)  # places for n-grams of one, two and three characters
STARTS = (0, 512, 2048)
WIDTH = 4096
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class LanguageModel:
    names: list[str]
    landmarks: np.ndarray  # window x place, rows scaled for the kernel
    weights: np.ndarray  # landmark x language


def presence(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Scaled presence rows of all windows of the texts, and which text each belongs to."""
    lows = [t.lower() for t in texts]
    codes = np.frombuffer(("\0\0".join(lows) + "\0\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 2 for t in lows]) - 2
    lengths = np.diff(ends, prepend=-2) - 2
    windows = np.maximum(1, lengths // WINDOW)
    owner = np.repeat(np.arange(len(texts)), windows)
    first = np.cumsum(windows) - windows
    text_of = np.repeat(np.arange(len(texts)), lengths + 2)
    inside = np.arange(len(codes)) - (ends - lengths)[text_of]
    row = first[text_of] + np.minimum(inside * windows[text_of] // np.maximum(lengths, 1)[text_of], windows[text_of] - 1)
    matrix = np.zeros((len(owner), WIDTH), np.float32)
    flat, c = matrix.reshape(-1), codes
    gram = c.copy()
    for n, (start, size) in enumerate(zip(STARTS, SIZES, strict=True)):
        if n:
            gram = gram[:-1] * np.uint32(0x9E3779B1) + c[n:]
        whole = inside[: len(gram)] + n < lengths[text_of[: len(gram)]]
        place = ((gram * np.uint32(0x85EBCA6B)) >> np.uint32(11)) % np.uint32(size)
        flat[(row[: len(gram)] * WIDTH + start + place)[whole]] = 1.0
        part = matrix[:, start : start + size]
        held = part.sum(axis=1, dtype=np.float64)
        part *= (1.0 / np.sqrt(np.maximum(held, 1.0) * len(SIZES))).astype(np.float32)[:, None]
    return matrix, owner


def _no_text(text: str | None) -> bool:
    return not text or not _LETTER.search(text)


def train(docs: DataFrame, landmarks: int = 40, rows: int = 500, ridge: float = 1e-3) -> LanguageModel:
    """Fit on about ``rows`` labelled texts a language, with ``landmarks`` windows each.

    ``docs`` has doc_id, text and lang, learning rows only. The sample is drawn by hash, so its
    size does not depend on the input's; a language with fewer rows gives them all.
    """
    labelled = docs.select("doc_id", "text", "lang").filter("lang is not null and text is not null and doc_id is not null")
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(counts)
    if not names:
        return LanguageModel([], np.zeros((0, WIDTH), np.float32), np.zeros((0, 0)))
    share, few = (F.create_map(*[x for k in names for x in (F.lit(k), F.lit(min(1.0, n / counts[k])))]) for n in (rows, landmarks))
    sample = labelled.withColumn("_at", hash_share(F.col("doc_id"), F.lit("language"))).withColumn("_share", share[F.col("lang")])
    sample = sample.filter("_at < _share").withColumn("_land", F.col("_at") < few[F.col("lang")])

    def windows(batches):
        """One window of each landmark text, its middle one."""
        for batch in batches:
            texts = [x for x in batch.column(0).to_pylist() if not _no_text(x)]
            for run in sliced(texts):
                matrix, owner = presence(run)
                middle = [int(np.median(np.flatnonzero(owner == k)).item()) for k in range(len(run))]
                yield pa.RecordBatch.from_arrays([pa.array([matrix[k].tobytes() for k in middle], pa.binary())], ["row"])

    marks = [np.frombuffer(r.row, np.float32) for r in sample.filter("_land").select("text").mapInArrow(windows, "row binary").collect()]
    if not marks:  # small tables: every sampled text is a landmark
        marks = [np.frombuffer(r.row, np.float32) for r in sample.select("text").mapInArrow(windows, "row binary").collect()]
    if not marks:
        return LanguageModel([], np.zeros((0, WIDTH), np.float32), np.zeros((0, 0)))
    grid = np.unique(np.stack(marks), axis=0)
    sent = labelled.sparkSession.sparkContext.broadcast(grid)

    def products(batches):
        """Kernel products of each sampled text's windows, averaged; windows of one text share its label."""
        for batch in batches:
            pairs = [(x, k) for x, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if not _no_text(x)]
            at = 0
            for run in sliced([x for x, _ in pairs]):
                matrix, owner = presence(run)
                kernel = (matrix @ sent.value.T).astype(np.float64)
                starts = np.flatnonzero(np.diff(owner, prepend=-1))
                mean = np.add.reduceat(kernel, starts) / np.diff(np.append(starts, len(owner)))[:, None]
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in mean], pa.binary()), pa.array([k for _, k in pairs[at : at + len(run)]], pa.string())], ["row", "lang"])
                at += len(run)

    seen = sample.select("text", "lang").mapInArrow(products, "row binary, lang string").collect()
    x = np.stack([np.frombuffer(r.row, np.float64) for r in seen])
    names = sorted({r.lang for r in seen})
    y = np.array([[float(r.lang == k) for k in names] for r in seen])
    # one vote in all for each language, however many rows it has
    balance = np.sqrt(1.0 / y.sum(axis=0))[y.argmax(axis=1)][:, None]
    gram = (grid @ grid.T).astype(np.float64)
    a = x * balance
    # Nyström ridge regression: minimise |K w - y|^2 + ridge w' G w
    left = a.T @ a + ridge * gram / len(names) + 1e-9 * np.eye(len(grid))
    return LanguageModel(names, grid, np.linalg.solve(left, a.T @ (y * balance)))


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred and lang_score for each whole text."""
    # plain values: a broadcast object would ask the workers for this package
    sent = docs.sparkSession.sparkContext.broadcast((model.names, model.landmarks, model.weights))

    def label(texts: list[str]) -> list[tuple[str, float]]:
        names, landmarks, weights = sent.value
        known = [k for k, t in enumerate(texts) if names and not _no_text(t)]
        out = [("und", 0.0)] * len(texts)
        at = 0
        for run in sliced([texts[k] for k in known], 1 << 19):
            matrix, owner = presence(run)
            values = (matrix @ landmarks.T).astype(np.float64) @ weights
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            mean = np.add.reduceat(values, starts) / np.diff(np.append(starts, len(owner)))[:, None]
            best = mean.argmax(axis=1)
            positive = np.maximum(mean, 0.0)
            sure = positive[np.arange(len(run)), best] / np.maximum(positive.sum(axis=1), 1e-12)
            for k, b, s in zip(known[at : at + len(run)], best, sure, strict=True):
                out[k] = (names[b], float(min(1.0, s)))
            at += len(run)
        return out

    def labels(batches):
        for batch in batches:
            out = label(batch.column(batch.schema.get_field_index("text")).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x for x, _ in out], pa.string()), pa.array([s for _, s in out], pa.float64())], [*batch.schema.names, "lang_pred", "lang_score"])

    kept = docs.select(*[c for c in docs.columns if c not in ("lang_pred", "lang_score")])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(labels, f"{fields}, lang_pred string, lang_score double")
