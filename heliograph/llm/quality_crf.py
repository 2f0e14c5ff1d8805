"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is labelled good or bad from features of its own and of its neighbours; the chain adds
how labels follow each other. A document's score is the mean of its lines' forward-backward
marginals, weighted by their lengths. The field is fitted by gradient ascent on at most
SAMPLE_DOCS labelled documents (those with the smallest hashes of doc_id, of at most SAMPLE_LINES
lines each), whose lines all carry their document's label. Scoring is one narrow pass over whole texts, a block of
documents at a time: no shuffle, and the model is a few dozen numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliograph.llm import textvec
from heliograph.llm.common import text_of
from heliograph.runtime import ship_code

SAMPLE_DOCS = 3000
SAMPLE_LINES = 200
THRESHOLD = 0.7
STEPS = 150
HELD_OUT = 2  # remainder of crc32(doc_id) modulo 4 that is never learned from

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "symbol": b"#*$%&|<>", "cry": b"!",
    "digit": b"0123456789", "pipe": b"|", "wide": bytes(range(128, 256)),
}
_TABLES = {k: np.isin(np.arange(256), list(v)).astype(np.uint8) for k, v in _CLASSES.items()}
_SHARED = [1, 2, 3, 4, 5, 6, 7, 9]  # features that the neighbours lend
N_FEATURES = 11 + 2 * len(_SHARED) + 2


def line_features(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, length, features) of each line of a block; an empty text is one empty line."""
    ends = np.flatnonzero(data == 10)
    begins = np.concatenate(([0], ends[:-1] + 1))
    size = (ends - begins).astype(np.float32)
    count = {k: np.add.reduceat(t[data], begins, dtype=np.int32).astype(np.float32) for k, t in _TABLES.items()}
    at, to = textvec.word_spans(data)
    line = np.searchsorted(ends, at)
    words = np.bincount(line, minlength=len(ends)).astype(np.float32)
    hashes = textvec.span_hashes(data, at, to)
    again = np.zeros(len(at), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    repeats = np.bincount(line[again], minlength=len(ends)).astype(np.float32)
    full, letters = np.maximum(size, 1), np.maximum(count["upper"] + count["lower"], 1)
    own = np.stack([
        np.ones_like(size),
        count["upper"] / letters,
        np.minimum(1, 12 * count["symbol"] / full),
        np.minimum(1, 12 * count["cry"] / full),
        np.minimum(1, 4 * count["digit"] / full),
        np.minimum(1, 2 * count["pipe"] / np.maximum(words, 1)),
        np.minimum(1, 2 * repeats / np.maximum(words, 1)),
        (count["upper"] > 0.6 * letters).astype(np.float32),
        np.log1p(size) / 6,
        (size == 0).astype(np.float32),
        np.minimum(1, repeats / 8),
    ], axis=1).astype(np.float32)
    doc = textvec.owner(begins, starts)
    first = np.ones(len(ends), bool)
    first[1:] = doc[1:] != doc[:-1]
    last = np.roll(first, -1)
    before, after = np.roll(own[:, _SHARED], 1, axis=0), np.roll(own[:, _SHARED], -1, axis=0)
    before[first], after[last] = 0, 0
    edges = np.stack([first, last], axis=1).astype(np.float32)
    return doc, size + 1, np.concatenate([own, before, after, edges], axis=1)


class Field:
    """The model: weights of a good line over a bad one, and how labels follow (bad is 0, good is 1)."""

    def __init__(self, weights: np.ndarray, follow: np.ndarray, constant: float | None = None):
        self.weights, self.follow, self.constant = weights, follow, constant

    def marginals(self, doc: np.ndarray, features: np.ndarray, pairs: bool = False):
        """P(good) of each line; with pairs, also the expected counts of label pairs per document."""
        good = np.exp(np.clip(features @ self.weights, -30, 30))
        step = np.exp(np.clip(self.follow, -8, 8))
        first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        length = np.diff(np.append(first, len(doc)))
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        running = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0))  # documents longer than t
        ahead = np.empty((len(doc), 2))
        state = None
        for t, k in enumerate(running):
            rows = first[:k] + t
            state = np.ones((k, 2)) if t == 0 else state[:k] @ step
            state = state * np.stack([np.ones(k), good[rows]], axis=1)
            state /= state.sum(1, keepdims=True)
            ahead[rows] = state
        back = np.ones((len(doc), 2))
        expected = np.zeros((len(first), 2, 2)) if pairs else None
        for t in range(len(running) - 2, -1, -1):
            k = running[t + 1]
            rows = first[:k] + t
            after = back[rows + 1] * np.stack([np.ones(k), good[rows + 1]], axis=1)
            if pairs:
                joint = ahead[rows][:, :, None] * step[None] * after[:, None, :]
                expected[:k] += joint / joint.sum((1, 2), keepdims=True)
            state = after @ step.T
            back[rows] = state / state.sum(1, keepdims=True)
        both = ahead * back
        p = both[:, 1] / both.sum(1)
        return (p, expected, order) if pairs else p

    def scores(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The score of each document of a block."""
        if self.constant is not None:
            return np.full(len(starts), self.constant)
        doc, size, features = line_features(data, starts)
        p = self.marginals(doc, features)
        n = len(starts)
        return np.bincount(doc, size * p, n) / np.bincount(doc, size, n)


def fit(doc: np.ndarray, features: np.ndarray, label: np.ndarray, steps: int = STEPS, decay: float = 1e-3) -> Field:
    """The field for lines of documents 0, 1, ... with one label (0 or 1) per document.

    Labels weigh as often as they occur, so a text that tells nothing scores their usual share. With
    fewer than two labels the score is constant.
    """
    if len(set(label.tolist())) < 2:
        return Field(np.zeros(N_FEATURES), np.zeros((2, 2)), float(label[0]) if len(label) else 1.0)
    n = len(label)
    lines = np.bincount(doc, minlength=n)
    weight = 1 / np.sqrt(lines)
    weight /= (weight * lines).sum()
    truth, per_line = label[doc].astype(float), weight[doc]
    seen = np.zeros((2, 2))
    for y in (0, 1):
        seen[y, y] = (weight * (lines - 1))[label == y].sum()
    field = Field(np.zeros(features.shape[1]), np.zeros((2, 2)))
    momentum, scale = np.zeros(features.shape[1] + 4), np.zeros(features.shape[1] + 4)
    for t in range(1, steps + 1):
        p, expected, order = field.marginals(doc, features, pairs=True)
        slope = features.T @ (per_line * (truth - p)) - decay * field.weights
        slope_follow = seen - np.tensordot(weight[order], expected, 1) - 10 * decay * field.follow
        slopes = np.concatenate([slope, slope_follow.ravel()])
        momentum = 0.9 * momentum + 0.1 * slopes
        scale = 0.99 * scale + 0.01 * slopes**2
        move = 0.15 * (momentum / (1 - 0.9**t)) / (np.sqrt(scale / (1 - 0.99**t)) + 1e-9)
        field.weights = field.weights + move[:-4]
        field.follow = field.follow + move[-4:].reshape(2, 2)
    return field


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Field:
    """Fits the field on at most sample_docs documents, of longer ones than SAMPLE_LINES on that many
    lines from a place that depends on doc_id. Labels of held-out documents and null labels are left
    out; of contradictory labels of one document the lower holds."""
    ship_code(docs.sparkSession)
    usable = labels.where(F.col("quality").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % 4 != HELD_OUT))
    chosen = usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    texts = docs.select("doc_id", text_of("text").alias("text")).join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")

    def lines(batches):
        for batch in batches:
            ids, label = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, end, data, starts in textvec.blocks(batch.column(2).cast(pa.binary()).to_pylist()):
                doc, _, features = line_features(data, starts)
                cut = np.searchsorted(doc, np.arange(end - first + 1))
                skipped = [0 if i is None else int(i) * 0x9E3779B1 % max(1, int(b - a) - SAMPLE_LINES + 1) for i, a, b in zip(ids[first:end], cut, cut[1:])]
                parts = [features[a + k : min(a + k + SAMPLE_LINES, b)].tobytes() for k, a, b in zip(skipped, cut, cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[first:end], pa.int64()), pa.array(label[first:end], pa.int32()), pa.array(parts, pa.binary())],
                    names=["doc_id", "quality", "lines"],
                )

    found = texts.mapInArrow(lines, "doc_id long, quality int, lines binary")
    found = found.orderBy(F.xxhash64("doc_id"), "doc_id", "lines").limit(sample_docs)  # repeated doc_ids can't exceed the bound
    rows = sorted(found.collect(), key=lambda r: (r.doc_id, r.quality, bytes(r.lines)))
    parts = [np.frombuffer(bytes(r.lines), np.float32).reshape(-1, N_FEATURES) for r in rows]
    doc = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    features = np.concatenate(parts) if parts else np.zeros((0, N_FEATURES), np.float32)
    return fit(doc, features.astype(np.float64), np.asarray([r.quality for r in rows], int))


def score(docs: DataFrame, field: Field, threshold: float = THRESHOLD) -> DataFrame:
    """docs with held_out, score and predicted in place of columns of those names.

    Null and empty texts are one empty line and scored as such; a null doc_id isn't held out; rows
    are scored one by one, so repeated rows and ties need no rule. An empty table stays empty.
    """
    ship_code(docs.sparkSession)

    @F.arrow_udf("double")
    def scored(text: pa.Array) -> pa.Array:
        out = [field.scores(data, starts) for _, _, data, starts in textvec.blocks(text.cast(pa.binary()).to_pylist())]
        return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == HELD_OUT, F.lit(False))
    rows = docs.withColumns({"held_out": held_out, "score": scored(text_of("text"))})
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Fits and scores: doc_id, held_out, score, predicted of every document."""
    field = train(docs, labels, sample_docs)
    return score(docs.select("doc_id", "text"), field).select("doc_id", "held_out", "score", "predicted")
