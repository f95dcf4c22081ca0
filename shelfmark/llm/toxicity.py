"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, column, free_memory, in_spread, raw_texts, texts

ORDERS = (4, 6, 8)
DIMENSIONS = 1 << 19
# Labelled documents the classifier is fitted on, the first by a hash of their id. Their features
# take at most DIMENSIONS numbers each, whatever their length.
TRAINING_LIMIT = 12_000
THRESHOLD = 0.7
PENALTY = 0.3
DOCUMENTS = 500  # of the training set that are looked at in one step of the fit
# Words whose n-grams a task remembers; beyond it the memory is emptied.
REMEMBERED = 200_000
ASCII_MARKS = bytes(b for b in range(128) if not (chr(b).isalnum()))
WORDS = bytes.maketrans(ASCII_MARKS, b" " * len(ASCII_MARKS))


class Model(NamedTuple):
    weights: np.ndarray  # DIMENSIONS floats: classifier weight times log-count ratio
    bias: float


def word_features(word: str, dimensions: int) -> np.ndarray:
    """Hashed n-grams of one word between boundary marks; a short word is one n-gram itself."""
    marked = f"^{word}$"
    grams = {
        marked[i : i + n] for n in ORDERS for i in range(max(1, len(marked) - n + 1))
    }
    return np.array([zlib.crc32(g.encode()) % dimensions for g in grams], np.int32)


class Features:
    """The set of hashed n-grams of a text, with the n-grams of known words remembered."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.known: dict[bytes, np.ndarray] = {}

    def of(self, text: bytes | None) -> np.ndarray:
        words = set(text.lower().translate(WORDS).split()) if text else ()
        if not words:
            return np.zeros(0, np.int32)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        for w in words:
            if w not in known:
                known[w] = word_features(w.decode(errors="replace").lower(), self.dimensions)
        return np.unique(np.concatenate([known[w] for w in words]))


def log_count_ratios(offsets: np.ndarray, indices: np.ndarray, toxic: np.ndarray, dimensions: int) -> np.ndarray:
    """log of (share of the n-gram in toxic texts / share in others), each count raised by one."""
    p, q = np.ones(dimensions), np.ones(dimensions)
    for a, b, bad in zip(offsets[:-1], offsets[1:], toxic):
        (p if bad else q)[indices[a:b]] += 1  # an n-gram stands once in a text
    return np.log(p / p.sum()) - np.log(q / q.sum())


def fit_logistic(offsets, indices, toxic, ratios, penalty: float = PENALTY, rounds: int = 60) -> Model:
    """Logistic regression on binary features times their ratios, by limited-memory BFGS."""
    sign = np.where(toxic, 1.0, -1.0)
    size = len(ratios)

    def parts():
        """Some documents at a time: their slice, n-grams and the document of each n-gram."""
        for a in range(0, len(toxic), DOCUMENTS):
            own = slice(a, min(a + DOCUMENTS, len(toxic)))
            grams = indices[offsets[own.start] : offsets[own.stop]]
            yield own, grams, np.repeat(np.arange(own.stop - a), np.diff(offsets[a : own.stop + 1]))

    def loss(point):
        scaled, gradient = ratios * point[:-1], np.zeros(size + 1)
        value = penalty / 2 * point[:-1] @ point[:-1]
        for own, grams, rows in parts():
            margin = sign[own] * (np.bincount(rows, scaled[grams], own.stop - own.start) + point[-1])
            pull = -sign[own] * np.exp(-np.logaddexp(0, margin))
            gradient[:-1] += np.bincount(grams, pull[rows], size)
            gradient[-1] += pull.sum()
            value += np.logaddexp(0, -margin).sum()
        gradient[:-1] = gradient[:-1] * ratios + penalty * point[:-1]
        return value, gradient

    point = np.zeros(len(ratios) + 1)
    value, gradient = loss(point)
    past: list[tuple] = []
    for _ in range(rounds):
        if np.abs(gradient).max() < 1e-3 * max(1, len(toxic)) ** 0.5:
            break
        step, used = -gradient, []
        for s, y in reversed(past):
            a = (s @ step) / (s @ y)
            step = step - a * y
            used.append(a)
        if past:
            s, y = past[-1]
            step *= (s @ y) / (y @ y)
        else:
            step /= max(1.0, np.abs(step).sum())
        for (s, y), a in zip(past, reversed(used)):
            step = step + s * (a - (y @ step) / (s @ y))
        length = 1.0
        while length > 1e-6:
            other = point + length * step
            new, slope = loss(other)
            if new <= value + 1e-4 * length * (gradient @ step):
                break
            length /= 2
        else:
            break
        s, y = other - point, slope - gradient
        if s @ y > 1e-10:
            past = [*past[-7:], (s, y)]
        point, value, gradient = other, new, slope
    return Model((point[:-1] * ratios).astype(np.float32), float(point[-1]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    limit: int = TRAINING_LIMIT,
    dimensions: int = DIMENSIONS,
) -> Model:
    """Fit the classifier on up to ``limit`` labelled documents.

    Labels are taken in the order of a hash of their id. Rows without id or label are passed over;
    of differing labels for one id the larger counts, of differing texts the smallest. Without
    both kinds of label the model scores every text by the share of toxic labels (half of one
    without any).
    """
    chosen = (
        labels.select(column(doc_id).alias("doc_id"), column(label).cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    training = (
        texts(docs, doc_id, text).join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    )

    def extract(batches):
        free_memory()
        features = Features(dimensions)
        for batch in batches:
            found = [features.of(t).tobytes() for t in raw_texts(batch["text"])]
            yield pa.RecordBatch.from_arrays([batch["toxic"], pa.array(found, pa.binary())], names=["toxic", "grams"])

    def learn(batches):
        free_memory()
        toxic, sizes, grams = [], [], []
        for batch in batches:
            toxic += batch["toxic"].to_pylist()
            lists = batch["grams"].cast(pa.large_binary())
            bounds = np.frombuffer(lists.buffers()[1], np.int64)[lists.offset : lists.offset + len(lists) + 1]
            sizes.append(np.diff(bounds) // 4)
            if bounds[-1] > bounds[0]:
                # One copy of a batch's n-grams; its texts and rows are let go.
                grams.append(np.frombuffer(lists.buffers()[2], np.int32)[bounds[0] // 4 : bounds[-1] // 4].copy())
        toxic = np.array(toxic, int) > 0
        if toxic.all() or not toxic.any():
            share = (toxic.sum() + 1) / (len(toxic) + 2)
            model = Model(np.zeros(dimensions, np.float32), float(np.log(share / (1 - share))))
        else:
            offsets = np.r_[0, np.cumsum(np.concatenate(sizes))]
            indices = np.empty(offsets[-1], np.int32)
            end = len(indices)
            while grams:
                part = grams.pop()
                indices[end - len(part) : end] = part
                end -= len(part)
            free_memory()
            ratios = log_count_ratios(offsets, indices, toxic, dimensions)
            model = fit_logistic(offsets, indices, toxic, ratios)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.weights.tobytes()]), pa.array([model.bias])], names=["weights", "bias"]
        )

    # The bounded training set is fitted in one task.
    extracted = in_spread(training).mapInArrow(extract, "toxic int, grams binary")
    row = extracted.repartition(1).mapInArrow(learn, "weights binary, bias double").first()
    return Model(np.frombuffer(row.weights, np.float32), row.bias)


def toxicity(df: DataFrame, text: str, model: Model) -> Column:
    """The probability that a text is toxic. Null and empty texts get that of a text without n-grams."""
    bounded_batches(df)
    sent = df.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    @F.arrow_udf("double")
    def score(batch: pa.Array) -> pa.Array:
        weights, bias = sent.value
        features = Features(len(weights))
        margin = np.array([bias + weights[features.of(t)].sum(dtype=float) for t in raw_texts(batch)], float)
        del features
        return pa.array(np.exp(-np.logaddexp(0, -margin)))

    return score(column(text).cast("string"))
