"""Quality classifier: cumulative-link ordinal regression on graded ratings.

A text is the square roots of the shares of its hashed byte n-grams, and of the
share of its words that only repeat the word before.  One weight vector is shared by all grades; ordered thresholds t_1 < t_2 < ... turn a score s
into P(grade <= k) = sigmoid(t_k - s).  From these come the expected grade and the
tail probability P(grade >= least), by which texts are selected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import importable, texts_of
from .textbuf import Texts, split_chunks, words

BUCKETS, GRAM = 1 << 12, 3
#: Rated rows that the model is fitted on, at most (the first by hash of their id).
RATED_ROWS = 3_000


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, features: np.ndarray) -> np.ndarray:
        """(rows, grades - 1): P(grade > k)."""
        z = self.thresholds[None, :] - (features @ self.weights)[:, None]
        return 1.0 / (1.0 + np.exp(np.clip(z, -60, 60)))


def features(texts: Texts, buckets: int = BUCKETS, gram: int = GRAM) -> np.ndarray:
    """(texts, buckets) float32, the last bucket for repeated words; rows of texts shorter than an n-gram are 0."""
    n = len(texts)
    if len(texts.data) < gram:
        return np.zeros((n, buckets), np.float32)
    start, end, owner = words(texts)
    word = texts.hashes(start, end)
    again = np.flatnonzero((word[1:] == word[:-1]) & (owner[1:] == owner[:-1])) + 1
    repeated = np.bincount(owner[again], minlength=n) / np.maximum(np.bincount(owner, minlength=n), 1)
    bucket = (texts.window_hashes(gram) % np.uint64(buckets - 1)).astype(np.int64)
    text = np.repeat(np.arange(n), np.diff(texts.bounds))[: len(bucket)]
    inside = np.arange(len(bucket)) + gram <= texts.bounds[text + 1]
    count = np.bincount(text[inside] * buckets + bucket[inside], minlength=n * buckets).reshape(n, buckets)
    shares = count / np.maximum(count.sum(axis=1, keepdims=True), 1)
    shares[:, -1] = repeated
    return np.sqrt(shares).astype(np.float32)


def fit(x: np.ndarray, grade: np.ndarray, n_grades: int, steps: int = 300, rate: float = 0.3, decay: float = 1e-5) -> OrdinalModel:
    """Maximum likelihood by Adam; thresholds are a first one and positive gaps, so they stay ordered."""
    rows = np.arange(len(grade))
    w = np.zeros(x.shape[1], np.float32)
    raw = np.zeros(n_grades - 1)  # first threshold, then logarithms of gaps
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (w, raw)]
    balance = len(grade) / (n_grades * np.maximum(np.bincount(grade, minlength=n_grades), 1))
    each = np.sqrt(balance)[grade]  # halfway between equal rows and equal grades
    each /= each.sum()
    for step in range(1, steps + 1):
        gaps = np.exp(raw[1:])
        cut = np.concatenate(([raw[0]], raw[0] + np.cumsum(gaps)))
        below = 1.0 / (1.0 + np.exp(-np.clip(cut[None, :] - (x @ w)[:, None], -60, 60)))
        padded = np.concatenate((np.zeros((len(x), 1)), below, np.ones((len(x), 1))), axis=1)
        p = np.maximum(padded[rows, grade + 1] - padded[rows, grade], 1e-9)
        slope = padded * (1 - padded)
        up, low = slope[rows, grade + 1] / p * each, slope[rows, grade] / p * each
        g_w = (up - low).astype(np.float32) @ x + decay * w
        g_cut = np.zeros(n_grades + 1)
        np.add.at(g_cut, grade + 1, -up)
        np.add.at(g_cut, grade, low)
        g_cut = g_cut[1:-1]
        tail = np.cumsum(g_cut[::-1])[::-1]
        g_raw = np.concatenate(([tail[0]], tail[1:] * gaps))
        for value, gradient, (m, v) in zip((w, raw), (g_w, g_raw), state):
            m *= 0.9
            m += 0.1 * gradient
            v *= 0.999
            v += 0.001 * gradient**2
            value -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(value.dtype)
    return OrdinalModel(w.astype(np.float32), np.concatenate(([raw[0]], raw[0] + np.cumsum(np.exp(raw[1:])))))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, texts in split_chunks(batch.column(1), rows=1_000):
            x = features(texts).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array([r.tobytes() for r in x], pa.binary())], ["grade", "x"])


def train(docs: DataFrame, ratings: DataFrame, rows: int = RATED_ROWS) -> OrdinalModel:
    """Fit on at most ``rows`` of ``ratings`` (doc_id, grade from 0), the first by hash of the id.

    Ratings without an id, a grade or a document are passed over; without any, all
    grades are as likely.
    """
    rated = ratings.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.max("grade").cast("int").alias("grade"))
    some = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()  # at most ``rows``
    marks = docs.sparkSession.createDataFrame([(r["doc_id"], r["grade"]) for r in some], "doc_id long, grade int")
    got = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").select("grade", "text").mapInArrow(_featured, "grade int, x binary").collect()
    if not got:
        return OrdinalModel(np.zeros(BUCKETS, np.float32), np.zeros(1))
    # rows come in any order; the sums of a fit should not depend on it
    got.sort(key=lambda r: (r["grade"], bytes(r["x"])))
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in got), np.float16).reshape(len(got), BUCKETS).astype(np.float32)
    grade = np.array([r["grade"] for r in got])
    return fit(x, grade, max(2, int(grade.max()) + 1))


def _rated(model: OrdinalModel, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in split_chunks(batch.column(1), rows=1_000):
                above = model.above(features(texts)).astype(np.float64)
                tail = above[:, min(least, above.shape[1]) - 1]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(above.sum(axis=1)), pa.array(tail)], ["doc_id", "expected_grade", "tail_probability"])

    return run


def graded(labels: DataFrame, quality: Column, toxic: Column) -> DataFrame:
    """(doc_id, grade): 0 poor, 1 good but toxic, 2 good."""
    good = F.coalesce(quality, F.lit(0))
    return labels.where(quality.isNotNull()).select("doc_id", F.when(good < 1, 0).when(F.coalesce(toxic, F.lit(0)) > 0, 1).otherwise(2).alias("grade"))


def rate_quality(docs: DataFrame, ratings: DataFrame, least: int = 1, keep: float = 0.5, rows: int = RATED_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, expected_grade, tail_probability, selected.

    tail_probability is P(grade >= ``least``); selected if it reaches ``keep``.  A
    null text is empty; texts without an n-gram get the thresholds' own
    probabilities.  An empty table gives an empty result; repeated rows are rated
    each; further columns are not looked at.  Rows without an id
    are left out.
    """
    texts = texts_of(docs, id_col, text_col)
    model = train(texts, ratings, rows)
    rated = texts.mapInArrow(_rated(model, least), "doc_id long, expected_grade double, tail_probability double")
    return rated.withColumn("selected", F.col("tail_probability") >= keep)


def _selected(model: OrdinalModel, least: int, keep: float, text_index: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in split_chunks(batch.column(text_index), rows=1_000):
                above = model.above(features(texts))
                good = above[:, min(least, above.shape[1]) - 1] >= keep
                yield batch.slice(first, last - first).filter(pa.array(good))

    return run


def select_quality(docs: DataFrame, ratings: DataFrame, least: int = 1, keep: float = 0.5, rows: int = RATED_ROWS) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any further columns) that ``rate_quality`` selects."""
    importable(docs.sparkSession)
    model = train(docs, ratings, rows)
    return docs.mapInArrow(_selected(model, least, keep, docs.columns.index("text")), docs.schema)
