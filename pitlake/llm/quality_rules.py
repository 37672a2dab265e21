"""Quality rules: counts of each text, and a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed byte n-grams are counted, one over trusted texts and
one over the whole corpus.  A text's verdict is the mean, over its n-grams, of the
logarithm of their ratio, held against a fixed threshold.  The counts of repeated
lines and words compare bytes, not hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import texts_of
from .textbuf import Texts, split_chunks, words

BUCKETS, GRAM, SMOOTH = 1 << 14, 4, 1.0
#: Trusted rows from which the target is counted, at most (the first by hash of their id).
TRUSTED_ROWS = 20_000
#: Least mean log ratio of a kept text.
THRESHOLD = -0.2
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _repeats(text: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found twice or more in its text, found earlier in its text) for numbered items in order of place."""
    by = np.lexsort((number, text))  # stable: equal ones stay in order
    same = np.zeros(len(number), bool)
    same[1:] = (number[by][1:] == number[by][:-1]) & (text[by][1:] == text[by][:-1])
    twice = same.copy()
    twice[:-1] |= same[1:]
    out = np.zeros((2, len(number)), bool)
    out[0, by], out[1, by] = twice, same
    return out[0], out[1]


def text_counts(texts: Texts) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    n = len(texts)
    start, end, text = words(texts)
    total = lambda per_byte: (c := np.concatenate(([0], np.cumsum(per_byte))))[texts.bounds[1:]] - c[texts.bounds[:-1]]
    lead = np.concatenate(([0], np.cumsum((texts.data & 0xC0) != 0x80)))
    n_words = np.bincount(text, minlength=n)
    word_chars = np.bincount(text, weights=lead[end] - lead[start], minlength=n).astype(np.int64)

    # lines: the text cut at every \n, of which those with a word count
    cut = np.flatnonzero(texts.data == 10)
    line_start = np.union1d(texts.bounds[:-1][np.diff(texts.bounds) > 0], cut + 1)
    line_start = line_start[line_start < len(texts.data)]
    owner = texts.owner(line_start)
    stop = np.searchsorted(cut, line_start)
    line_end = np.minimum(np.append(cut, len(texts.data))[stop], texts.bounds[owner + 1])
    first_word = np.searchsorted(start, line_start)
    worded = np.append(start, len(texts.data) + 1)[first_word] < line_end
    owner, line_start, line_end = owner[worded], line_start[worded], line_end[worded]
    _, again = _repeats(owner, texts.numbers(line_start, line_end))
    n_dup = np.bincount(owner[again], minlength=n)

    # 3-word windows inside a text
    word = texts.numbers(start, end)
    at = np.flatnonzero(text[2:] == text[:-2]) if len(word) > 2 else np.zeros(0, np.int64)
    pair = np.unique(word[at] << 32 | word[at + 1], return_inverse=True)[1]
    twice, _ = _repeats(text[at], pair << 32 | word[at + 2])
    covered = np.zeros(len(word), bool)
    for i in range(3):
        covered[at[twice] + i] = True
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": total(_SYMBOL[texts.data]),
        "n_dup_lines": n_dup,
        "n_repeat_words": np.bincount(text[covered], minlength=n),
    }


def _grams(texts: Texts, gram: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, bucket) of each byte n-gram inside a text."""
    if len(texts.data) < gram:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bucket = (texts.window_hashes(gram) % np.uint64(buckets)).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), np.diff(texts.bounds))[: len(bucket)]
    inside = np.arange(len(bucket)) + gram <= texts.bounds[text + 1]
    return text[inside], bucket[inside]


def _counted(gram: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, buckets), np.int64)
        for batch in batches:
            trusted = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for first, last, texts in split_chunks(batch.column(0)):
                text, bucket = _grams(texts, gram, buckets)
                sums[0] += np.bincount(bucket, minlength=buckets)
                sums[1] += np.bincount(bucket[trusted[first:last][text]], minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums[0:1]), pa.list_(pa.int64())), pa.array(list(sums[1:2]), pa.list_(pa.int64()))], ["raw", "target"])

    return run


def fit_ratio(docs: DataFrame, trusted: DataFrame, gram: int = GRAM, buckets: int = BUCKETS, trusted_rows: int = TRUSTED_ROWS) -> np.ndarray:
    """log(target / raw) per bucket, smoothed; the corpus counts cover every row of ``docs``.

    ``docs`` has doc_id and text, ``trusted`` has doc_id.  At most ``trusted_rows``
    trusted ids are taken, the first by the hash of the id.
    """
    some = trusted.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted_rows)
    ids = [r["doc_id"] for r in some.collect()]  # at most trusted_rows
    marks = docs.sparkSession.createDataFrame([(i, True) for i in ids], "doc_id long, trusted boolean")
    marked = docs.join(F.broadcast(marks), "doc_id", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    sums = marked.mapInArrow(_counted(gram, buckets), "raw array<long>, target array<long>")
    pairs = sums.select(F.posexplode(F.arrays_zip("raw", "target")).alias("bucket", "n"))
    table = np.zeros((2, buckets))
    for r in pairs.groupBy("bucket").agg(F.sum("n.raw").alias("raw"), F.sum("n.target").alias("target")).collect():
        table[:, r["bucket"]] = r["raw"], r["target"]
    share = (table + SMOOTH) / (table.sum(axis=1, keepdims=True) + SMOOTH * buckets)
    return np.log(share[1] / share[0])


_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _scored(ratio: np.ndarray, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in split_chunks(batch.column(1)):
                counts = text_counts(texts)
                text, bucket = _grams(texts, gram, len(ratio))
                n = np.bincount(text, minlength=len(texts))
                score = np.bincount(text, weights=ratio[bucket], minlength=len(texts)) / np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), *(pa.array(counts[c].astype(np.int64)) for c in _COLUMNS), pa.array(score)],
                    ["doc_id", *_COLUMNS, "mean_log_ratio"],
                )

    return run


def quality_rules(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, mean_log_ratio, kept.

    base_failed: fewer than 50 words, or more than half of the words in repeated
    3-word windows.  kept: not base_failed, and a mean log ratio of ``threshold``
    or more (0 for texts shorter than an n-gram).  Null counts as empty and fails.
    An empty table gives an empty result; further columns are not looked at.  Rows without an id
    are left out.
    """
    texts = texts_of(docs, id_col, text_col)
    ratio = fit_ratio(texts, trusted)
    scored = texts.mapInArrow(_scored(ratio, GRAM), "doc_id long, " + ", ".join(f"{c} long" for c in _COLUMNS) + ", mean_log_ratio double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("mean_log_ratio") >= threshold))
