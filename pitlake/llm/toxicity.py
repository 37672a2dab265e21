"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text's words (runs of letters, digits and non-ASCII characters, ASCII lower
case) are read in overlapping windows.  A word's input is the embedding of its
hash beside the mean embedding of its hashed character 4-grams.  Two gated
recurrent units read the window from either side, attention pools their states,
and a logistic unit scores the pool; a text's score is that of its highest
window.  Forward and backward passes are numpy; training picks, in each epoch,
the highest window of every training text, as a label is the whole text's.  Tasks
pick it from the whole text; the driver holds one window of each text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import stage_table, texts_of
from .textbuf import Texts, mix, ragged, split_chunks, words

WINDOW, STRIDE = 32, 24
WORDS, CHARS, EMBED, HIDDEN, ATTEND = 1 << 13, 1 << 14, 8, 12, 8
#: Labelled rows to learn from, at most so many of each label (the first by hash of
#: the id), whole and of any length.
TRAIN_ROWS = 1_200
#: Steps of training, at least: few rows are gone through more often in each epoch.
LEAST_STEPS = 220
#: Tasks that pick windows from them.
TRAIN_TASKS = 12
_GAPS = np.ones(256, bool)
_GAPS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Inputs:
    """Windows over the words of some texts, and the hashed features of the distinct words.

    ``index`` (windows, WINDOW) holds word numbers, padded with ``n_words``.
    """

    def __init__(self, texts: Texts):
        low = Texts(_LOWER[texts.data], texts.bounds)
        start, end, text = words(low, _GAPS)
        h = low.hashes(start, end)
        distinct, one, number = np.unique(h, return_index=True, return_inverse=True)
        self.n_words = len(distinct)
        self.word = (distinct % np.uint64(WORDS)).astype(np.int64)
        # the distinct words once more, one mark before and two after each, for their 4-grams
        size = end[one] - start[one]
        bounds = np.concatenate(([0], np.cumsum(size + 3)))
        data = np.full(int(bounds[-1]), 32, np.uint8)
        data[ragged(bounds[:-1] + 1, size)] = low.data[ragged(start[one], size)]
        at = ragged(bounds[:-1], size)
        grams = Texts(data, bounds).window_hashes(4)[at] if len(at) else np.zeros(0, np.uint64)
        self.char = (grams % np.uint64(CHARS)).astype(np.int64)
        self.char_count = size
        self.char_first = np.cumsum(size) - size
        n = np.bincount(text, minlength=len(texts))
        per = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
        self.text = np.repeat(np.arange(len(texts)), per)
        first = np.cumsum(n) - n
        begin = ragged(np.zeros(len(per), np.int64), per) * STRIDE
        place = begin[:, None] + np.arange(WINDOW)
        inside = place < n[self.text][:, None]
        number = np.append(number, self.n_words)
        self.index = np.where(inside, number[np.minimum(place + first[self.text][:, None], len(number) - 1)], self.n_words)

    def vectors(self, p: dict[str, np.ndarray], some: np.ndarray | None = None) -> np.ndarray:
        """(words, 2 * EMBED) inputs of all words, or of ``some``."""
        if not self.n_words:
            return np.zeros((0, 2 * EMBED), np.float32)
        if some is None:
            char = np.add.reduceat(p["chars"][self.char], self.char_first, axis=0)
            return np.concatenate((p["words"][self.word], char / self.char_count[:, None].astype(np.float32)), axis=1)
        flat = self.char[ragged(self.char_first[some], self.char_count[some])]
        edge = np.cumsum(self.char_count[some]) - self.char_count[some]
        char = np.add.reduceat(p["chars"][flat], edge, axis=0) / self.char_count[some][:, None].astype(np.float32)
        return np.concatenate((p["words"][self.word[some]], char), axis=1)


def initial(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    shape = {"words": (WORDS, EMBED), "chars": (CHARS, EMBED), "attend": (2 * HIDDEN, ATTEND), "attend_b": (ATTEND,), "attend_v": (ATTEND,), "out": (2 * HIDDEN,), "out_b": (1,)}
    for side in "fb":
        shape |= {f"w{side}": (2 * EMBED, 3 * HIDDEN), f"u{side}": (HIDDEN, 3 * HIDDEN), f"b{side}": (3 * HIDDEN,)}
    scale = {"words": 0.03, "chars": 0.2}  # small: what is not learned should not be told apart
    zero = {"bf", "bb", "attend_b", "out_b"}
    return {k: np.zeros(s, np.float32) if k in zero else rng.normal(0, scale.get(k, 1 / np.sqrt(s[0])), s).astype(np.float32) for k, s in shape.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def _read(p: dict, side: str, x: np.ndarray, index: np.ndarray, steps: range, keep: bool):
    """States (WINDOW, windows, HIDDEN) of one direction; with ``keep``, what a backward pass needs."""
    n, u = len(index), p[f"u{side}"]
    pre = np.concatenate((x @ p[f"w{side}"] + p[f"b{side}"], np.zeros((1, 3 * HIDDEN), np.float32)))
    pad = len(x)
    h = np.zeros((n, HIDDEN), np.float32)
    states, trace = np.empty((WINDOW, n, HIDDEN), np.float32), []
    for t in steps:
        at = index[:, t]
        a, r_h = pre[at], h @ u
        gates = _sigmoid(a[:, : 2 * HIDDEN] + r_h[:, : 2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        new = np.tanh(a[:, 2 * HIDDEN :] + r * r_h[:, 2 * HIDDEN :])
        out = new + z * (h - new)
        gone = at == pad
        if gone.any():
            out[gone] = h[gone]
        if keep:
            trace.append((t, h, z, r, new, r_h[:, 2 * HIDDEN :], gone))
        states[t] = h = out
    return states, trace


def forward(p: dict, x: np.ndarray, index: np.ndarray, keep: bool = False):
    """Logits of windows; x holds the vectors of words, index their numbers (len(x) is padding)."""
    f, trace_f = _read(p, "f", x, index, range(WINDOW), keep)
    b, trace_b = _read(p, "b", x, index, range(WINDOW - 1, -1, -1), keep)
    states = np.concatenate((f, b), axis=2)
    tanh = np.tanh(states @ p["attend"] + p["attend_b"])
    e = tanh @ p["attend_v"]
    real = (index != len(x)).T
    e = np.where(real, e, -1e9)
    weight = np.exp(e - e.max(axis=0)) * real
    weight /= np.maximum(weight.sum(axis=0), 1e-9)
    pool = np.einsum("tn,tnd->nd", weight, states)
    logit = pool @ p["out"] + p["out_b"][0]
    return (logit, (states, tanh, weight, pool, trace_f, trace_b)) if keep else logit


def gradients(p: dict, x: np.ndarray, index: np.ndarray, label: np.ndarray) -> tuple[float, dict, np.ndarray]:
    """(mean loss, gradients of all but the embeddings, gradient of x) of the logistic loss."""
    logit, (states, tanh, weight, pool, trace_f, trace_b) = forward(p, x, index, keep=True)
    probability = _sigmoid(logit)
    loss = float(np.mean(np.logaddexp(0, logit) - label * logit))
    d = ((probability - label) / len(label)).astype(np.float32)
    g = {"out": pool.T @ d, "out_b": np.array([d.sum()], np.float32)}
    d_pool = d[:, None] * p["out"]
    d_states = weight[:, :, None] * d_pool
    d_weight = np.einsum("tnd,nd->tn", states, d_pool)
    d_e = weight * (d_weight - (weight * d_weight).sum(axis=0))
    g["attend_v"] = np.einsum("tn,tna->a", d_e, tanh)
    d_tanh = d_e[:, :, None] * p["attend_v"] * (1 - tanh**2)
    g["attend"] = np.einsum("tnd,tna->da", states, d_tanh)
    g["attend_b"] = d_tanh.sum(axis=(0, 1))
    d_states += d_tanh @ p["attend"].T
    d_x = np.zeros((len(x) + 1, 2 * EMBED), np.float32)
    for side, trace, d_side in (("f", trace_f, d_states[:, :, :HIDDEN]), ("b", trace_b, d_states[:, :, HIDDEN:])):
        u, w = p[f"u{side}"], p[f"w{side}"]
        d_u, d_pre = np.zeros_like(u), np.zeros((len(x) + 1, 3 * HIDDEN), np.float32)
        d_h = np.zeros_like(d_side[0])
        for t, before, z, r, new, r_h, gone in reversed(trace):
            d_h = d_h + d_side[t]
            live = np.where(gone[:, None], np.float32(0), d_h)
            d_new = live * (1 - z) * (1 - new**2)
            d_a = np.concatenate((live * (before - new) * z * (1 - z), d_new * r_h * r * (1 - r), d_new), axis=1)
            d_rec = d_a.copy()
            d_rec[:, 2 * HIDDEN :] *= r
            d_u += before.T @ d_rec
            np.add.at(d_pre, index[:, t], d_a)
            d_h = np.where(gone[:, None], d_h, live * z + d_rec @ u.T)
        d_pre = d_pre[:-1]
        g[f"u{side}"], g[f"w{side}"], g[f"b{side}"] = d_u, x.T @ d_pre, d_pre.sum(axis=0)
        d_x[:-1] += d_pre @ w.T
    return loss, g, d_x[:-1]


def window_logits(p: dict, inputs: Inputs, batch: int = 4096) -> np.ndarray:
    x = inputs.vectors(p)
    return np.concatenate([forward(p, x, inputs.index[i : i + batch]) for i in range(0, len(inputs.index), batch)] or [np.zeros(0, np.float32)])


def _picked(p: dict | None, seed: int):
    """(doc_id, window) of texts: the words of the highest window, or of a random one without ``p``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in split_chunks(batch.column(1), 500_000, rows=4_000):
                ids = batch.column(0).to_numpy(zero_copy_only=False)[first:last]
                start, end, text = words(Texts(_LOWER[texts.data], texts.bounds), _GAPS)
                inputs, raw = Inputs(texts), texts.data.tobytes()
                per = np.bincount(inputs.text, minlength=len(texts))
                edge = np.cumsum(per) - per
                if p is None:
                    chance = mix(ids.astype(np.int64).view(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
                    chosen = (chance % per.astype(np.uint64)).astype(np.int64)
                else:
                    chosen = np.lexsort((-window_logits(p, inputs), inputs.text))[edge] - edge
                n = np.bincount(text, minlength=len(texts))
                at = np.cumsum(n) - n + chosen * STRIDE
                until = np.minimum(at + WINDOW, np.cumsum(n))
                windows = [b" ".join(raw[c:d] for c, d in zip(start[a:b].tolist(), end[a:b].tolist())) for a, b in zip(at, until)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(windows, pa.binary())], ["doc_id", "window"])

    return run


def train(chosen: DataFrame, epochs: int = 14, batch: int = 96, rate: float = 0.02, seed: int = 7) -> dict[str, np.ndarray]:
    """Parameters learned from whole texts and their labels (doc_id, text, toxic: 0 or 1), each id once.

    Labels of one kind tell nothing apart: then, and without labels, there is only ``rate``, their mean (0 without).
    """
    p, rng = initial(seed), np.random.default_rng(seed)
    marks = {r["doc_id"]: r["toxic"] for r in chosen.select("doc_id", "toxic").collect()}
    ids = sorted(marks, key=lambda i: (i * 0x9E3779B97F4A7C15 % (1 << 64), i))
    label = np.array([marks[i] for i in ids], np.float32)
    if len(set(marks.values())) < 2:
        return {"rate": np.array(label.mean() if len(label) else 0.0)}
    p["out_b"][0] = np.log((label.sum() + 1) / (len(label) - label.sum() + 1))
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    step = 0
    for epoch in range(epochs):
        pick = _picked(None if epoch < 2 else p, seed + epoch)
        window = {r["doc_id"]: bytes(r["window"]) for r in chosen.select("doc_id", "text").mapInArrow(pick, "doc_id long, window binary").collect()}
        raw = [window[i] for i in ids]
        inputs = Inputs(Texts(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)))
        again = max(1, -(-LEAST_STEPS // (epochs * -(-len(label) // batch))))
        rounds = [rng.permutation(len(label)) for _ in range(again)]
        for mine in (order[i : i + batch] for order in rounds for i in range(0, len(order), batch)):
            index = inputs.index[mine]
            used = np.unique(index)
            used = used[used < inputs.n_words]
            local = np.searchsorted(used, np.minimum(index, inputs.n_words))
            if not len(used):
                continue
            _, g, d_x = gradients(p, inputs.vectors(p, used), local, label[mine])
            g["words"], g["chars"] = np.zeros_like(p["words"]), np.zeros_like(p["chars"])
            np.add.at(g["words"], inputs.word[used], d_x[:, :EMBED])
            count = inputs.char_count[used]
            np.add.at(g["chars"], inputs.char[ragged(inputs.char_first[used], count)], np.repeat(d_x[:, EMBED:] / count[:, None].astype(np.float32), count, axis=0))
            step += 1
            pace = rate * min(1.0, 2.0 * (1 - epoch / epochs)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, grad in g.items():
                m, v = moment[k]
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                p[k] -= (pace * m / (np.sqrt(v) + 1e-7)).astype(np.float32)
    return p


def _scored(p: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if "rate" in p:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(batch.num_rows, float(p["rate"])))], ["doc_id", "score"])
                continue
            for first, last, texts in split_chunks(batch.column(1), 500_000, rows=4_000):
                inputs = Inputs(texts)
                best = np.full(len(texts), -np.inf)
                np.maximum.at(best, inputs.text, window_logits(p, inputs))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(_sigmoid(best))], ["doc_id", "score"])

    return run


def held_out(doc_id):
    """Whether crc32 of the id as text leaves 0 when divided by 5: such rows are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def training_texts(texts: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, toxic) of at most ``rows`` ids of each label, one row an id, of those that have a text."""
    marked = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.join(texts.select("doc_id"), "doc_id", "left_semi")
    pool = None
    for toxic in (0, 1):
        some = marked.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        pool = some if pool is None else pool.union(some)
    ids = [(r["doc_id"], r["toxic"]) for r in pool.collect()]  # at most 2 * rows
    marks = texts.sparkSession.createDataFrame(ids, "doc_id long, toxic int")
    got = texts.join(F.broadcast(marks), "doc_id").groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.first("toxic").alias("toxic"))
    return stage_table(got.repartition(TRAIN_TASKS, "doc_id"), "training")


def fit_toxicity(texts: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    """Parameters from at most ``rows`` texts of each label."""
    return train(training_texts(texts, labels, rows))


def score_toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5).

    Only the text enters the score.  Without labelled texts every score is 0, and
    where all have the same label it is that label.  A text without words has the score of an empty
    window; null counts as empty.  An empty table gives an empty result; repeated
    rows are scored each; further columns are not looked at.  Rows without an id
    are left out.
    """
    texts = texts_of(docs, id_col, text_col)
    p = fit_toxicity(texts, labels, rows)
    scored = texts.mapInArrow(_scored(p), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
