"""Ranked lexical search by the threshold algorithm.

Documents become a forward index that holds, of each text, its number of terms and
the counts of those terms that some query asks for.  Tasks read that index in
shards of bounded size.  In a shard every term has a list of its documents by
falling impact; a query reads its terms' lists in turn, some entries of each a
round, and looks up each document it meets for the first time in the forward
index, which gives its whole score.  What the next entries of all lists would give
together is the threshold: no document not met yet can have more.  A query stops
as soon as that is strictly below its kth score, so that ties are still seen.
The kth score is carried from shard to shard; tasks hand over their k best.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .frames import stage_table, texts_of, with_rows
from .textbuf import Texts, ragged, split_chunks, words

#: What separates terms, as bytes; the constants of the score stand in ``impacts`` and ``_weights``.
SEPARATORS = rb"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
_TERM = re.compile(rb"[^" + SEPARATORS + rb"]+")
_GAPS = np.array([_TERM.match(bytes([b])) is None for b in range(256)])
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
#: Postings of a shard; a document with more is a shard of its own.
SHARD = 1_000_000
#: Bytes of query text that one pass over the documents serves.
QUERY_BYTES = 4_000_000
#: Entries of each list that the first round reads; later rounds read twice as many as the round before.
ROUND = 16


def terms_of(text: str | None) -> list[bytes]:
    return _TERM.findall((text or "").encode(errors="replace").lower())


class Vocabulary:
    """Numbers for a set of terms, found by hash and confirmed by their bytes."""

    def __init__(self, terms: list[bytes]):
        size = np.array([len(t) for t in terms], np.int64)
        end = np.cumsum(size)
        texts = Texts(np.frombuffer(b"".join(terms), np.uint8), np.concatenate(([0], end)))
        h = texts.hashes(end - size, end)
        by = np.argsort(h, kind="stable")
        self.data, self.hash, self.number, self.start, self.size = texts.data, h[by], by, (end - size)[by], size[by]
        if (self.hash[1:] == self.hash[:-1]).any():
            raise ValueError("two query terms share a hash")

    def look_up(self, texts: Texts, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the words are terms, their numbers)."""
        h = texts.hashes(start, end)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        here = np.flatnonzero((self.hash[at] == h) & (self.size[at] == end - start))
        at = at[here]
        if len(here):
            same = texts.data[ragged(start[here], self.size[at])] == self.data[ragged(self.start[at], self.size[at])]
            edge = np.cumsum(self.size[at]) - self.size[at]
            equal = np.logical_and.reduceat(same, edge)
            here, at = here[equal], at[equal]
        return here, self.number[at]


def _indexed(vocabulary: Vocabulary, n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in split_chunks(batch.column(1)):
                lower = Texts(_LOWER[texts.data], texts.bounds)
                start, end, text = words(lower, _GAPS)
                n = np.bincount(text, minlength=len(texts))
                here, number = vocabulary.look_up(lower, start, end)
                key, count = np.unique(text[here] * n_terms + number, return_counts=True)
                edge = np.searchsorted(key, np.arange(len(texts) + 1) * n_terms).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(edge), pa.array(x.astype(np.int32))) for x in (key % n_terms, count)]
                out = pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(n), *lists], ["doc_id", "n", "terms", "counts"])
                yield out.filter(pa.array(n > 0))

    return run


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, occurrences: int) -> np.ndarray:
    """The share of a term's weight that each posting earns, in integers."""
    m = 75 + (25 * n * documents) // occurrences
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Shard:
    """Some documents: their forward records, and for every term its list by falling impact."""

    def __init__(self, n_terms: int, ids: np.ndarray, edge: np.ndarray, term: np.ndarray, impact: np.ndarray):
        self.ids, self.edge, self.term, self.impact = ids, edge, term, impact
        by = np.lexsort((-impact, term))
        self.list_doc = np.repeat(np.arange(len(ids)), np.diff(edge))[by]
        self.list_impact = impact[by]
        self.list_edge = np.searchsorted(term[by], np.arange(n_terms + 1))
        self.met = np.zeros(len(ids), bool)

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Whole scores of some documents, each with at least one term, from their forward records."""
        count = self.edge[docs + 1] - self.edge[docs]
        at = ragged(self.edge[docs], count)
        return np.add.reduceat(self.impact[at] * weight[self.term[at]], np.cumsum(count) - count)


class Best:
    """The k best (score, id) so far: higher scores first, then smaller ids, no id (the largest number) last."""

    def __init__(self, k: int):
        self.k, self.score, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.uint64)

    @property
    def kth(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        some = score >= max(1, self.kth)
        score, ids = np.concatenate((self.score, score[some])), np.concatenate((self.ids, ids[some]))
        by = np.lexsort((ids, -score))[: self.k]
        self.score, self.ids = score[by], ids[by]


def search(shard: Shard, terms: np.ndarray, weights: np.ndarray, dense: np.ndarray, best: Best, entries: int = ROUND) -> int:
    """Add to ``best`` what the shard has for one query; the number of documents looked up.

    ``weights`` belong to ``terms``, which are distinct; ``dense`` holds them for all terms of the index.
    """
    at, end = shard.list_edge[terms], shard.list_edge[terms + 1]
    some = (at < end) & (weights > 0)
    at, end, weights = at[some], end[some], weights[some]
    looked_up = []
    while len(at):
        threshold = int((shard.list_impact[at] * weights).sum())
        if threshold < max(1, best.kth):
            break
        count = np.minimum(end - at, entries)
        docs = np.unique(shard.list_doc[ragged(at, count)])
        docs = docs[~shard.met[docs]]
        if len(docs):
            shard.met[docs] = True
            looked_up.append(docs)
            best.add(shard.scores(docs, dense), shard.ids[docs])
        at = at + count
        left = at < end
        at, end, weights, entries = at[left], end[left], weights[left], entries * 2
    for docs in looked_up:
        shard.met[docs] = False
    return sum(map(len, looked_up))


_NO_ID = np.uint64(2**64 - 1)
_SIGN = np.uint64(1 << 63)


def _shards(batches: Iterator[pa.RecordBatch], n_terms: int, documents: int, occurrences: int, limit: int) -> Iterator[Shard]:
    held, size = [], 0

    def built() -> Shard:
        ids, n, term, tf, count = (np.concatenate(x) for x in zip(*held))
        held.clear()
        impact = impacts(tf, np.repeat(n, count), documents, occurrences)
        return Shard(n_terms, ids, np.concatenate(([0], np.cumsum(count))), term, impact)

    for batch in batches:
        ids = batch.column(0)
        order = ids.fill_null(0).to_numpy().view(np.uint64) ^ _SIGN  # signed order in unsigned numbers
        order = np.where(ids.is_null().to_numpy(zero_copy_only=False), _NO_ID, order)
        n, count = batch.column(1).to_numpy(), batch.column(2).value_lengths().to_numpy().astype(np.int64)
        term, tf = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
        edge = np.concatenate(([0], np.cumsum(count)))
        first = 0
        while first < len(n):
            last = max(first + 1, int(np.searchsorted(edge, edge[first] + limit - size, side="right")) - 1)
            held.append((order[first:last], n[first:last], term[edge[first] : edge[last]], tf[edge[first] : edge[last]], count[first:last]))
            size += int(edge[last] - edge[first])
            first = last
            if size >= limit or first < len(n):
                yield built()
                size = 0
    if held:
        yield built()


def _searched(queries: list[tuple[int, np.ndarray, np.ndarray]], n_terms: int, documents: int, occurrences: int, k: int, limit: int):
    """From index rows to the k best of each query in this task: (item, doc_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        dense = np.zeros(n_terms, np.int64)
        for shard in _shards(batches, n_terms, documents, occurrences, limit):
            for own, (_, terms, weights) in zip(best, queries):
                dense[terms] = weights
                search(shard, terms, weights, dense, own)
                dense[terms] = 0
        for own, (item, _, _) in zip(best, queries):
            if len(own.ids):
                ids = pa.array((own.ids ^ _SIGN).view(np.int64), mask=own.ids == _NO_ID)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own.ids), item)), ids, pa.array(own.score)], ["item", "doc_id", "score"])

    return run


def _one_pass(texts: DataFrame, asked: list[tuple[int, str]], k: int, limit: int) -> DataFrame | None:
    """(item, doc_id, score) with the k best of every task, for a bounded number of queries."""
    counted = [(item, Counter(terms_of(text))) for item, text in asked]
    number = {t: i for i, t in enumerate(sorted({t for _, c in counted for t in c}))}
    if not number:
        return None
    run = _indexed(Vocabulary(list(number)), len(number))
    index = stage_table(texts.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>"), "terms")
    documents, occurrences = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # at most one row for each term of the queries
    found = dict(index.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * found.get(t, 0) + 1))) for t in range(len(number))], np.int64)
    queries = []
    for item, terms in counted:
        own = np.array(sorted(number[t] for t in terms), np.int64)
        repeats = np.array([n for _, n in sorted((number[t], n) for t, n in terms.items())], np.int64)
        queries.append((item, own, weight[own] * repeats))
    run = _searched(queries, len(number), documents, occurrences, k, limit)
    return index.where(F.size("terms") > 0).mapInArrow(run, "item long, doc_id long, score long")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    query_bytes: int = QUERY_BYTES,
    shard: int = SHARD,
) -> DataFrame:
    """The ``k`` best documents for each row of ``items``: item_id, rank (from 1), doc_id, score; equal scores by ascending id.

    Every row of ``docs`` is a document, also one that repeats another or has no id
    (it ranks behind equals that have one, and its doc_id is null).  Null and empty
    texts, and those without a term, match nothing and count nowhere.  Items
    without a term have no rows; rows of ``items`` that share an id, or have none,
    are ranked each for itself.  Empty tables give an empty result; further columns
    are not looked at.  Queries of more than ``query_bytes`` are dealt out over as
    many passes over the documents as hold that much each.
    """
    texts = texts_of(docs, id_col, text_col, without_id=True)
    numbered, row = with_rows(items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")))
    size = numbered.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = math.ceil(size / query_bytes)
    best = None
    for i in range(passes):
        asked = numbered.where(F.pmod(F.xxhash64(row), F.lit(passes)) == i).select(row, "text")
        part = _one_pass(texts, [tuple(r) for r in asked.toLocalIterator()], k, shard)
        if part is not None:
            best = part if best is None else best.unionByName(part)
    if best is None:
        best = docs.sparkSession.createDataFrame([], "item long, doc_id long, score long")
    by = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.join(numbered.select(F.col(row).alias("item"), "item_id"), "item").select("item_id", "rank", "doc_id", "score")
