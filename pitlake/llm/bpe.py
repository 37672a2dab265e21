"""Byte-level BPE encoding and decoding in numpy.

The distinct pieces of a batch stand in padded matrices, one for each span of
lengths, however long.  In every round each row merges its leftmost pair of smallest
rank: the ranks of neighbours come from a hash table of pairs, the row is compacted,
and only the two pairs beside the merge are looked up again.  Later pairs of that
rank are merged in the same round where that gives what single steps would give, so
that a row takes about as many rounds as it has different merges.  Rows without a
pair leave the matrix.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import texts_of
from .textbuf import ragged

_NONE = np.int32(2**31 - 1)
#: A worker forgets its pieces beyond so many.
CACHE_PIECES = 300_000


class Bpe:
    """Encoder and decoder for a file of base64 tokens and ranks."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        n = max(ranks.values()) + 1
        by_id: list[bytes] = [b""] * n
        for token, rank in ranks.items():
            by_id[rank] = token
        self.token_len = np.array([len(t) for t in by_id], np.int64)
        self.token_at = np.cumsum(self.token_len) - self.token_len
        self.token_bytes = np.frombuffer(b"".join(by_id), np.uint8)
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self._build(np.array(keys, np.int64), np.array(values, np.int32))
        self.forget()

    def _spot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _build(self, keys: np.ndarray, values: np.ndarray) -> None:
        """An open table at most a quarter full; collisions go to the next slot."""
        self.bits = max(4, int(np.ceil(np.log2(len(keys) * 4 + 1))))
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, _NONE, np.int32)
        spot = self._spot(keys)
        while len(keys):
            free = self.keys[spot] == -1
            self.keys[spot[free]] = keys[free]  # of several for one slot the last stays
            won = self.keys[spot] == keys
            self.values[spot[won]] = values[won]
            keys, values, spot = keys[~won], values[~won], (spot[~won] + 1) & ((1 << self.bits) - 1)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair; _NONE where it has none (or an id is -1)."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        shape, key = key.shape, key.ravel()
        spot = self._spot(key)
        out = np.full(len(key), _NONE, np.int32)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        while len(todo):
            at = spot[todo]
            there = self.keys[at]
            hit = there == key[todo]
            out[todo[hit]] = self.values[at[hit]]
            todo = todo[~hit & (there != -1)]
            spot[todo] = (spot[todo] + 1) & ((1 << self.bits) - 1)
        return out.reshape(shape)

    def _merge_rows(self, ids: np.ndarray) -> np.ndarray:
        """All merges of a matrix padded with -1; rows of the result are padded likewise.

        A round merges the leftmost pair of smallest rank of each row, and those of
        the same rank that follow it, up to the first merge that makes a pair of
        lower rank: so far the order of merges is the one of single steps.
        """
        done = np.full(ids.shape, -1, np.int32)
        rows = np.arange(len(ids))
        rank = np.full(ids.shape, _NONE, np.int32)  # of the pair that each id begins
        rank[:, :-1] = self.pair_rank(ids[:, :-1], ids[:, 1:])
        while len(rows):
            low = rank.min(axis=1)
            stop = low == _NONE
            if stop.any():
                done[rows[stop], : ids.shape[1]] = ids[stop]
                go = ~stop
                rows, ids, rank, low = rows[go], ids[go], rank[go], low[go]
                if not len(rows):
                    break
            line, at = np.nonzero(rank == low[:, None])
            if len(line) > len(rows):
                # of pairs that overlap, every second one
                run = np.ones(len(line), bool)
                run[1:] = (line[1:] != line[:-1]) | (at[1:] != at[:-1] + 1)
                head = np.flatnonzero(run)
                odd = (np.arange(len(line)) - np.repeat(head, np.diff(np.append(head, len(line))))) & 1
                line, at = line[odd == 0], at[odd == 0]
            width = ids.shape[1]
            new = low[line]
            touch = np.zeros(len(line), bool)  # stands right behind the merge before it
            touch[1:] = (line[1:] == line[:-1]) & (at[1:] == at[:-1] + 2)
            before = np.where(touch, new, np.where(at > 0, ids[line, np.maximum(at - 1, 0)], -1))
            behind = np.where(at < width - 2, ids[line, np.minimum(at + 2, width - 1)], -1)
            left, right = self.pair_rank(before, new), self.pair_rank(new, behind)
            if len(line) > len(rows):
                lower = np.cumsum((left <= new) | (right <= new))
                first = np.searchsorted(line, np.arange(len(rows)))
                earlier = np.concatenate(([0], lower))
                some = earlier[:-1] == earlier[first][line]
                line, at, new, touch, left, right = (x[some] for x in (line, at, new, touch, left, right))
            ids[line, at], rank[line, at] = new, right
            has = at > 0
            rank[line[has], (at - 1 - touch)[has]] = left[has]
            # compaction: the second id of each pair goes, and what is behind it moves up
            if len(line) == len(rows):
                behind = np.arange(width - 1)[None, :] > at[:, None]
                ids = np.where(behind, ids[:, 1:], ids[:, :-1])
                rank = np.where(behind, rank[:, 1:], rank[:, :-1])
                continue
            there = np.ones(ids.shape, bool)
            there[line, at + 1] = False
            gone = np.bincount(line, minlength=len(rows))
            ids, rank = ids[there], rank[there]
            if gone.min() == gone.max():
                ids, rank = ids.reshape(len(rows), -1), rank.reshape(len(rows), -1)
                continue
            count = width - gone
            place = np.repeat(np.arange(len(rows)), count), ragged(np.zeros(len(rows), np.int64), count)
            wide, wide_rank = np.full((len(rows), int(count.max())), -1, np.int32), np.full((len(rows), int(count.max())), _NONE, np.int32)
            wide[place], wide_rank[place] = ids, rank
            ids, rank = wide, wide_rank
        return done

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, one after another; number of ids of each)."""
        length = np.array([len(p) for p in pieces], np.int64)
        data = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        begin = np.cumsum(length) - length
        count = np.zeros(len(pieces), np.int64)
        parts, whose = [], []
        low, longest = 0, int(length.max(initial=0))
        while low < longest:
            high = max(2, low * 2)
            mine = np.flatnonzero((length > low) & (length <= high))
            step = max(1, 1 << 21 >> high.bit_length())
            for i in range(0, len(mine), step):
                some = mine[i : i + step]
                ids = np.full((len(some), high), -1, np.int32)
                row = np.repeat(np.arange(len(some)), length[some])
                ids[row, ragged(np.zeros(len(some), np.int64), length[some])] = data[ragged(begin[some], length[some])]
                ids = self._merge_rows(ids)
                there = ids >= 0
                count[some] = there.sum(axis=1)
                parts.append(ids[there])
                whose.append(some)
            low = high
        if not parts:
            return np.zeros(0, np.int32), count
        flat, whose = np.concatenate(parts), np.concatenate(whose)
        got = count[whose]
        at = np.zeros(len(pieces), np.int64)
        at[whose] = np.cumsum(got) - got
        return flat[ragged(at, count)], count

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.first, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after another; number of ids of each)."""
        if len(self.known) > CACHE_PIECES:
            self.forget()
        known, split = self.known, self.pattern.findall
        pieces, per = [], []
        for text in texts:
            found = split(text)
            pieces += found
            per.append(len(found))
        new = list({p for p in pieces if p not in known})
        if new:
            ids, count = self.encode_pieces([p.encode() for p in new])
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self.first = np.concatenate((self.first, len(self.flat) + np.cumsum(count) - count))
            self.flat, self.count = np.concatenate((self.flat, ids)), np.concatenate((self.count, count))
        index = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        count = self.count[index]
        ends = np.concatenate(([0], np.cumsum(count)))
        edge = np.concatenate(([0], np.cumsum(per))).astype(np.int64)
        return self.flat[ragged(self.first[index], count)], ends[edge[1:]] - ends[edge[:-1]]

    def decode(self, ids: np.ndarray, count: np.ndarray) -> list[bytes]:
        """The bytes of each text, from the ids of all of them."""
        size = self.token_len[ids]
        raw = self.token_bytes[ragged(self.token_at[ids], size)].tobytes()
        ends = np.concatenate(([0], np.cumsum(size)))
        edge = ends[np.concatenate(([0], np.cumsum(count))).astype(np.int64)].tolist()
        return [raw[a:b] for a, b in zip(edge[:-1], edge[1:])]


_loaded: dict[tuple[str, str], Bpe] = {}


def _coder(path: str, pattern: str) -> Bpe:
    return _loaded.get((path, pattern)) or _loaded.setdefault((path, pattern), Bpe(path, pattern))


def _slices(column: pa.Array, limit: int) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) with about ``limit`` characters at a time; null is empty."""
    first, held, size = 0, [], 0
    for i, text in enumerate(column):
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= limit:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def _encoded(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, pattern)
        for batch in batches:
            for first, texts in _slices(batch.column(1), 1_000_000):
                ids, count = coder.encode(texts)
                edge = pa.array(np.concatenate(([0], np.cumsum(count))).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.ListArray.from_arrays(edge, pa.array(ids))], ["doc_id", "ids"])

    return run


def _decoded(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, pattern)
        for batch in batches:
            ids = batch.column(1)
            count = np.nan_to_num(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64)
            for i in range(0, batch.num_rows, 256):
                some = ids.slice(i, 256)
                raw = coder.decode(some.flatten().to_numpy(zero_copy_only=False).astype(np.int64), count[i : i + 256])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 256), some, pa.array(raw, pa.binary())], ["doc_id", "ids", "decoded"])

    return run


def bpe_encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every whole text, without special tokens; null is empty."""
    texts = texts_of(docs, id_col, text_col)
    return texts.mapInArrow(_encoded(ranks, pattern), "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded binary) from (doc_id, ids); null ids give empty bytes."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoded(ranks, pattern), "doc_id long, ids array<int>, decoded binary")
