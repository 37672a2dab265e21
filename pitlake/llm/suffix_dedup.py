"""Removal of repeated byte strings across a corpus, decided in suffix arrays.

Every window of ``width`` bytes is routed by its minimizer (the smallest hash of
the ``gram``-byte strings in it, the leftmost of equals): equal windows share it.
Windows with the same minimizer occurrence form one stretch of text.

1. Minimizers are counted.  One that stands once in the corpus holds no repeated
   window, and its stretch goes no further.
2. Stretches that are equal as a whole (by a 128-bit cryptographic digest of their
   bytes) are represented by the earliest; of the others every byte is repeated.
   Inside one stretch no window repeats, as all of them hold the one minimizer at
   different distances; so where a minimizer has one distinct stretch, there is
   nothing to sort.
3. The distinct stretches of a minimizer are laid side by side with their bytes,
   their suffixes are sorted (``lyndon_suffixes``), and runs of suffixes that agree
   in ``width`` bytes name the repeated windows.

No task gets an unbounded group: a minimizer with more than ``WHOLE`` distinct
stretches is dealt out by smaller ones, which share what all windows of FINE neighbours
share, and one with more than ``MANY`` by single windows.  So at most ``MANY`` distinct
stretches are sorted together, of a few bytes more than ``width`` each, and equal
ones are combined in every task before they are shuffled.  Nothing is capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import stage_table, texts_of
from .lyndon_suffixes import suffix_order
from .textbuf import Texts, mix, ragged, split_chunks

#: Minimizers with more distinct stretches than WHOLE are dealt out by stretches of FINE windows, beyond MANY by single windows.
WHOLE, FINE, MANY = 64, 6, 4_096
#: Bytes whose hash can be a minimizer.
GRAM = 32
#: Characters whose suffixes are sorted together.
SORT_CHARS = 600_000


def minimizers(texts: Texts, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text index, first window start, number of windows, minimizer hash, place of it) per stretch."""
    none = np.zeros(0, np.int64)
    n = len(texts.data)
    if n < width:
        return none, none, none, none.astype(np.uint64), none
    low = texts.window_hashes(gram)
    at = np.arange(len(low), dtype=np.int32)
    span, reach = width - gram + 1, 1
    while reach < span:
        step = min(reach, span - reach)
        other, other_at = low[step:], at[step:]
        low, at = low[: len(other)], at[: len(other)]
        less = other < low
        low, at = np.where(less, other, low), np.where(less, other_at, at)
        reach += step
    lengths = np.diff(texts.bounds)
    count = np.maximum(lengths - width + 1, 0)
    start = ragged(texts.bounds[:-1], count)
    if not len(start):
        return none, none, none, none.astype(np.uint64), none
    text = np.repeat(np.arange(len(texts)), count)
    at = at[start]
    opens = np.ones(len(start), bool)
    opens[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(opens)
    return text[head], start[head], np.diff(np.append(head, len(start))), low[start[head]], at[head].astype(np.int64)


def _merge(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Union of [start, end) within each doc."""
    if not len(doc):
        return doc, start, end
    by = np.lexsort((start, doc))
    doc, start, end = doc[by], start[by], end[by]
    group = np.cumsum(np.concatenate(([0], doc[1:] != doc[:-1])))
    big = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * big) - group * big
    opens = np.ones(len(doc), bool)
    opens[1:] = (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])
    head = np.flatnonzero(opens)
    return doc[head], start[head], reach[np.append(head[1:] - 1, len(doc) - 1)]


def _counted(width: int, gram: int):
    """(h, seen): the minimizers of a batch and how many stretches of it have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [minimizers(texts, width, gram)[3] for _, _, texts in split_chunks(batch.column(0))]
            if parts:
                h, seen = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(seen)], ["h", "seen"])

    return run


_STRETCH = "h long, u long, v long, n int, doc_id long, start long"


def _stretches(width: int, gram: int):
    """Rows: a stretch (h, digest u and v, n windows, doc, start), or with n = 0 a settled span, v its length, at any h."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            parts = []
            for first, last, texts in split_chunks(batch.column(1)):
                text, start, n, h, _ = minimizers(texts, width, gram)
                raw = memoryview(texts.data.tobytes())
                digest = b"".join([hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), (start + n + width - 1).tolist())])
                u = np.frombuffer(digest, np.int64).reshape(-1, 2)
                parts.append((h.view(np.int64), u[:, 0], u[:, 1], n, ids[first:last][text], start - texts.bounds[text]))
            if not parts:
                continue
            h, u, v, n, doc, start = map(np.concatenate, zip(*parts))
            by = np.lexsort((start, doc, v, u, h))
            h, u, v, n, doc, start = (x[by] for x in (h, u, v, n, doc, start))
            again = np.zeros(len(h), bool)
            again[1:] = (h[1:] == h[:-1]) & (u[1:] == u[:-1]) & (v[1:] == v[:-1])
            if again.any():  # a repeated row is the same document, not an earlier one
                fresh = ~again
                fresh[1:] |= (doc[1:] != doc[:-1]) | (start[1:] != start[:-1])
                h, u, v, n, doc, start, again = (x[fresh] for x in (h, u, v, n, doc, start, again))
            d, a, b = _merge(doc[again], start[again], start[again] + n[again] + width - 1)
            own, zero = ~again, np.zeros(len(d), np.int64)
            anywhere = mix(d.astype(np.uint64) * np.uint64(31) + a.astype(np.uint64)).view(np.int64)
            columns = ((h[own], anywhere), (u[own], zero), (v[own], b - a), (n[own], zero), (doc[own], d), (start[own], a))
            columns = [np.concatenate(x) for x in columns]
            columns[3] = columns[3].astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["h", "u", "v", "n", "doc_id", "start"])

    return run


_FOUND = "kind int, doc_id long, start long, n long, h long"


def _by_digest(width: int):
    """From stretches in order of (h, u, v, doc, start): kind 0, a removed span (n its length); kind 1, the earliest of equal ones."""

    def table(parts):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], ["kind", "doc_id", "start", "n", "h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the stretch before the batch: what makes its first row a copy or not
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            settled = rows[3] == 0
            parts = [(np.zeros(settled.sum(), np.int32), rows[4][settled], rows[5][settled], rows[2][settled], np.zeros(settled.sum(), np.int64))]
            h, u, v, n, doc, start = (x[~settled] for x in rows)
            if not len(h):
                yield table(parts)
                continue
            shifted = [np.concatenate(([x[0] if before is None else y], x[:-1])) for x, y in zip((h, u, v, doc, start), before or (h[0],) * 5)]
            copy = (h == shifted[0]) & (u == shifted[1]) & (v == shifted[2])
            row = copy & (doc == shifted[3]) & (start == shifted[4])
            if before is None:
                copy[0] = row[0] = False
            before = (h[-1], u[-1], v[-1], doc[-1], start[-1])
            copy &= ~row
            d, a, b = _merge(doc[copy], start[copy], start[copy] + n[copy] + width - 1)
            own, zero = ~copy & ~row, np.zeros(len(d), np.int64)
            parts.append((zero.astype(np.int32), d, a, b - a, zero))
            parts.append((np.ones(own.sum(), np.int32), doc[own], start[own], n[own].astype(np.int64), h[own]))
            yield table(parts)

    return run


_PIECE = "key long, doc_id long, start long, n int, piece binary"


def _cut_pieces(width: int, gram: int, whole: int, many: int):
    """The asked stretches of each text: whole, cut into FINE windows each, or into single windows; equal ones of a batch once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column(2)
            for first, last, texts in split_chunks(batch.column(1)):
                rows = asked.slice(first, last - first)
                flat = rows.flatten()
                owner = np.repeat(np.arange(last - first), rows.value_lengths().to_numpy(zero_copy_only=False))
                start, n, h, distinct = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                at = start + texts.bounds[owner]
                fits = at + n + width - 1 <= texts.bounds[owner + 1]  # not so only if texts share an id
                owner, at, n, h, distinct = owner[fits], at[fits], n[fits], h[fits], distinct[fits]
                key = h.view(np.uint64).copy()
                hot = distinct > whole
                if hot.any():
                    # a window's distance to its minimizer is the same wherever it stands
                    _, s0, _, h0, place = minimizers(texts, width, gram)
                    where = np.minimum(np.searchsorted(s0, at), max(len(s0) - 1, 0))
                    hot &= (s0[where] == at) if len(s0) else False
                    where = where[hot]
                    fine = np.where(distinct[hot] > many, 1, FINE)
                    far = place[where] - at[hot]
                    upper = far // fine  # class of the first window
                    lower = (far - n[hot] + 1) // fine
                    k = upper - lower + 1
                    cls = np.repeat(upper, k) - (ragged(np.zeros(len(k), np.int64), k))
                    m, fine = np.repeat(place[where], k), np.repeat(fine, k)
                    lo = np.maximum(m - (cls + 1) * fine + 1, np.repeat(at[hot], k))
                    hi = np.minimum(m - cls * fine, np.repeat(at[hot] + n[hot] - 1, k))
                    # what all windows of the class have in common, told by its hash
                    fine_key = mix(np.repeat(key[hot], k) ^ texts.hashes(m - cls * fine, m - (cls + 1) * fine + 1 + width) ^ (cls.astype(np.uint64) << np.uint64(1)))
                    owner = np.concatenate((owner[~hot], np.repeat(owner[hot], k)))
                    at = np.concatenate((at[~hot], lo))
                    n = np.concatenate((n[~hot], hi - lo + 1))
                    key = np.concatenate((key[~hot], fine_key))
                ids = batch.column(0).to_numpy(zero_copy_only=False)[first:last]
                raw = texts.data.tobytes()
                pieces = [raw[a:b] for a, b in zip(at.tolist(), (at + n + width - 1).tolist())]
                doc, start, n = ids[owner], at - texts.bounds[owner], n.astype(np.int32)
                # of equal pieces under one key the earliest goes with its bytes; the others are settled, their length below 0
                first_of: dict[tuple[int, bytes], int] = {}
                for i in np.lexsort((start, doc)).tolist():
                    one = first_of.setdefault((int(key[i]), pieces[i]), i)
                    if one != i:
                        n[i], pieces[i] = (-len(pieces[i]) if (doc[i], start[i]) != (doc[one], start[one]) else 0), b""
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(doc), pa.array(start), pa.array(n), pa.array(pieces, pa.binary())],
                    ["key", "doc_id", "start", "n", "piece"],
                ).filter(pa.array(n != 0))

    return run


def _repeated(groups: list[list[tuple[int, int, int, bytes]]], width: int) -> tuple[np.ndarray, ...]:
    """Removed spans (doc, start, end) of groups of distinct pieces (doc, start, windows, bytes)."""
    groups.sort(key=lambda g: sum(len(p[3]) for p in g))
    pieces = [p for g in groups for p in g]
    sizes = np.array([len(p[3]) for p in pieces], np.int64)
    text = np.frombuffer(b"\0".join([p[3] for p in pieces] + [b""]), np.uint8)
    per = np.array([len(g) for g in groups])
    # each piece ends in 1, each group in 0, bytes count from 2
    row_end = np.cumsum(np.add.reduceat(sizes + 1, np.cumsum(per) - per) + 1)
    shift = np.repeat(np.arange(len(groups)), per)
    begin = np.cumsum(sizes + 1) - (sizes + 1) + shift
    symbols = np.zeros(int(row_end[-1]), np.int16)
    raw_begin = np.cumsum(sizes + 1) - (sizes + 1)
    spot = ragged(begin, sizes)
    symbols[spot] = text[ragged(raw_begin, sizes)].astype(np.int16) + 2
    symbols[begin + sizes] = 1
    order = suffix_order(symbols, np.concatenate(([0], row_end)))

    windows = np.array([p[2] for p in pieces], np.int64)
    is_start = np.zeros(len(symbols), bool)
    is_start[ragged(begin, windows)] = True
    near = np.flatnonzero(is_start[order[1:]] & is_start[order[:-1]])
    row = np.searchsorted(row_end, order, side="right")
    near = near[row[near] == row[near + 1]]
    view = np.lib.stride_tricks.sliding_window_view(symbols, width)
    same = np.zeros(len(order), bool)  # slot i+1 agrees with slot i in the first width symbols
    for i in range(0, len(near), 20_000):
        part = near[i : i + 20_000]
        same[part[(view[order[part]] == view[order[part + 1]]).all(axis=1)] + 1] = True
    in_run = same.copy()
    in_run[:-1] |= same[1:]
    slots = np.flatnonzero(in_run)
    if not len(slots):
        return (np.zeros(0, np.int64),) * 3
    run = np.cumsum(~same[slots])
    piece = np.searchsorted(begin, order[slots], side="right") - 1
    doc = np.array([p[0] for p in pieces], np.int64)[piece]
    start = np.array([p[1] for p in pieces], np.int64)[piece] + order[slots] - begin[piece]
    by = np.lexsort((start, doc, run))
    later = np.zeros(len(by), bool)
    later[1:] = run[by][1:] == run[by][:-1]
    by = by[later]
    return _merge(doc[by], start[by], start[by] + width)


def _sort_suffixes(width: int):
    """From pieces in order of their key to removed spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans: list[tuple[np.ndarray, ...]] = []
        groups: list[list[tuple]] = []
        held, group, last = 0, {}, None

        def close():
            nonlocal held
            if len(group) > 1:
                one = [(*where, len(piece) - width + 1, piece) for piece, where in group.items()]
                groups.append(one)
                held += sum(len(p[3]) + 1 for p in one)
            group.clear()

        def flush():
            nonlocal held
            if groups:
                spans.append(_repeated(groups, width))
                groups.clear()
                held = 0

        def rows():
            doc, start, end = _merge(*map(np.concatenate, zip(*spans)))
            spans.clear()
            return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(start), pa.array(end - start)], ["doc_id", "start", "n"])

        for batch in batches:
            for key, doc, start, n, piece in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if n < 0:
                    spans.append((np.array([doc]), np.array([start]), np.array([start - n])))
                    continue
                if key != last:
                    close()
                    last = key
                    if held >= SORT_CHARS:
                        flush()
                seen = group.get(piece)
                if seen is None:
                    group[piece] = (doc, start)
                    continue
                if (doc, start) < seen:
                    group[piece], (doc, start) = (doc, start), seen
                if (doc, start) != group[piece]:
                    spans.append((np.array([doc]), np.array([start]), np.array([start + len(piece)])))
            if len(spans) > 10_000:
                yield rows()
        close()
        flush()
        if spans:
            yield rows()

    return run


def repeated_spans(docs: DataFrame, width: int = 100, id_col: str = "doc_id", text_col: str = "text", whole: int = WHOLE, many: int = MANY) -> DataFrame:
    """Spans of bytes that lie in a ``width``-byte string which also starts earlier.

    Earlier means a smaller id, or the same text and an earlier start.  Returns
    (doc_id, start, n); spans of a text may overlap.  Null texts are empty; texts
    shorter than ``width`` have no span.  Rows that repeat an id and its text are
    one document; different texts of one id share their spans.
    """
    gram = min(GRAM, width)
    texts = texts_of(docs, id_col, text_col)
    # counted in the map tasks first: a minimizer in a third of all texts is a row a task here
    seen = texts.select("text").mapInArrow(_counted(width, gram), "h long, seen long").groupBy("h").agg(F.sum("seen").alias("seen")).where("seen > 1").select("h", "seen")
    stretches = texts.mapInArrow(_stretches(width, gram), _STRETCH)
    # spans settled in a batch have no minimizer and stay
    met = stretches.join(seen.hint("shuffle_hash"), "h", "left").where("n = 0 or seen > 1").select("h", "u", "v", "n", "doc_id", "start")
    # equal stretches meet, not all of a minimizer
    found = stage_table(
        met.repartition("h", "u", "v").sortWithinPartitions("h", "u", "v", "doc_id", "start").mapInArrow(_by_digest(width), _FOUND), "stretches"
    )
    ones = found.where("kind = 1").select("doc_id", "start", "n", "h")
    several = ones.groupBy("h").agg(F.count("*").alias("distinct")).where("distinct > 1")
    asked = ones.join(several.hint("shuffle_hash"), "h").groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "h", "distinct")).alias("asked"))
    compared = (
        texts.join(asked.hint("shuffle_hash"), "doc_id")
        .select("doc_id", "text", "asked")
        .mapInArrow(_cut_pieces(width, gram, whole, many), _PIECE)
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_sort_suffixes(width), "doc_id long, start long, n long")
    )
    return found.where("kind = 0").select("doc_id", "start", "n").unionByName(compared)


def _kept(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1), batch.column(2).to_pylist()):
                raw, kept, runs, at, last = (text.as_py() or "").encode(), [], 0, 0, -1
                for start, n in sorted((s["start"], s["n"]) for s in spans or ()):
                    runs += start > last
                    last = max(last, start + n)
                    if start > at:
                        kept.append(raw[at:start])
                    at = max(at, start + n)
                kept.append(raw[at:])
                kept = b"".join(kept)
                out.append((len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace") if with_text else None))
            n_bytes, removed, n_spans, digest, text = zip(*out) if out else ([],) * 5
            columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in (n_bytes, removed, n_spans)), pa.array(digest, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(text, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def suffix_dedup(
    docs: DataFrame, width: int = 100, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True, whole: int = WHOLE, many: int = MANY
) -> DataFrame:
    """Each text without its repeated bytes, with counts and the digest of what is left.

    One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed
    runs), kept_sha256 and, if asked, kept_text (bytes cut inside a character show
    as U+FFFD).  Null and empty texts keep nothing and have no span.  An empty
    table gives an empty result; further columns of ``docs`` are not looked at.
    """
    texts = texts_of(docs, id_col, text_col)
    spans = repeated_spans(docs, width, id_col, text_col, whole, many)
    spans = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    return (
        texts.join(spans.hint("shuffle_hash"), "doc_id", "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(_kept(with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * with_text)
    )
