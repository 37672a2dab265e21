"""Near duplicates by SimHash fingerprints, found through counts of bits by segment.

A fingerprint of 64 bits is mapped to a point with one coordinate for each of its 32
segments of two bits: how many bits are set there.  The Manhattan distance of two
points is never more than the number of bits in which the fingerprints differ, so a
link within ``distance`` bits is a pair of points within that Manhattan distance.

Grids find those: the segments are dealt into ``distance + spare`` blocks, and of a
pair that is near, ``spare`` blocks at least have the same coordinates, as every
block that differs uses up a distance of 1.  A grid for each choice of ``spare``
blocks has the coordinates in them as its cells.  Distinct fingerprints meet in
their cells, inside a task; Manhattan distance rules pairs out, the number of
differing bits decides.  What leaves a cell joins its members and is no more than
they are.  A cell with too many members is dealt out once more, by a part of the
segments that its grid leaves open, for each of ``distance + 1`` parts: again one
of them must agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import stage_table, texts_of
from .textbuf import Texts, ragged, split_chunks, words

#: The differing bits of a link, the words of a shingle, the seed of its hash.
DISTANCE, SHINGLE, SEED = 4, 4, 42
SEGMENTS = 32
#: Two segments at random agree so often.
AGREE = 0.375
#: Members of a cell that grids are chosen for, on average; members beyond which a cell is dealt out once more, and how many times.
CELL, CROWDED, AGAIN = 500, 1 << 15, 2
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_ONES = np.uint64(0x5555555555555555)


def shingle_hashes(texts: Texts, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text index, XXH64) of each shingle of lower-cased words, in order; the words of a shorter text are one."""
    lower = Texts(_LOWER[texts.data], texts.bounds)
    start, end, text = words(lower)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    length = end - start
    first_byte = np.cumsum(length + 1) - length - 1
    joined = np.full(int(length.sum()) + len(length), 0x20, np.uint8)
    joined[ragged(first_byte, length)] = lower.data[ragged(start, length)]
    n = np.bincount(text, minlength=len(texts))
    first = np.cumsum(n) - n
    left = first[text] + n[text] - np.arange(len(text))  # words from here to the text's end
    head = np.flatnonzero((left >= size) | ((np.arange(len(text)) == first[text]) & (n[text] < size)))
    last = head + np.minimum(left[head], size) - 1
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    spans = zip(first_byte[head].tolist(), (first_byte[last] + length[last]).tolist())
    return text[head], np.fromiter((digest(raw[a:b], SEED) for a, b in spans), np.uint64, len(head))


def fingerprints(text: np.ndarray, h: np.ndarray, n_texts: int) -> np.ndarray:
    """uint64 for each text: the bits that are set in over half of its hashes; 0 without any.  ``text`` ascends."""
    total = np.bincount(text, minlength=n_texts)
    ones = np.zeros((n_texts, 64), np.int64)
    for i in range(0, len(h), 1 << 16):
        own = text[i : i + (1 << 16)]
        bits = np.unpackbits(h[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        edge = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        ones[own[edge]] += np.add.reduceat(bits, edge, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _fingerprinted(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in split_chunks(batch.column(1)):
                prints = fingerprints(*shingle_hashes(texts, shingle), len(texts))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(prints.view(np.int64))], ["doc_id", "print"])

    return run


# -- the embedding --------------------------------------------------------------------


def embed(prints: np.ndarray) -> np.ndarray:
    """The 32 coordinates of each fingerprint, two bits each in one number: 0, 1 or 2."""
    upper = prints >> np.uint64(1)
    return ((prints ^ upper) & _ONES) | (prints & upper & _ONES) << np.uint64(1)


def embedded(column: str) -> Column:
    """``embed`` as a SQL expression."""
    upper, ones = f"shiftrightunsigned({column}, 1)", f"{int(_ONES)}L"
    return F.expr(f"(({column} ^ {upper}) & {ones}) | shiftleft({column} & {upper} & {ones}, 1)")


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of points as ``embed`` gives them: coordinates 0 and 2 differ in the upper bit alone."""
    x = a ^ b
    odd = x & _ONES
    return np.bitwise_count(odd) + 2 * np.bitwise_count((x >> np.uint64(1)) & ~odd & _ONES)


def near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Which fingerprints differ in ``distance`` bits at most: the lower bound first, the bits of those that pass."""
    ok = manhattan(embed(a), embed(b)) <= distance
    a, b = np.broadcast_arrays(a, b)
    ok[ok] = np.bitwise_count(a[ok] ^ b[ok]) <= distance
    return ok


def _mask(segments) -> int:
    """The bits of some segments, as a signed number."""
    bits = sum(3 << (2 * s) for s in segments)
    return bits - (1 << 64) if bits >> 63 else bits


def _dealt(segments: list[int], parts: int) -> list[list[int]]:
    return [segments[i::parts] for i in range(parts)]


def grids(n: int, distance: int = DISTANCE, cell: int = CELL) -> list[int]:
    """Masks of the grids for ``n`` fingerprints: the fewest whose cells hold about ``cell`` at most if bits are random."""
    spare = 1
    while spare < SEGMENTS - distance and n * AGREE ** (SEGMENTS * spare // (distance + spare)) > cell and spare < 5:
        spare += 1
    blocks = _dealt(list(range(SEGMENTS)), distance + spare)
    return [_mask(s for b in chosen for s in b) for chosen in combinations(blocks, spare)]


def finer(mask: int, distance: int = DISTANCE) -> list[int]:
    """Masks that fix one more part of the segments that ``mask`` leaves open, for each part; none if all are fixed."""
    left = [s for s in range(SEGMENTS) if not mask >> (2 * s) & 3]
    return [_mask([*(s for s in range(SEGMENTS) if s not in left), *part]) for part in _dealt(left, distance + 1)] if len(left) > distance else []


# -- inside cells ---------------------------------------------------------------------


def join_sparse(cell: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is near in small cells; ``cell`` numbers come in runs."""
    edge = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    left = np.repeat(np.append(edge[1:], len(cell)), np.diff(np.append(edge, len(cell)))) - np.arange(len(cell))
    at, step, found = np.flatnonzero(left > 1), 1, []
    while len(at):
        ok = at[near(prints[at], prints[at + step], distance)]
        found.append((ok, ok + step))
        step += 1
        at = at[left[at] > step]
    if not found:
        return prints[:0], prints[:0]
    i, j = (np.concatenate(x) for x in zip(*found))
    label, before = np.arange(len(cell)), None
    while before is None or (label != before).any():
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
    moved = np.flatnonzero(label != np.arange(len(cell)))
    return prints[moved], prints[label[moved]]


def join_dense(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for one large cell, component by component: who is reached is taken out, so that many who are near cost little."""
    a, b, rest = [], [], prints
    while len(rest):
        reached, rest = rest[:1], rest[1:]
        while len(reached) and len(rest):
            now, reached = reached[:32], reached[32:]
            ok = near(now[:, None], rest[None, :], distance)
            hit = ok.any(axis=0)
            a.append(rest[hit])
            b.append(now[ok[:, hit].argmax(axis=0)])
            reached, rest = np.concatenate((reached, rest[hit])), rest[~hit]
    return tuple(np.concatenate(x) if x else prints[:0] for x in (a, b))


def _met(distance: int, crowded: int | None, small: int = 64, rows: int = 100_000):
    """From (mask, cell, print), cells in runs: links (a, b, mask null), and members (print, print, mask) of crowded cells."""

    def batch(a: np.ndarray, b: np.ndarray, mask: np.ndarray | None = None) -> pa.RecordBatch:
        marks = pa.nulls(len(a), pa.int64()) if mask is None else pa.array(mask)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), marks], ["a", "b", "mask"])

    def settled(mask: np.ndarray, cell: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole cells."""
        number = np.cumsum(np.append(True, (cell[1:] != cell[:-1]) | (mask[1:] != mask[:-1])))
        size = np.bincount(number)[number]
        few = size <= small
        yield batch(*join_sparse(number[few], prints[few], distance))
        edge = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
        for i in edge[size[edge] > small]:
            part = slice(i, i + size[i])
            if crowded is not None and size[i] > crowded:
                yield batch(prints[part], prints[part], mask[part])
            else:
                yield batch(*join_dense(prints[part], distance))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, passing = [np.zeros(0, t) for t in (np.int64, np.int64, np.uint64)], None
        for got in batches:
            new = [got.column(c).to_numpy() for c in (0, 1)] + [got.column(2).to_numpy().view(np.uint64)]
            if passing is not None:  # further members of a crowded cell
                same = (new[0] == passing[0]) & (new[1] == passing[1])
                yield batch(new[2][same], new[2][same], new[0][same])
                if same.all():
                    continue
                new, passing = [x[~same] for x in new], None
            held = [np.concatenate(x) for x in zip(held, new)]
            mask, cell, prints = held
            if len(cell) < rows:
                continue
            ends = np.flatnonzero((cell[1:] != cell[:-1]) | (mask[1:] != mask[:-1]))
            if len(ends):
                yield from settled(*(x[: ends[-1] + 1] for x in held))
                mask, cell, prints = held = [x[ends[-1] + 1 :] for x in held]
            if crowded is not None and len(cell) > crowded:
                yield batch(prints, prints, mask)
                held, passing = [x[:0] for x in held], (mask[0], cell[0])
        if len(held[1]):
            yield from settled(*held)

    return run


def linked(prints: DataFrame, distance: int = DISTANCE, cell: int = CELL, crowded: int = CROWDED) -> DataFrame:
    """(a, b): enough links among the distinct fingerprints of column ``print`` to join all that differ in ``distance`` bits or fewer."""
    masks, out = grids(prints.count(), distance, cell), None
    now = prints.select("print", embedded("print").alias("point"), F.explode(F.array(*(F.lit(m) for m in masks))).alias("mask"))
    for again in range(AGAIN + 1):
        dealt = now.select("mask", F.expr("point & mask").alias("cell"), "print").repartition("mask", "cell").sortWithinPartitions("mask", "cell")
        met = stage_table(dealt.mapInArrow(_met(distance, crowded if again < AGAIN else None), "a long, b long, mask long"), "cells")
        links = met.where("mask is null").select("a", "b")
        out = links if out is None else out.unionByName(links)
        left = met.where("mask is not null")
        if again == AGAIN or left.isEmpty():
            return out
        # a few hundred grids at most, each with those that refine it
        parents = {m: finer(m, distance) or [m] for m in {r[0] for r in left.select("mask").distinct().collect()}}
        steps = F.create_map(*(x for m, f in parents.items() for x in (F.lit(m), F.array(*(F.lit(y) for y in f)))))
        now = left.select(F.col("a").alias("print"), embedded("a").alias("point"), F.explode(steps[F.col("mask")]).alias("mask")).distinct()


def simhash_duplicates(
    docs: DataFrame,
    distance: int = DISTANCE,
    shingle: int = SHINGLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    cell: int = CELL,
    crowded: int = CROWDED,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest id reachable by links).

    Fingerprints link when they differ in ``distance`` bits or fewer.  Null, empty
    and blank texts have the fingerprint zero, which links like any other.  Texts of
    fewer than ``shingle`` words are one shingle.  Repeated rows keep a row each.
    Rows without an id take part and are returned; their component is null if none
    in it has an id.  An empty table gives an empty result; further columns are not looked at.
    """
    texts = texts_of(docs, id_col, text_col, without_id=True)
    printed = stage_table(texts.mapInArrow(_fingerprinted(shingle), "doc_id long, print long"), "prints")
    distinct = stage_table(printed.groupBy("print").agg(F.min("doc_id").alias("low")), "distinct")
    links = linked(distinct.select("print"), distance, cell, crowded)
    label = components(links).select(F.col("node").alias("print"), "component")
    placed = stage_table(distinct.join(label.hint("merge"), "print", "left").select("print", F.coalesce("component", "print").alias("component"), "low"), "placed")
    lowest = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    of_print = stage_table(placed.select("print", "component").join(lowest.hint("merge"), "component").select("print", "component_id"), "lowest")
    out = printed.join(of_print.hint("merge"), "print")
    return out.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
