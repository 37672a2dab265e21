"""Suffix arrays of many short strings at once, by linear grouping.

Phase 1 groups suffixes by Lyndon prefix: groups are processed in descending
order; a suffix's pointer leads to the nearest suffix before it that lies in a
smaller group, and the suffixes pointed at move to new groups just above their
old ones, ordered by how many pointers they got.  Phase 2 emits the order in one
ascending sweep along the same pointers.  No string is renamed, nothing recurs.

The strings do not interact, so each step takes the next group of every string
together in numpy; the number of steps is that of the longest string only.
"""

from __future__ import annotations

import numpy as np

from .textbuf import ragged


def suffix_order(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Flat suffix arrays of the strings symbols[bounds[i]:bounds[i+1]].

    Each string must be non-empty and end in its only 0, its smallest symbol.
    The result holds flat positions, string after string.
    """
    bounds = np.asarray(bounds, np.int64)
    if len(bounds) < 2:
        return np.zeros(0, np.int64)
    group, prev = _group(symbols, bounds)
    return _emit(group, prev, bounds)


def _group(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position its final group (by first slot) and its previous-smaller pointer."""
    n = int(bounds[-1])
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    key = rows * (int(symbols.max()) + 1) + symbols
    order = np.argsort(key, kind="stable")  # slot -> position
    sorted_key = key[order]
    opens = np.ones(n, bool)
    opens[1:] = sorted_key[1:] != sorted_key[:-1]
    heads = np.flatnonzero(opens)
    size = np.zeros(n, np.int64)
    size[heads] = np.diff(np.append(heads, n))
    group, slot = np.empty(n, np.int64), np.empty(n, np.int64)
    group[order] = np.repeat(heads, size[heads])
    slot[order] = np.arange(n)
    prev = np.arange(-1, n - 1)
    prev[bounds[:-1]] = -1
    target = np.zeros(n, bool)

    end, floor = bounds[1:].copy(), bounds[:-1]
    live = np.arange(len(end))
    while live.size:
        stop = end[live]
        first = group[order[stop - 1]]
        end[live] = first
        live = live[first > floor[live]]
        count = stop - first
        members = order[ragged(first, count)]
        own = np.repeat(first, count)
        to = prev[members]
        chase = np.flatnonzero(to >= 0)
        while True:
            chase = chase[group[to[chase]] >= own[chase]]
            if not chase.size:
                break
            to[chase] = prev[to[chase]]
            prev[members[chase]] = to[chase]
            chase = chase[to[chase] >= 0]
        hit = to[to >= 0]
        if not hit.size:
            continue
        hit, pointers = np.unique(hit, return_counts=True)
        old = group[hit]
        by = np.lexsort((pointers, old))
        hit, pointers, old = hit[by], pointers[by], old[by]
        changes = np.ones(len(hit), bool)
        changes[1:] = old[1:] != old[:-1]
        at = np.flatnonzero(changes)
        moved = np.diff(np.append(at, len(hit)))
        parent = old[at]
        rest = size[parent] - moved
        border = parent + rest
        tail = ragged(border, moved)
        target[hit] = True
        sitting = order[tail]
        sitting = sitting[~target[sitting]]
        target[hit] = False
        hole = slot[hit]
        hole = hole[hole < np.repeat(border, moved)]
        order[hole] = sitting
        slot[sitting] = hole
        order[tail] = hit
        slot[hit] = tail
        size[parent] = rest
        changes[1:] |= pointers[1:] != pointers[:-1]
        at = np.flatnonzero(changes)
        length = np.diff(np.append(at, len(hit)))
        size[tail[at]] = length
        group[hit] = np.repeat(tail[at], length)
    return group, prev


def _emit(group: np.ndarray, prev: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    n = int(bounds[-1])
    before = np.arange(-1, n - 1)
    before[bounds[:-1]] = -1
    done = np.zeros(n + 1, bool)
    done[n] = True  # what -1 reads
    free = np.arange(n)  # the next free slot of each group
    out = np.full(n, -1, np.int64)
    at, stop = bounds[:-1].copy(), bounds[1:].copy()
    out[at] = stop - 1
    done[stop - 1] = True
    walk = before[stop - 1]
    while at.size:
        resting = done[walk]
        go = np.flatnonzero(~resting)
        if go.size:
            put = walk[go]
            g = group[put]
            s = free[g]
            out[s] = put
            free[g] = s + 1
            done[put] = True
            walk[go] = prev[put]
        if go.size < at.size:
            idle = np.flatnonzero(resting)
            at[idle] += 1
            over = at[idle] >= stop[idle]
            more = idle[~over]
            walk[more] = before[out[at[more]]]
            if over.any():
                keep = np.ones(at.size, bool)
                keep[idle[over]] = False
                at, stop, walk = at[keep], stop[keep], walk[keep]
    return out
