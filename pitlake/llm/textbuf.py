"""Texts of an Arrow batch as one byte array, and hashes of its substrings.

Hashes are read off prefix sums, then mixed; the hash of a substring does not depend
on where it stands.  Substrings of any length are polynomials over ``byte + 1``
modulo the prime 2**31 - 1, at two points; short windows of one length, which are
only counted or routed by, are polynomials modulo 2**64.  Where a result needs
equality and not a likely equality, ``numbers`` compares the bytes as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PRIME = (1 << 31) - 1
#: Two points, as any below the prime would do.
_POINTS = (1_357_924_681, 864_197_533)
_tables: dict[int, np.ndarray] = {}
_residues: dict[int, np.ndarray] = {}
#: Texts are handled in chunks of about so many bytes, so that memory is bounded.
CHUNK_BYTES = 2_000_000


def _powers(base: int, n: int) -> np.ndarray:
    have = _tables.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << n.bit_length()), base, np.uint64)
        steps[0] = 1
        have = _tables[base] = np.cumprod(steps)
    return have[:n]


def _modulo(x: np.ndarray) -> np.ndarray:
    """x modulo 2**31 - 1, for x below 2**63; the prime itself may stand for 0."""
    x = (x & np.uint64(_PRIME)) + (x >> np.uint64(31))
    return (x & np.uint64(_PRIME)) + (x >> np.uint64(31))


def _prime_powers(base: int, n: int) -> np.ndarray:
    have = _residues.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, np.uint64)
        while len(have) < n:
            have = np.concatenate((have, _modulo(have * np.uint64(pow(base, len(have), _PRIME)))))
        have = _residues[base] = have.astype(np.uint32)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (fixed values: the usual splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Texts:
    """Some texts, one after another: ``data`` (uint8) and ``bounds`` (len + 1)."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds, self._prefix, self._sums = data, bounds, None, None

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @property
    def prefix(self) -> np.ndarray:
        if self._prefix is None:
            terms = (self.data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(self.data))
            self._prefix = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(terms, out=self._prefix[1:])
        return self._prefix

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each data[start:end]."""
        if self._sums is None:
            self._sums = []
            for point in _POINTS:
                sums = np.zeros(len(self.data) + 1, np.uint64)
                np.cumsum(_modulo((self.data.astype(np.uint64) + np.uint64(1)) * _prime_powers(point, len(self.data))), out=sums[1:])
                self._sums.append(sums)
        out = np.zeros(len(start), np.uint64)
        for point, sums in zip(_POINTS, self._sums):
            value = _modulo(_modulo(sums[end] - sums[start]) * _prime_powers(pow(point, -1, _PRIME), len(sums))[start])
            out = out << np.uint64(31) | np.where(value == _PRIME, np.uint64(0), value)
        return mix(out)

    def numbers(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A number for each data[start:end], the same for equal bytes and for no others."""
        h = self.hashes(start, end)
        _, one, number = np.unique(h, return_index=True, return_inverse=True)
        twin = one[number]
        copy = np.flatnonzero(twin != np.arange(len(h)))
        size, twin = end[copy] - start[copy], twin[copy]
        alike = (size == end[twin] - start[twin]).all()
        for i in range(0, len(copy) if alike else 0, 100_000):
            part = slice(i, i + 100_000)
            if not (self.data[ragged(start[copy[part]], size[part])] == self.data[ragged(start[twin[part]], size[part])]).all():
                alike = False
                break
        if alike:
            return number
        raw, seen = self.data.tobytes(), {}  # two strings of one hash: told apart by themselves
        return np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(start.tolist(), end.tolist())], np.int64)

    def window_hashes(self, k: int) -> np.ndarray:
        """Hash of each data[i:i+k]; those that cross a text's end mean nothing."""
        p = self.prefix
        return mix((p[k:] - p[:-k]) * _powers(_INVERSE, len(p))[: len(p) - k])

    def owner(self, at: np.ndarray) -> np.ndarray:
        """Index of the text that holds each position."""
        return np.searchsorted(self.bounds, at, side="right") - 1


def split_chunks(column: pa.Array, limit: int = CHUNK_BYTES, rows: int = 20_000) -> Iterator[tuple[int, int, Texts]]:
    """(first row, row after the last, Texts) for a string column; null is empty.

    A chunk has at most ``rows`` rows and ``limit`` bytes, or is one longer text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        last = min(last, first + rows, len(column))
        yield first, last, Texts(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (count[0] of them), start[1], ..."""
    total = int(count.sum())
    skip = np.repeat(np.cumsum(count) - count, count)
    return np.repeat(start, count) + (np.arange(total) - skip)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words(texts: Texts, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text index) of each maximal run of bytes other than ``gaps`` (ASCII white space)."""
    n = len(texts.data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~gaps[texts.data]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cut = texts.bounds[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    joined = cut[inside[cut] & inside[cut + 1]]  # a word that runs over a text's end
    begins[joined] = True
    ends[joined - 1] = True
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, texts.owner(start)
