import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from pitlake.llm import simhash as sh
from pitlake.llm.textbuf import split_chunks

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    w = re.findall("[^\\x20\\x09-\\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, distance=4):
    """Index of the first of its component for each fingerprint, over all pairs."""
    prints, label = np.array(prints, np.uint64), np.full(len(prints), -1)
    for i in range(len(prints)):
        if label[i] < 0:
            label[i], queue = i, [i]
            while queue:
                hit = np.flatnonzero((np.bitwise_count(prints ^ prints[queue.pop()]) <= distance) & (label < 0))
                label[hit] = i
                queue += hit.tolist()
    return label


def brute(rows):
    prints = [fingerprint(t) for _, t in rows]
    label = classes(prints)
    low = {}
    for (i, _), c in zip(rows, label):
        low[c] = min((x for x in (low.get(c), i) if x is not None), default=None)
    return sorted(((i, f"{p:016x}", low[c]) for (i, _), p, c in zip(rows, prints, label)), key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abC \t\nÉ日", max_size=40), max_size=8))
def test_fingerprints(texts):
    for _, _, chunk in split_chunks(pa.array(texts, pa.string())):
        got = sh.fingerprints(*sh.shingle_hashes(chunk), len(chunk))
        assert got.tolist() == [fingerprint(t) for t in texts]


def test_distance_is_a_lower_bound_and_the_embedding_agrees_with_sql(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 64, 3000, np.uint64)
    b = a ^ np.array([sum(1 << int(x) for x in rng.integers(0, 64, rng.integers(0, 9))) & (1 << 64) - 1 for _ in a], np.uint64)
    pops = lambda x: np.array([[bin(int(v) >> 2 * s & 3).count("1") for s in range(32)] for v in x])
    assert (sh.manhattan(sh.embed(a), sh.embed(b)) == np.abs(pops(a) - pops(b)).sum(axis=1)).all()
    assert (sh.manhattan(sh.embed(a), sh.embed(b)) <= np.bitwise_count(a ^ b)).all()
    signed = np.concatenate((a, np.array([0, 2**64 - 1, 2**63, 2**63 - 1], np.uint64))).view(np.int64)
    got = spark.createDataFrame([(int(x),) for x in signed], "print long").select("print", sh.embedded("print")).collect()
    assert all(np.array(e).view(np.uint64) == sh.embed(np.array([p]).view(np.uint64))[0] for p, e in got)


@pytest.mark.parametrize("n", [10, 10**6, 10**8, 10**11])
def test_every_near_pair_shares_a_cell(n):
    """For any choice of bits that differ, some grid has the pair in one cell, at every refinement."""
    masks = [m % (1 << 64) for m in sh.grids(n)]
    rng = random.Random(n)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), 4):
            y ^= 1 << b
        e, f = (int(sh.embed(np.array([v], np.uint64))[0]) for v in (x, y))
        shared = [m for m in masks if e & m == f & m]
        assert shared
        for m in shared:
            assert any(e & g == f & g for g in (s % (1 << 64) for s in sh.finer(m)))


def spread(rng, centre, n, bits):
    out = set()
    while len(out) < n:
        x = centre
        for b in rng.sample(range(64), rng.randint(0, bits)):
            x ^= 1 << b
        out.add(x)
    return list(out)


@pytest.mark.parametrize(("cell", "crowded", "rows"), [(500, 1 << 15, 100_000), (2, 40, 50), (100_000, 100, 200)])
def test_links_join_what_all_pairs_join(spark, cell, crowded, rows, monkeypatch):
    """Tight clusters, chains and random ones; grids of several sizes; crowded cells dealt out again."""
    met = sh._met
    monkeypatch.setattr(sh, "_met", lambda d, c: met(d, c, small=8, rows=rows))
    rng = random.Random(9)
    prints = set(spread(rng, rng.getrandbits(64), 400, 3)) | set(spread(rng, 0, 150, 5)) | set(spread(rng, 2**64 - 1, 60, 6))
    chain = rng.getrandbits(64)
    for _ in range(80):
        for b in rng.sample(range(64), 4):
            chain ^= 1 << b
        prints.add(chain)
    prints = sorted(prints | {rng.getrandbits(64) for _ in range(600)})
    df = spark.createDataFrame([(int(np.array([p], np.uint64).view(np.int64)[0]),) for p in prints], "print long")
    links = sh.linked(df, cell=cell, crowded=crowded).collect()
    place = {int(np.array([p], np.uint64).view(np.int64)[0]): i for i, p in enumerate(prints)}
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((root(place[a]), root(place[b])))
        parent[high] = low
    assert [root(i) for i in range(len(prints))] == classes(prints).tolist()


def test_dense_cells_emit_fewer_links_than_members():
    rng = random.Random(2)
    prints = np.array(spread(rng, rng.getrandbits(64), 3000, 3), np.uint64)
    a, b = sh.join_dense(prints, 4)
    assert len(a) < len(prints) and len(sh.join_sparse(np.zeros(len(prints[:60]), np.int64), prints[:60], 4)[0]) < 60


def test_against_brute_force(make, odd_rows):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(500)]
    rows = list(odd_rows)
    for family in range(8):
        base = [rng.choice(words) for _ in range(rng.randint(3, 250))]
        for i in range(20):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((1000 + family * 50 + i, " ".join(copy) if i % 3 else "\n ".join(copy).upper()))
    rows += [(None, None), (None, "alone, without an id, like nothing else"), (-9, "")]
    got = sh.simhash_duplicates(make(rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    assert len({r["component_id"] for r in got}) < len({r["fingerprint"] for r in got})


def test_empty_and_unlinked(make):
    assert sh.simhash_duplicates(make([(1, "x")]).limit(0)).collect() == []
    assert [tuple(r) for r in sh.simhash_duplicates(make([(7, "x")])).collect()] == [(7, f"{fingerprint('x'):016x}", 7)]
