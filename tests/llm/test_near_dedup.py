import random
from collections import Counter

import numpy as np
import pytest

from pitlake.llm import near_dedup
from pitlake.llm.components import components
from pitlake.llm.frames import stage_table
from pitlake.llm.near_dedup import dart_signatures, near_duplicates


def units(text):
    w = (text or "").split()
    count = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])
    return Counter({s: n.bit_length() for s, n in count.items()})


def similar(a, b):
    best = 0.0
    for x, y in ((a, b), (Counter(set(a)), Counter(set(b)))):
        both = sum((x & y).values())
        best = max(best, both / max(1, sum(x.values()) + sum(y.values()) - both))
    return best


def brute(rows, threshold=0.8):
    rows = [(i, units(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if a and b and similar(a, b) >= threshold:
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return {i: root(i) for i, _ in rows}


@pytest.mark.parametrize("block", [256, 5])
def test_against_brute_force(make, odd_rows, block):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows = list(odd_rows)
    for family in range(6):
        base = [rng.choice(words) for _ in range(rng.randint(60, 200))]
        for i in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((1000 + family * 50 + i, " ".join(copy)))
    rows += [(2000 + i, "exactly the same words in all of these") for i in range(30)]
    rows += [(3000 + i, " ".join(rng.choice(words) for _ in range(80)) + " one line again" * 300) for i in range(4)]
    for n in range(3):  # each a little farther from the first: linked only through those between
        chain = [rng.choice(words) for _ in range(100)]
        for i in range(25):
            rows.append((4000 + n * 100 + i, " ".join(chain)))
            chain[(i * 7) % 100] = rng.choice(words)
    got = near_duplicates(make(rows), block=block).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == brute(rows)
    assert len(got) == sum(i is not None for i, _ in rows)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)


def test_pairs_by_presence_alone(make):
    rng = random.Random(4)
    rows, pairs = [], []
    for n in range(12):
        once = " ".join(f"p{n}x{rng.randrange(10**6)}" for _ in range(90))
        rows += [(100 * n, once), (100 * n + 1, f"{once} {once}")]
        head = " ".join(f"h{n}x{rng.randrange(10**6)}" for _ in range(84))
        line = " " + " ".join(f"l{n}x{i}" for i in range(20))
        rows += [(100 * n + 2, head + line), (100 * n + 3, head + line * 32)]
        # both repeat something, and are alike by presence only
        rows += [(100 * n + 4, "a " + head.replace("h", "g") + line.replace("l", "m") * 3), (100 * n + 5, head.replace("h", "g") + line.replace("l", "m") * 40)]
        pairs += [(100 * n + k, 100 * n + k + 1) for k in (0, 2, 4)]
    by_id = dict(rows)
    assert all(sum((units(by_id[i]) & units(by_id[j])).values()) / sum((units(by_id[i]) | units(by_id[j])).values()) < 0.67 for i, j in pairs)
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(make(rows)).collect()}
    assert got == brute(rows)
    assert all(got[i] == got[j] for i, j in pairs)


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    a = rng.integers(1, 1 << 62, 300).astype(np.uint64)
    b = np.concatenate((a[:200], rng.integers(1, 1 << 62, 60).astype(np.uint64)))
    text = np.repeat([0, 1], [len(a), len(b)])
    s = dart_signatures(text, np.concatenate((a, b)), 2, 2000)
    assert (s > 0).all()
    assert abs((s[0] == s[1]).mean() - 200 / 360) < 0.05


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (3, 4)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_large_group_costs_a_row_each(make, spark, monkeypatch):
    """2,000 different copies of one text: all but a few leave with their leader and never meet in blocks."""
    staged = {}
    monkeypatch.setattr(near_dedup, "stage_table", lambda df, name: staged.setdefault(name, stage_table(df, name)))
    rng = random.Random(8)
    base = [f"b{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 2000):
        copy = list(base)
        copy[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    got = near_duplicates(make(rows)).collect()
    assert len(got) == 2000 and {r["class_id"] for r in got} == {0}
    assert staged["led"].count() <= 2 * 2000 and staged["rest"].count() == 0
    assert staged["close"].where("block = 0").groupBy("key").count().where("count > 256").isEmpty()


def test_lower_thresholds(make):
    """More bands of fewer rows reach farther: recall of linked pairs at 0.4 against all pairs."""
    rng = random.Random(9)
    rows = []
    for f in range(40):
        base = [f"f{f}w{i}" for i in range(120)]
        rows.append((10 * f, " ".join(base)))
        for i in range(1, 4):
            copy = list(base)
            for _ in range(4 + 3 * i):
                copy[rng.randrange(120)] = f"x{rng.randrange(10**9)}"
            rows.append((10 * f + i, " ".join(copy)))
    want = brute(rows, 0.4)
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(make(rows), threshold=0.4, bands=105, rows=3).collect()}
    linked = [i for i in want if want[i] != i]
    assert len(linked) > 40
    assert sum(got[i] == want[i] for i in linked) >= 0.95 * len(linked)
    assert all(got[i] == i for i in want if want[i] == i and i not in want.values())


def test_empty(make):
    assert near_duplicates(make([(1, "x")]).limit(0)).collect() == []
