import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from pitlake.llm import suffix_dedup as suffix_dedup_module
from pitlake.llm.lyndon_suffixes import suffix_order
from pitlake.llm.suffix_dedup import suffix_dedup


def brute(rows, width):
    seen, out = {}, {}
    for i, t in sorted(set((i, t) for i, t in rows if i is not None)):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - width + 1):
            if raw[p : p + width] in seen:
                gone[p : p + width] = b"\1" * width
            seen.setdefault(raw[p : p + width], (i, p))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for q, g in enumerate(gone) if g and not (q and gone[q - 1]))
        out[i] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=30), min_size=1, max_size=5))
def test_suffix_order(strings):
    rows = [[*s, 0] for s in strings]
    bounds = np.cumsum([0, *(len(r) for r in rows)])
    expected = [int(o) + i for r, o in zip(rows, bounds) for i in sorted(range(len(r)), key=lambda i: r[i:])]
    assert suffix_order(np.array(sum(rows, [])), bounds).tolist() == expected


@pytest.mark.parametrize(("whole", "many"), [(64, 4096), (2, 4096), (2, 8)])
@pytest.mark.parametrize("width", [100, 40])
def test_against_brute_force(make, odd_rows, whole, many, width):
    rng = random.Random(width + whole)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(2, 6))) for _ in range(50)]
    base = [rng.choice(words) for _ in range(150)]
    rows = list(odd_rows)
    for i in range(40):
        copy = list(base)
        for _ in range(rng.randint(0, 8)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append((100 + i, " ".join(copy)))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup(make(rows), width, whole=whole, many=many).collect()}
    want = brute([(i, t or "") for i, t in rows], width)
    assert got == want


def test_a_minimizer_in_all_texts(make, spark, monkeypatch):
    """A footer in 3,000 different texts: no task sorts more than a few distinct pieces of one key."""
    rng = random.Random(6)
    footer = " ".join(f"footer{rng.randrange(10**6)}" for _ in range(30))
    rows = [(i, f"{rng.randrange(10**30)} {footer} {rng.randrange(10**30)}") for i in range(3000)]
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup(make(rows), with_text=False, many=500).collect()}
    assert got[0] == 0 and all(len(footer) <= got[i] <= len(footer) + 12 for i in range(1, 3000))

    def note_groups(batches):
        """In place of sorting: the number of distinct pieces of each key, below 0."""
        groups = {}
        for batch in batches:
            for key, n, piece in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4))):
                if n > 0:
                    groups.setdefault(key, set()).add(piece)
        sizes = [-len(g) for g in groups.values()]
        zero = pa.array([0] * len(sizes), pa.int64())
        yield pa.RecordBatch.from_arrays([zero, zero, pa.array(sizes, pa.int64())], ["doc_id", "start", "n"])

    monkeypatch.setattr(suffix_dedup_module, "_sort_suffixes", lambda width: note_groups)
    found = suffix_dedup_module.repeated_spans(make(rows), many=500).where("n < 0").select(-F.col("n")).collect()
    widest = max(r[0] for r in found)
    assert widest <= 500


def test_kept_text_and_empty_table(make):
    passage = "0123456789" * 12
    passage = "".join(f"{i:03d}" for i in range(40))
    got = {r["doc_id"]: r["kept_text"] for r in suffix_dedup(make([(1, "a" + passage + "é"), (2, "é" + passage + "b")])).collect()}
    assert got == {1: "a" + passage + "é", 2: "éb"}
    assert suffix_dedup(make([(1, "x")]).limit(0)).collect() == []
