import hashlib
import re

from pyspark.sql import functions as F

from pitlake.llm.exact_dedup import exact_dedup


def brute(rows):
    body = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t)
    groups = {}
    for i, t in rows:
        groups.setdefault(body(t or ""), []).append((-len(t or ""), i is None, i or 0))
    out = []
    for i, t in rows:
        text = body(t or "")
        best = min(groups[text])
        keep = None if best[1] else best[2]
        out.append((i, keep, len(groups[text]), (-len(t or ""), i is None, i or 0) == best, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_against_brute_force(make, odd_rows):
    rows = odd_rows + [(20 + i, f"same  text {' ' * (i % 3)}") for i in range(40)]
    rows += [(None, "no id"), (None, "no id"), (None, "no  id"), (31, "same  text"), (31, "same text   ")]
    assert sorted(map(tuple, exact_dedup(make(rows)).collect()), key=str) == brute(rows)


def test_colliding_digests_are_told_apart(make, odd_rows):
    weak = lambda text: F.substring(F.sha2(text, 256), 1, 1)
    rows = [*odd_rows, (None, "no id")]
    got = sorted((tuple(r)[:4] for r in exact_dedup(make(rows), digest=weak).collect()), key=str)
    # the repeated row (same id, same text) comes back once for each row
    assert got == sorted((r[:4] for r in brute(rows)), key=str)


def test_empty(make):
    assert exact_dedup(make([(1, "x")]).limit(0)).collect() == []
