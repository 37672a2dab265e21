import hashlib
import random
import sys
import zlib
from functools import lru_cache

import numpy as np
import pytest

from pitlake.llm import conversation_repair as cr
from pitlake.llm import queries
from pitlake.llm.frames import stage_table

sys.setrecursionlimit(20_000)  # for the brute force below
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def repaired(rows):
    """Counts, cost, audit and hash of one conversation, by trying every edit at every row."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, state, inserted=0):
        """(cost, letters, messages) of the best way on from row i; ``state`` is the initial before it."""
        own = "a" if state == "u" else "u"
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserted < 3:
            cost, letters, rest = best(i, own, inserted + 1)
            found.append((cost + 2, "I" + letters, ((own, ""),) + rest))
        if i < len(rows):
            role, text, fault = rows[i][1], rows[i][2], faults[i]
            cost, letters, rest = best(i + 1, state)
            found.append((cost + 3, "D" + letters, rest))
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                if role[:1] == own or role[:1] == "s" and state == "":
                    cost, letters, rest = best(i + 1, role[:1])
                    found.append((cost + cut, "K" + letters, ((role, text),) + rest))
                cost, letters, rest = best(i + 1, own)
                found.append((cost + 2 + cut, "R" + letters, ((own, text),) + rest))
        return min(found) if found else (10**6, "", ())

    cost, audit, messages = best(0, "")
    turns = [r[0] for r in rows if r[0] is not None]
    names = {"u": "user", "a": "assistant"}
    said = "\n".join(f"{names.get(r, r)}:{t}" for r, t in messages)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(said.encode()).hexdigest()


def brute(rows, kept):
    by = {conv: [] for conv, *_ in rows}
    for conv, *rest in kept:
        by[conv].append((rest[0], " " if rest[1] is None else rest[1], " " if rest[2] is None else rest[2]))
    return sorted(((c, *repaired(r)) if r else (c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, r in by.items()), key=str)


def conversations(rng, n, most, texts=("Yes.", "No!", "cut off", "Why? ", "", " \n", "Fine.\t", "and so")):
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "user", "ua"])
            rows.append((conv, turn * rng.randint(1, 2), role, rng.choice(texts) if rng.random() < 0.5 else f"{rng.random()}."))
    return list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())


SCHEMA = "conv_id long, turn long, role string, text string, part int, edits string, cost int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize(("block", "most", "n"), [(4096, 9, 150), (3, 30, 40), (1, 8, 40)])
def test_against_every_edit(spark, block, most, n):
    """Whole conversations, and ones in blocks over several tasks."""
    rows = conversations(random.Random(block), n, most)
    got = cr.summarize_repairs(cr.repair_conversations(frame(spark, rows), block=block)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, rows)


def test_query_on_odd_rows(spark, tmp_path):
    """Damage, nulls in every column, repeated rows, rows without a turn, ties, a conversation that loses all rows, clashing columns."""
    rng = random.Random(8)
    rows = conversations(rng, 120, 8)
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "Lost."), (2001, None, "user", "A."), (2001, None, "assistant", "B."), (2001, 3, None, None), (2002, None, None, None)]
    rows += [(None, 0, "user", "No conversation."), (None, 1, "assistant", "Yes."), (2003, 1, "user", "Same."), (2003, 1, "user", "Same."), (2003, 1, "user", "Same."), (2003, 2, "assistant", "End.")]
    rows += [(2004, 0, "system", "s."), (2004, 5, "user", "x" * 20000 + "."), (2004, 9, "assistant", "日本 \U0001f600!"), (2005, 0, "User", "Upper."), (2006, -3, "assistant", "First.")]
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op12_conversation_repair(spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, damaged(rows))
    duckdb = pytest.importorskip("duckdb")
    duckdb.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = duckdb.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.oracle_sql()['op12_conversation_repair']})").fetchall()
    assert sorted(want, key=str) == sorted(map(tuple, got.collect()), key=str)
    frame(spark, rows[:1]).limit(0).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert queries.op12_conversation_repair(spark, f"{tmp_path}/none").collect() == []


def test_one_conversation_over_many_tasks(spark):
    """A conversation with nearly all rows: blocks in several tasks, no block larger than allowed, the same result."""
    rng = random.Random(4)
    roles = ["user", "assistant", "user", "assistant", "system", "tool"]
    rows = [(0, t // 2 * 2, rng.choice(roles), f"{rng.randint(0, 400)}" + rng.choice(("", ".", "!"))) for t in range(600)]
    rows = sorted({(c, t, r): (c, t, r, x) for c, t, r, x in rows}.values()) + [(1, 0, "user", "Hi."), (1, 1, "assistant", "Ho.")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = stage_table(cr.repair_conversations(frame(spark, rows), block=16), "blocks")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [len(r["edits"].replace("I", "")) for r in blocks.where("conv_id = 0").collect()]
    assert len(sizes) > 10 and len({r["part"] >> 33 for r in blocks.where("conv_id = 0").collect()}) > 1
    assert sorted(map(tuple, cr.summarize_repairs(blocks).collect()), key=str) == brute(rows, rows)
    kept = "".join(m["role"][0] for r in sorted(blocks.where("conv_id = 0").collect(), key=lambda r: r["part"]) for m in r["messages"])
    assert kept and not kept.lstrip("s").replace("ua", "") and kept.count("s") <= 1


def test_equal_rows_are_one(spark):
    """Very many repeats of one row stay one row until their edits are written."""
    rows = [(7, 0, "user", "Again."), (7, 1, "assistant", "Ok.")] + [(7, 0, "user", "Again.")] * 5000 + [(7, 2, "user", "")] * 300
    (got,) = cr.summarize_repairs(cr.repair_conversations(frame(spark, rows))).collect()
    assert (got["blank"], got["duplicate"], got["cost"]) == (300, 5000, 3 * 5300) and got["illegal"] == 5000 + 299
    assert got["audit"] == "K" + "D" * 5000 + "K" + "D" * 300


def test_buckets_hold_all_and_like_lengths():
    lengths = np.array([0, 1, 1, 2, 3, 900, 5, 4, 4096, 700, 1])
    some = list(cr.buckets(lengths, cells=3000))
    assert sorted(np.concatenate(some).tolist()) == list(range(11))
    assert all(lengths[b].max() <= 2 * max(1, lengths[b].min()) for b in some)
