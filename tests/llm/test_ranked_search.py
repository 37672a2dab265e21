import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pitlake.llm import queries, ranked_search as rs

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=20):
    terms = [Counter(TERM.findall((t or "").translate(LOWER))) for _, t in docs]
    n = [sum(c.values()) for c in terms]
    count, total, df = sum(x > 0 for x in n), sum(n), Counter(t for c in terms for t in c)
    out = []
    for item, text in items:
        scored = []
        for (i, _), c, size in zip(docs, terms, n):
            score = 0
            for t in TERM.findall((text or "").translate(LOWER)):
                if c[t]:
                    m = 75 + (25 * size * count) // total
                    score += math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if score:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if no_id else i, -s) for rank, (s, no_id, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(300)]
    text = lambda n: " ".join(vocabulary[int(300 * rng.random() ** 3)].title() for _ in range(n))
    docs = [(i, text(rng.randint(1, 60))) for i in range(400)]
    return docs + [(400 + i, docs[i][1]) for i in range(30)], [(i, text(rng.randint(1, 25))) for i in range(25)]


def items_of(spark, items):
    return spark.createDataFrame([(i, t, 1, 2, 3) for i, t in items], "item_id long, text string, rank int, row_ int, doc_id int")


@pytest.mark.parametrize(("shard", "query_bytes"), [(1_000_000, 4_000_000), (300, 4_000_000), (1, 150)])
def test_equals_brute_force(spark, make, corpus, shard, query_bytes):
    """The same in one shard or many, in one pass over the documents or several."""
    docs, items = corpus
    items = items[:8] if query_bytes == 150 else items
    got = rs.ranked_search(make(docs), items_of(spark, items), shard=shard, query_bytes=query_bytes).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)


def test_odd_rows(spark, make, odd_rows):
    """Nulls, repeated rows, no id, long texts, items that repeat, have no id, no text or no term."""
    base = odd_rows[0][1]
    items = [(1, base), (1, base), (None, base[:90]), (3, None), (4, " ,.!"), (5, "absent-term"), (6, odd_rows[8][1]), (7, "ONE one 日本語 ﬃ"), (8, "É " + base[:20])]
    got = rs.ranked_search(make(odd_rows), items_of(spark, items)).collect()
    assert sorted(map(tuple, got), key=str) == brute(odd_rows, items)
    assert any(r["doc_id"] is None for r in got)
    empty = make(odd_rows).limit(0)
    assert rs.ranked_search(empty, items_of(spark, items)).collect() == []
    assert rs.ranked_search(make(odd_rows), items_of(spark, items).limit(0)).collect() == []
    assert rs.ranked_search(make(odd_rows), items_of(spark, [(4, "...")])).collect() == []


def test_ties_go_to_smaller_ids_and_k_is_kept(spark, make):
    docs = [(i, "same words here") for i in range(200, 0, -1)] + [(None, "same words here")] + [(500, "other things"), (501, "other")]
    got = rs.ranked_search(make(docs), items_of(spark, [(1, "same words")]), k=7, shard=50).collect()
    assert [(r["rank"], r["doc_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(i, i) for i in range(1, 8)]


def built(docs, items):
    """One shard over lists of words, and its queries, without Spark."""
    number = {t: i for i, t in enumerate(sorted({t for _, words in items for t in words}))}
    counts = [Counter(number[t] for t in words if t in number) for _, words in docs]
    edge = np.concatenate(([0], np.cumsum([len(c) for c in counts])))
    term = np.array([t for c in counts for t in sorted(c)])
    tf = np.array([c[t] for c in counts for t in sorted(c)])
    n = np.repeat([len(words) for _, words in docs], np.diff(edge))
    ids = np.array([i for i, _ in docs], np.uint64)
    return rs.Shard(len(number), ids, edge, term, rs.impacts(tf, n, len(docs), sum(len(words) for _, words in docs))), number


def test_stops_early_and_only_strictly_below():
    """Long lists whose tops decide are not read to their ends; equal scores are."""
    docs = [(i, ["hit"] * (40 if i < 30 else 1) + ["pad"] * 10) for i in range(5000)]
    shard, number = built(docs, [(0, ["hit"])])
    weights, dense = np.array([100]), np.array([100])
    best = rs.Best(20)
    assert rs.search(shard, np.array([number["hit"]]), weights, dense, best) < 100
    assert best.ids.tolist() == list(range(20))
    flat, number = built([(5000 - i, ["hit", "pad"]) for i in range(5000)], [(0, ["hit"])])
    best = rs.Best(20)
    assert rs.search(flat, np.array([0]), weights, dense, best) == 5000  # any of them may have the smaller id
    assert best.ids.tolist() == list(range(1, 21))
    # a further shard that cannot reach the kth score is not read at all
    best.score = best.score + 10**9
    assert rs.search(flat, np.array([0]), weights, dense, best) == 0 and not flat.met.any()


def test_query_equals_its_sql_on_odd_rows(spark, tmp_path, make, odd_rows):
    duckdb = pytest.importorskip("duckdb")
    make(odd_rows).write.parquet(f"{tmp_path}/documents.parquet")
    items_of(spark, [(i, t) for i, t in odd_rows if t is None or len(t) < 2000]).write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.execute(f'SELECT item_id, "rank", doc_id, score FROM ({queries.oracle_sql()["op11_ranked_search"]})').fetchall()
    got = queries.op11_ranked_search(spark, str(tmp_path)).collect()
    assert got and sorted(map(tuple, got), key=str) == sorted(want, key=str)
