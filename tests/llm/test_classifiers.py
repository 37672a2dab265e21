import random
import re
import zlib

import numpy as np
import pytest

from pitlake.llm import ordinal_quality as oq
from pitlake.llm import toxicity as tx
from pitlake.llm.textbuf import Texts


def texts(raw):
    raw = [r.encode() for r in raw]
    return Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *(len(r) for r in raw)]).astype(np.int64))


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(0)
    x = np.abs(rng.normal(size=(600, 20))).astype(np.float32)
    s = x[:, 0] * 3 - x[:, 1] * 3
    grade = np.digitize(s, [-1, 1.5])
    model = oq.fit(x[:400], grade[:400], 3)
    assert (np.diff(model.thresholds) > 0).all()
    above = model.above(x[400:])
    assert (np.diff(above, axis=1) <= 0).all()
    assert np.mean((above >= 0.5).sum(axis=1) == grade[400:]) > 0.9


def test_quality_on_held_out_rows(make, spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("etaoinsr") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(400):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(30, 90)))
        good = i % 3 > 0
        rows.append((i, text if good else text.upper().replace(" ", "!! ")))
        labels.append((i, int(good) * (1 + i % 2)))
    ratings = spark.createDataFrame(labels[:250] + [(None, 1), (7, None)], "doc_id long, grade int")
    got = {r["doc_id"]: r for r in oq.rate_quality(make(rows), ratings).collect()}
    assert len(got) == 400
    assert np.mean([got[i]["selected"] == (g > 0) for i, g in labels[250:]]) > 0.97
    assert all(0 <= r["tail_probability"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in got.values())
    kept = oq.select_quality(make(rows), ratings)
    assert "bucket" in kept.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["selected"]}


def test_odd_rows(make, odd_rows, some_labels, spark):
    ids = sorted(i for i, _ in odd_rows if i is not None)
    ratings = some_labels.selectExpr("doc_id", "quality as grade")
    assert sorted(r["doc_id"] for r in oq.rate_quality(make(odd_rows), ratings).collect()) == ids
    got = tx.score_toxicity(make(odd_rows), some_labels).collect()
    assert sorted(r["doc_id"] for r in got) == ids
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    none = make([(1, "x")]).limit(0)
    assert oq.rate_quality(none, ratings).collect() == [] and tx.score_toxicity(none, some_labels).collect() == []


def test_windows_cover_all_words():
    words = " ".join(f"w{i}" for i in range(150))
    inputs = tx.Inputs(texts(["", words, "one"]))
    assert np.bincount(inputs.text).tolist() == [1, 6, 1]
    seen = inputs.index[inputs.text == 1]
    assert set(seen[seen < inputs.n_words]) == set(inputs.index[inputs.text == 1].ravel()) - {inputs.n_words}
    assert len(set(seen.ravel()) - {inputs.n_words}) == 150


@pytest.mark.parametrize("name", ["out", "attend_v", "attend", "wf", "uf", "bb", "ub"])
def test_gradients(name):
    p = {k: v.astype(np.float64) for k, v in tx.initial(3).items()}
    inputs = tx.Inputs(texts(["hello you world", "one two", "", " ".join(f"w{i}" for i in range(60))]))
    x, label = inputs.vectors(p), np.arange(len(inputs.index)) % 2.0
    _, g, d_x = tx.gradients(p, x, inputs.index, label)
    at = tuple(s // 2 for s in p[name].shape)
    old, step = p[name][at], 1e-4
    p[name][at] = old + step
    high = tx.gradients(p, x, inputs.index, label)[0]
    p[name][at] = old - step
    low = tx.gradients(p, x, inputs.index, label)[0]
    assert abs((high - low) / (2 * step) - g[name][at]) < 1e-5


def test_toxicity_on_held_out_rows(make, spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("etaoinsrlh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(700):
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        if i % 3 == 0:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(["vexbad", "vexworse", "Grumph!", "vexer"])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(i % 3 == 0)))
    got = {r["doc_id"]: r for r in tx.score_toxicity(make(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    held = [(got[i]["predicted"], t) for i, _, t in labels if got[i]["held_out"]]
    assert np.mean([a == b for a, b in held]) > 0.95


def test_toxicity_learns_from_long_texts(make, spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("etaoinsrlh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(400):
        text = [rng.choice(words) for _ in range(1000)]
        if i % 2 == 0:
            for _ in range(40):
                text[rng.randrange(len(text))] = rng.choice(["vexbad", "vexworse", "Grumph!", "vexer"])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(i % 2 == 0)))
    assert min(len(t) for _, t in rows) > 4000
    got = {r["doc_id"]: r for r in tx.score_toxicity(make(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    held = [(got[i]["predicted"], t) for i, _, t in labels if got[i]["held_out"]]
    assert np.mean([a == b for a, b in held]) > 0.9


# -- both forward passes once more, by hand ----------------------------------------------


def mixed(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> shift) * factor % (1 << 64)
    return x ^ x >> 31


def gram_hash(raw):
    return mixed(sum((b + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, b in enumerate(raw)) % (1 << 64))


def word_hash(raw):
    prime = 2**31 - 1
    a, b = (sum((c + 1) * pow(point, i, prime) for i, c in enumerate(raw)) % prime for point in (1_357_924_681, 864_197_533))
    return mixed(a << 31 | b)


def toxicity_by_hand(p, text):
    p = {k: v.astype(float) for k, v in p.items()}
    said = [w.lower() for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", text.encode())]
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def vector(w):
        padded = b" " + w + b"  "
        grams = [p["chars"][gram_hash(padded[i : i + 4]) % tx.CHARS] for i in range(len(w))]
        return np.concatenate((p["words"][word_hash(w) % tx.WORDS], np.mean(grams, axis=0)))

    def read(side, xs):
        h, states, n = np.zeros(tx.HIDDEN), [], tx.HIDDEN
        for x in xs:
            a, r_h = x @ p[f"w{side}"] + p[f"b{side}"], h @ p[f"u{side}"]
            z, r = sigmoid(a[:n] + r_h[:n]), sigmoid(a[n : 2 * n] + r_h[n : 2 * n])
            h = (1 - z) * np.tanh(a[2 * n :] + r * r_h[2 * n :]) + z * h
            states.append(h)
        return states

    best, begin = -np.inf, 0
    while True:
        xs = [vector(w) for w in said[begin : begin + tx.WINDOW]]
        pool = np.zeros(2 * tx.HIDDEN)
        if xs:
            states = np.concatenate((read("f", xs), read("b", xs[::-1])[::-1]), axis=1)
            e = np.exp(np.tanh(states @ p["attend"] + p["attend_b"]) @ p["attend_v"])
            pool = (e / e.sum()) @ states
        best = max(best, float(pool @ p["out"] + p["out_b"][0]))
        if begin + tx.WINDOW >= len(said):
            return sigmoid(best)
        begin += tx.STRIDE


def test_toxicity_scores_by_hand(odd_rows):
    p = {k: v + np.float32(0.1) * np.random.default_rng(5).normal(size=v.shape).astype(np.float32) for k, v in tx.initial(3).items()}
    raw = [(t or "")[:2500] for i, t in odd_rows]
    inputs = tx.Inputs(texts(raw))
    best = np.full(len(raw), -np.inf)
    np.maximum.at(best, inputs.text, tx.window_logits(p, inputs))
    assert np.allclose(1 / (1 + np.exp(-best)), [toxicity_by_hand(p, t) for t in raw], atol=2e-5)


def test_quality_features_by_hand(odd_rows):
    raw = [(t or "")[:2500] for i, t in odd_rows] + ["a a a b b", "ab"]
    rng = np.random.default_rng(6)
    model = oq.OrdinalModel(rng.normal(size=oq.BUCKETS).astype(np.float32), np.array([-0.3, 0.8]))
    got = np.concatenate([model.above(oq.features(texts([t]))) for t in raw])
    for t, above in zip(raw, got):
        x, data = np.zeros(oq.BUCKETS), t.encode()
        for i in range(len(data) - oq.GRAM + 1):
            x[gram_hash(data[i : i + oq.GRAM]) % (oq.BUCKETS - 1)] += 1
        x /= max(1, x.sum())
        said = re.findall(rb"[^\x20\x09-\x0D]+", data)
        if len(data) >= oq.GRAM:
            x[-1] = sum(a == b for a, b in zip(said, said[1:])) / max(1, len(said))
        s = np.sqrt(x) @ model.weights
        assert np.allclose(above, [1 / (1 + np.exp(c - s)) for c in model.thresholds], atol=1e-4)
    assert np.allclose(got, model.above(oq.features(texts(raw))), atol=1e-5)


def test_toxicity_without_two_kinds_of_labels(spark, make, odd_rows):
    """No label, or one kind of them, tells nothing apart: a constant, and no document is called toxic for want of labels."""
    docs = make(odd_rows)
    schema = "doc_id long, quality int, toxic int"
    for labels, score in (([], 0.0), ([(1, 1, 0), (2, 0, 0), (9, 1, None)], 0.0), ([(1, 1, 1), (2, 1, 1), (3, 1, 1), (9, 1, 1)], 1.0), ([(-77, 1, 1)], 0.0)):
        got = tx.score_toxicity(docs, spark.createDataFrame(labels, schema)).collect()
        assert len(got) == sum(i is not None for i, _ in odd_rows)
        assert {(r["score"], r["predicted"]) for r in got} == {(score, int(score))}, labels
