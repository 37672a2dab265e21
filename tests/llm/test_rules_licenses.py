import math
import re
from collections import Counter

import numpy as np

from pitlake.llm.license_scan import PHRASES, license_scan, rare_index, template_words
from pitlake.llm.license_texts import LICENSES
from pitlake.llm.quality_rules import BUCKETS, GRAM, quality_rules
from pitlake.llm.textbuf import Texts, words


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality_counts(make, odd_rows, some_labels):
    rows = [*odd_rows, (60, "a b c a b c\n\nx\n x\nx\n"), (61, "\n\n"), (62, "#*$ %&|<>"), (63, "x\n" * 60), (64, "é " * 51)]
    got = quality_rules(make(rows), some_labels.where("quality = 1")).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((r["doc_id"], *(r[n] for n in names)) for r in got) == sorted((i, *counts(t or "")) for i, t in rows if i is not None)
    for r in got:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert quality_rules(make([(1, "x")]).limit(0), some_labels).collect() == []


def test_quality_verdict(make, spark):
    good = [(i, " ".join(f"the{j * i % 17} house of {j * 7 % 23} words" for j in range(30))) for i in range(30)]
    junk = [(100 + i, " ".join(f"@@{chr(65 + (i * j) % 26)}{j}$$$%%%" for j in range(80))) for i in range(10)]
    got = {r["doc_id"]: r for r in quality_rules(make(good + junk), spark.createDataFrame([(i,) for i in range(30)], "doc_id long"), threshold=-0.35).collect()}
    assert all(got[i]["mean_log_ratio"] >= -0.35 for i, _ in good) and all(got[i]["mean_log_ratio"] < -0.35 for i, _ in junk)


def test_counts_are_told_by_bytes(make):
    """Two strings that polynomial hashes modulo a power of two cannot tell apart, as lines and as words."""
    one = "a"
    while len(one) < 4096:
        one += one.translate({97: "b", 98: "a"})
    two = one.translate({97: "b", 98: "a"})
    rows = [(1, f"{one}\n{two}"), (2, f"{one} x {two} x {one} y {two} x"), (3, f"{one}\n{one}")]
    got = quality_rules(make(rows), make([(1, "")])).collect()
    assert sorted((r["doc_id"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == sorted((i, *counts(t)[3:]) for i, t in rows)


def test_equal_hashes_of_different_strings():
    class Blind(Texts):
        def hashes(self, start, end):
            return (end - start).astype(np.uint64) % 2

    data = np.frombuffer(b"aa bb aa c cc bb d", np.uint8)
    texts = Blind(data, np.array([0, len(data)]))
    start, end, _ = words(texts)
    number = texts.numbers(start, end).tolist()
    said = data.tobytes().split()
    assert all((a == b) == (said[i] == said[j]) for i, a in enumerate(number) for j, b in enumerate(number))


def ratio_by_hand(rows, trusted):
    """Mean log ratios, gram by gram in Python integers."""
    def bucket(gram):
        x = sum((b + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, b in enumerate(gram)) % (1 << 64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ x >> shift) * factor % (1 << 64)
        return (x ^ x >> 31) % BUCKETS

    of = [(i, [bucket(raw[k : k + GRAM]) for k in range(len(raw) - GRAM + 1)]) for i, raw in ((i, (t or "").encode()) for i, t in rows)]
    raw, target = Counter(), Counter()
    for i, grams in of:
        raw.update(grams)
        target.update(grams if i in trusted else ())
    log = lambda b: math.log((target[b] + 1) / (target.total() + BUCKETS)) - math.log((raw[b] + 1) / (raw.total() + BUCKETS))
    return [(i, sum(map(log, grams)) / max(1, len(grams))) for i, grams in of]


def test_verdict_by_hand(make, odd_rows):
    rows = [(i, t) for i, t in odd_rows if i is not None]
    got = quality_rules(make(rows), make([(1, ""), (9, ""), (14, ""), (500, "")]), threshold=-0.4).collect()
    want = sorted(ratio_by_hand(rows, {1, 9, 14}))
    have = sorted((r["doc_id"], r["mean_log_ratio"]) for r in got)
    assert [i for i, _ in have] == [i for i, _ in want]
    assert all(abs(a - b) < 1e-9 for (_, a), (_, b) in zip(have, want))
    assert {r["kept"] for r in got} == {True, False}
    assert all(r["kept"] == (not r["base_failed"] and r["mean_log_ratio"] >= -0.4) for r in got)


def brute(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places, labels = [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += at
        if at:
            labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_licenses(make, odd_rows):
    rows = [
        *odd_rows, (70, "Licensed under CC BY-NC 4.0."), (71, "This work is licensed under the GNU General Public License, version 3."), (72, "Licensed under the Apache License, Version 2.0."),
        (73, "x Released under the MIT License. All rights reserved. all\nRIGHTS  reserved"), (74, "ccby cc bye éCC BY cc-by CC by"), (75, "general public licence İ ſ K all rights  reserved9 all rights reserved"),
        (76, "mit license alone, apache license far from version 2"), (77, "CC BY " * 300),
    ]
    got = license_scan(make(rows)).collect()
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted(((r["doc_id"], *(r[n] for n in names)) for r in got), key=str) == sorted(((i, *brute(t or "")) for i, t in rows if i is not None), key=str)
    labels = {r["doc_id"]: r["labels"] for r in got}
    assert labels[70] == "cc-by,cc-by-nc-4.0" and labels[71] == "gpl,gpl-3.0" and labels[72] == "apache-2.0" and labels[73] == "mit,reserved" and labels[14] == ""
    assert all(0 <= r["score"] <= 1 for r in got)
    assert license_scan(make([(1, "x")]).limit(0)).collect() == []


def test_index_holds_rare_words_of_key_phrases():
    index = rare_index()
    assert "the" not in index and "of" not in index
    held = {t for where in index.values() for t, _ in where}
    assert held == set(range(len(LICENSES)))
    for word, where in index.items():
        for t, place in where:
            words, key = template_words(LICENSES[t][1]), LICENSES[t][2].split()
            assert words[place] == word and word in key


def test_key_phrase_is_enough_and_whole_texts_score_one(make):
    rows = [(i, f"before {text} after") for i, (_, text, _) in enumerate(LICENSES)]
    rows += [(100 + i, f"{key} and no more") for i, (_, _, key) in enumerate(LICENSES)]
    rows += [(200 + i, " ".join(["x", *key.split()[:-1], "not", key.split()[-1]])) for i, (_, _, key) in enumerate(LICENSES)]
    got = {r["doc_id"]: r for r in license_scan(make(rows), phrases=(("no such phrase", "none"),)).collect()}
    for i, (label, _, key) in enumerate(LICENSES):
        assert label in got[i]["labels"].split(",") and got[i]["score"] == 1.0
        assert label in got[100 + i]["labels"].split(",") and 0 < got[100 + i]["score"] <= 1
        assert label not in got[200 + i]["labels"].split(",")


def test_only_ascii_letters_are_lowered(make):
    got = {r["doc_id"]: (r["n_words"], r["labels"]) for r in license_scan(make([(1, "MOZILLA PUBLIC LICENSE, V. 2.0"), (2, "CC BY \u212a ALL RIGHTS RE\u017fERVED")])).collect()}
    assert got == {1: (6, "mpl-2.0"), 2: (6, "cc-by")}
