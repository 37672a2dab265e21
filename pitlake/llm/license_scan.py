"""Licence scans over a positional rare-token index, in DataFrame operations only.

The index holds, for each licence template, the places of the highest-IDF words of
its mandatory key phrase (IDF over the templates), so a file that holds the phrase
holds them.  A file's words are looked up in it; postings of a template that agree
on where it would begin are intersected, the key phrase is verified word for word,
and the share of the template's words that stand in place is its score.  All of it
happens inside the file's own row, so nothing is shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import texts_of
from .license_texts import LICENSES

#: Base phrases with their labels; every place of each is found.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Words of each key phrase that stand in the index.
RARE_WORDS = 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SHIFT, _BACK = 32, 1000  # a key is template << 32 | begin + 1000


def template_words(text: str) -> list[str]:
    return [w for w in re.split(_GAP, text.translate(str.maketrans(_UPPER, _LOWER))) if w]


def key_place(template: list[str], key: list[str]) -> int:
    """Where the key phrase stands in its template."""
    return next(i for i in range(len(template)) if template[i : i + len(key)] == key)


def rare_index(templates=LICENSES, rare_words: int = RARE_WORDS) -> dict[str, list[tuple[int, int]]]:
    """word -> (template, place) for the ``rare_words`` highest-IDF words of each key phrase."""
    split = [(template_words(t), k.split()) for _, t, k in templates]
    df = Counter(w for words, _ in split for w in set(words))
    idf = {w: math.log(len(split) / n) for w, n in df.items()}
    index = defaultdict(list)
    for t, (words, key) in enumerate(split):
        at = key_place(words, key)
        for i in sorted(range(len(key)), key=lambda i: (-idf[key[i]], -len(key[i]), i))[:rare_words]:
            index[key[i]].append((t, at + i))
    return dict(index)


def _strings(words: list[str]) -> Column:
    return F.array(*(F.lit(w) for w in words))


def words_of(text: Column) -> Column:
    """The words of a text, lower case: runs of digits, letters and non-ASCII characters."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _GAP), "")


def license_scan(docs: DataFrame, templates=LICENSES, phrases=PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of the base phrases, first_word and last_word are
    their smallest and largest start (else null).  Labels are distinct, sorted and
    comma-joined.  score is the largest share of a found template's words that
    stand in place, 1 where a base phrase stands, 0 without either.  A null text
    is empty.  An empty table gives an empty result; repeated rows are scanned
    each; further columns are not looked at.  Rows without an id
    are left out.
    """
    index = rare_index(templates)
    phrase_words = [p.split() for p, _ in phrases]
    known = sorted({*index, *(p[-1] for p in phrase_words)})
    split = [template_words(t) for _, t, _ in templates]
    keys = [k.split() for _, _, k in templates]
    key_at = [key_place(t, k) for t, k in zip(split, keys)]

    words = F.col("words")
    df = texts_of(docs, id_col, text_col).select("doc_id", words_of(F.col("text")).alias("words"))
    df = df.withColumn("hits", F.array_compact(F.transform("words", lambda w, i: F.when(w.isin(known), i))))

    # base: a phrase ends at a hit of its last word
    def ends_here(i: Column, phrase: list[str]) -> Column:
        test = F.get(words, i) == phrase[-1]
        for back, w in enumerate(reversed(phrase[:-1]), 1):
            test = test & (F.get(words, i - back) == w)
        return F.coalesce(test, F.lit(False))

    def places(phrase: list[str]) -> Column:
        return F.transform(F.filter("hits", lambda i: ends_here(i, phrase)), lambda i: i - (len(phrase) - 1))

    df = df.withColumns({f"at_{n}": places(p) for n, p in enumerate(phrase_words)})
    at = [F.col(f"at_{n}") for n in range(len(phrases))]
    base = F.array_compact(F.array(*(F.when(F.size(a) > 0, F.lit(label)) for a, (_, label) in zip(at, phrases))))

    # postings of all hits, shifted to where the template would begin
    postings = F.create_map(*(x for w in sorted(index) for x in (F.lit(w), F.array(*(F.lit((t << _SHIFT) + _BACK - i).cast("long") for t, i in index[w])))))
    shifted = F.transform("hits", lambda i: F.transform(F.coalesce(postings[F.get(words, i)], F.array().cast("array<long>")), lambda p: p + i))
    df = df.withColumns({"base": base, "keys": F.array_sort(F.flatten(shifted))})
    df = df.withColumn("begins", F.array_distinct(F.filter("keys", lambda k, j: F.coalesce(F.get("keys", j - 1) == k, F.lit(False)))))
    template = F.array(*(_strings(t) for t in split))
    phrase = F.array(*(_strings(k) for k in keys))
    offset = F.array(*(F.lit(a) for a in key_at))
    label = _strings([name for name, _, _ in templates])

    def share(k: Column) -> Column:
        t, begin = F.shiftright(k, _SHIFT).cast("int"), (k.bitwiseAND((1 << _SHIFT) - 1) - _BACK).cast("int")
        own = F.get(template, t)
        key = F.get(phrase, t)
        there = F.transform(key, lambda w, j: F.coalesce(F.get(words, begin + F.get(offset, t) + j) == w, F.lit(False)))
        in_place = F.filter(own, lambda w, j: F.coalesce(F.get(words, begin + j) == w, F.lit(False)))
        return F.struct(
            F.get(label, t).alias("label"), F.when(F.forall(there, lambda x: x), F.size(in_place) / F.size(own)).alias("share")
        )

    df = df.withColumn("found", F.filter(F.transform("begins", share), lambda x: x["share"].isNotNull()))
    all_places = F.concat(*at)
    labels = F.array_sort(F.array_distinct(F.concat("base", F.transform("found", lambda x: x["label"]))))
    return df.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.size(all_places).cast("long").alias("n_base"),
        F.array_min(all_places).cast("long").alias("first_word"),
        F.array_max(all_places).cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0))).alias("score"),
    )
