import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """A documents table from (doc_id, text) rows, with columns whose names operators use inside."""

    def table(rows):
        full = [(i, t, None, "s", None if t is None else len(t), 1, "x", 2, 3.0, "k") for i, t in rows]
        return spark.createDataFrame(full, SCHEMA + ", start int, spans string, digest int, score double, bucket string").repartition(3)

    return table


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, no id, a long text, odd characters."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(80)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = text(120)
    return [
        (1, base), (2, base), (3, base.replace(" ", "  ")), (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, "\x00\x1f ☃ 日本語 \U0001f600 ﬃ"), (9, text(6000)),
        (10, base + " tail"), (11, "ab" * 300), (11, "ab" * 300), (None, base), (12, (text(4) + "\n") * 12), (-5, base), (13, text(60).upper() + "!!"), (14, text(55)),
    ]


@pytest.fixture(scope="session")
def some_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (9, 1, 1), (13, 0, 0), (14, 1, 0), (99, 0, 1), (None, 1, 1), (10, None, None)], "doc_id long, quality int, toxic int")
