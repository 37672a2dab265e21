import random

import corpus_pipeline


def test_stages(spark, tmp_path, make):
    rng = random.Random(4)
    words = ["".join(rng.choice("etaoinsr") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    rows = []
    for i in range(200):
        text = " ".join(rng.choice(words) for _ in range(60))
        rows.append((i, text if i % 4 else text.upper().replace(" ", "!! ")))
    rows += [(300 + i, rows[1][1]) for i in range(5)]
    near = rows[2][1].split()
    near[30] = "changed"
    rows += [(400, " ".join(near)), (401, rows[3][1] + ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"')]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    left, at = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, str(tmp_path)).cache()
        left[name] = at
        if name != "packing":
            assert at.columns == docs.columns
    ids = {n: {r["doc_id"] for r in df.collect()} for n, df in left.items()}
    good = {i for i, _ in rows if i >= 200 or i % 4}
    assert ids["quality"] == good
    assert ids["exact"] == good - {300, 301, 302, 303, 304}
    assert ids["near"] == ids["exact"] - {400, 401}
    assert ids["secrets"] == ids["near"] == ids["packing"]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == left["packing"].count()


def test_rows_that_share_an_id_or_have_none(spark, tmp_path):
    """Every different text stays once, whatever its id; and nothing is lost from an empty table."""
    rng = random.Random(7)
    a, b, c, d = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(4))
    rows = [(200, a), (200, a), (203, a), (204, b), (204, a), (None, a), (None, c), (205, d), (205, d + " tail"), (206, None), (207, ""), (208, " \n"), (None, b.replace(" ", "  "))]
    schema = "doc_id long, text string, row_ string, n_chars long"
    docs = spark.createDataFrame([(i, t, "x", None if t is None else len(t)) for i, t in rows], schema)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rated = stages["quality"](spark, docs, str(tmp_path))
    assert rated.columns == docs.columns and rated.count() == len(rows)
    once = stages["exact"](spark, rated, str(tmp_path)).cache()
    assert once.columns == docs.columns
    texts = sorted("".join((r["text"] or "").split()) for r in once.collect())
    assert texts == sorted({"".join((t or "").split()) for _, t in rows})
    assert b.replace(" ", "  ") in {r["text"] for r in once.collect()}  # the longest original
    left = stages["near"](spark, once, str(tmp_path)).cache()
    assert left.columns == docs.columns
    texts = {"".join((r["text"] or "").split()) for r in left.collect()}
    assert len(texts) == left.count() == 5 and len(texts & {d.replace(" ", ""), (d + "tail").replace(" ", "")}) == 1
    clean = stages["secrets"](spark, left, str(tmp_path)).cache()
    packed = stages["packing"](spark, clean, str(tmp_path)).collect()
    assert len(packed) == 5 and sorted(r["doc_tokens"] for r in packed)[0] == 3  # white space and the closing id
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0, name
