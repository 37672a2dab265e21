"""Held-out figures of the two classifiers: python -m pitlake.llm.heldout SF_DIR [LONG_BYTES].

Toxicity is scored on the labelled rows that its query holds out.  The quality
model is fitted on the rated rows whose crc32 leaves no 0 and judged on those that
leave 0, in the same way.  Texts of more than LONG_BYTES bytes are also shown apart.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import local_session
from .ordinal_quality import rate_quality
from .queries import ratings, table
from .toxicity import held_out, score_toxicity


def auc(score: np.ndarray, label: np.ndarray) -> float:
    """The share of pairs of a 1 and a 0 that the score orders rightly; ties count half."""
    values, number = np.unique(score, return_inverse=True)
    ones, zeros = (np.bincount(number[label == k], minlength=len(values)) for k in (1, 0))
    below = np.cumsum(zeros) - zeros
    return float((ones * (below + zeros / 2)).sum() / max(1, ones.sum() * zeros.sum()))


def figures(rows: DataFrame, long_bytes: int) -> dict[str, tuple]:
    """For all texts, short and long ones of (score, predicted, label, n_bytes): rows, AUC, recall, false alarms, accuracy."""
    got = rows.toPandas()  # labelled rows that are held out: a few thousand
    out = {}
    for name, part in (("all", got), ("short", got[got.n_bytes <= long_bytes]), ("long", got[got.n_bytes > long_bytes])):
        label, hit = part.label.to_numpy(), part.predicted.to_numpy()
        rate = lambda where: float(hit[where].mean()) if where.any() else float("nan")  # noqa: E731, B023
        out[name] = (len(part), auc(part.score.to_numpy(), label), rate(label == 1), rate(label == 0), float((hit == label).mean()) if len(part) else float("nan"))
    return out


def main(sf_dir: str, long_bytes: int = 4_000, spark: SparkSession | None = None) -> dict[str, dict[str, tuple]]:
    spark = spark or local_session()
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    size = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes"))
    toxic = score_toxicity(docs, labels).where("held_out").select("doc_id", "score", "predicted")
    grades = ratings(spark, sf_dir)
    rated = rate_quality(docs, grades.where(~held_out(F.col("doc_id"))))
    good = rated.where(held_out(F.col("doc_id"))).select("doc_id", F.col("tail_probability").alias("score"), F.col("selected").cast("int").alias("predicted"))
    of = lambda scored, label: scored.join(label, "doc_id").join(size, "doc_id")
    found = {
        "toxicity": figures(of(toxic, labels.where("toxic is not null").select("doc_id", F.col("toxic").alias("label"))), long_bytes),
        "quality": figures(of(good, grades.select("doc_id", (F.col("grade") >= 1).cast("int").alias("label"))), long_bytes),
    }
    for what, parts in found.items():
        for part, (n, area, recall, alarms, accuracy) in parts.items():
            print(f"{what:9} {part:6} rows {n:6} AUC {area:.3f} recall {recall:.3f} false alarms {alarms:.4f} accuracy {accuracy:.3f}")
    return found


if __name__ == "__main__":
    main(sys.argv[1], *map(int, sys.argv[2:3]))
