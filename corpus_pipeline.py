"""A corpus pipeline: five stages, each written as Parquet and read again for the next.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns
the rows it keeps, with the columns of ``documents``, the last one packed pieces.
An empty table gives an empty result at every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.llm.exact_dedup import exact_dedup
from pitlake.llm.frames import stage_table, with_rows
from pitlake.llm.near_dedup import near_duplicates
from pitlake.llm.ordinal_quality import select_quality
from pitlake.llm.packing import pack
from pitlake.llm.queries import ratings
from pitlake.llm.secrets import redact_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose probability of a good grade is a half or more.

    Decided row by row from the text alone: repeated rows share their fate, a row
    without an id is judged like any other.  A text shorter than an n-gram (null and
    empty too) has nothing to be judged by but how common good grades are.  Without
    ratings every row stays.
    """
    return select_quality(docs, ratings(spark, sf_dir))


def _only(keyed: DataFrame, row: str, kept: DataFrame, columns: list[str]) -> DataFrame:
    return keyed.join(kept.select(row).hint("shuffle_hash"), row, "left_semi").select(*columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, white space apart: the longest original, then the smallest id, no id last.

    Rows are told apart by their place and not by doc_id, so of repeated rows one
    stays, and different texts that share an id, or have none, all stay.  Null,
    empty and blank texts are one group.
    """
    keyed, row = with_rows(docs)
    best = exact_dedup(keyed, carry=row).where("kept")
    return _only(keyed, row, best.groupBy("text_sha256", "keep_id").agg(F.min(row).alias(row)), docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the smallest id, of each class of near duplicates (five-word shingles, similarity of 0.8 or more).

    Rows are told apart by their place and not by doc_id.  Null, empty and blank
    texts are like nothing and stay.
    """
    keyed, row = with_rows(docs)
    classes = near_duplicates(keyed, id_col=row).select(F.col("doc_id").alias(row), "class_id")
    by_id = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", row)
    best = keyed.select("doc_id", row).join(classes, row).groupBy("class_id").agg(F.min(by_id).alias("best"))
    return _only(keyed, row, best.select(f"best.{row}"), docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with their secrets replaced by a mark and n_chars set anew; null texts stay null."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all rows with their places in sequences; a null or empty text is the closing id alone."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("secrets", secrets), ("packing", packing)]

#: No SQL: the stages read models, hashes and tokenizers that SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
