"""Exact duplicates by skew-safe combining, in DataFrame operations only.

Rows with equal texts are combined three times, each time on the full normalised
text and not on its digest alone: inside each map task (partial aggregation),
per digest and salt, and over the salts of a digest.  What meets in one task is
never more than one row per map task, or one per salt.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import stage_table, texts_of

#: The characters that equality disregards, and the multiplier that
#: puts a length above any doc_id in one orderable number.
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
_ABOVE = "20000000000000000000"
#: Stands for no id, behind all ids.
_NO_ID = "9223372036854775808"


def normalise(text: Column) -> Column:
    """``text`` without ASCII white space; null becomes empty."""
    text = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = 16,
    carry: str | None = None,
    digest: Callable[[Column], Column] = lambda text: F.sha2(text, 256),
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of documents with equal normalised texts the one with the most characters
    (code points of the original) stays, then the one with the smallest id, one
    without an id last.  Null counts as empty; all blank texts are one group.  Rows
    that repeat an id, or have none, are counted and returned each, and kept if
    they have the id and the length of the one that stays.  An empty table gives an
    empty result; further columns are not looked at.  Texts whose ``digest``
    collides are told apart.  A column ``carry`` of ``docs`` comes back beside them.
    """
    carried = [] if carry is None else [carry]
    base = texts_of(docs, id_col, text_col, without_id=True, carry=carried).select(
        *carried, "doc_id", normalise(F.col("text")).alias("body"), F.coalesce(F.char_length("text"), F.lit(0)).alias("chars")
    )
    base = base.withColumn("digest", digest(F.col("body")))
    whole = lambda x: F.lit(x).cast("decimal(38,0)")
    place = F.coalesce(F.col("doc_id").cast("decimal(38,0)"), whole(_NO_ID))
    base = base.withColumn("order", ((F.col("chars").cast("decimal(10,0)") * whole(_ABOVE)).cast("decimal(38,0)") - place).cast("decimal(38,0)"))
    local = base.groupBy("digest", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"), "body").agg(F.max("order").alias("best"), F.count("*").alias("n"))
    classes = local.groupBy("digest", "body").agg(F.max("best").alias("best"), F.sum("n").alias("group_size"))
    classes = stage_table(classes.select("digest", "best", "group_size"), "classes")
    members = base.select(*carried, "doc_id", "digest", "order")
    clash = classes.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    if clash.isEmpty():
        found = members.join(classes, "digest")
    else:
        clash = stage_table(clash, "clash")
        alike = base.join(clash, "digest", "left_semi")
        apart = alike.groupBy("digest", "body").agg(F.max("order").alias("best"), F.count("*").alias("group_size"))
        apart = alike.join(apart, ["digest", "body"]).select(*carried, "doc_id", "digest", "order", "best", "group_size")
        found = members.join(clash, "digest", "left_anti").join(classes, "digest").unionByName(apart)
    # best = chars * ABOVE - place, and a place is less than half of ABOVE either way
    best = F.col("best")
    chars = F.floor((best + whole("10000000000000000000")) / whole(_ABOVE))
    kept_place = (chars.cast("decimal(10,0)") * whole(_ABOVE)).cast("decimal(38,0)") - best
    keep_id = F.when(kept_place != whole(_NO_ID), kept_place).cast("long")
    return found.select("doc_id", keep_id.alias("keep_id"), "group_size", (F.col("order") == best).alias("kept"), F.col("digest").alias("text_sha256"), *carried)
