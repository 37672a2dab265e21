"""Operators that depend on an order; each takes a total order, rows have none of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keys = Sequence[str]
Order = Sequence[Column]


def keep_first(df: DataFrame, keys: Keys, order: Order) -> DataFrame:
    """One row per key, the first in ``order``."""
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("__rank = 1").drop("__rank")


def keep_last(df: DataFrame, keys: Keys, ordinal: str, *ties: str) -> DataFrame:
    """One row per key, the one with the largest ordinal (NULLs never win over values)."""
    return keep_first(df, keys, [F.col(c).desc_nulls_last() for c in (ordinal, *ties)])


def keep_best_game(games: DataFrame, ordinal: str) -> DataFrame:
    """One listing per game: a finished one before others, then the earliest start (none last)."""
    return keep_first(games, ["game_pk"], [F.col("is_final").desc_nulls_last(), F.col("first_pitch_utc").asc_nulls_last(), F.col(ordinal).asc()])


def flag_first(df: DataFrame, keys: Keys, order: Order, flag: str) -> DataFrame:
    """All rows, with a flag on exactly one row of each key: the first in ``order``."""
    return df.withColumn(flag, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1)


def last_before(df: DataFrame, keys: Keys, time: str, cutoff: Column, *ties: str) -> DataFrame:
    """The last row of each key strictly before ``cutoff``."""
    return keep_last(df.where(F.col(time) < cutoff), keys, time, *ties)


def duplicates(df: DataFrame, keys: Keys) -> DataFrame:
    """Per key that occurs more than once: n, its rows, and extra, those beyond the first."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").withColumn("extra", F.col("n") - 1)


def with_position(df: DataFrame, array: str, item: str, position: str) -> DataFrame:
    """One row per array element, with its position from 1."""
    return df.select("*", F.posexplode(array).alias("__at", item)).withColumn(position, F.col("__at") + 1).drop("__at", array)
