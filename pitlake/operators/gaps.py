"""Gap queries: what should exist and does not."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """The key's distinct values that are not NULL."""
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def missing(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``expected`` without a partner; never NOT IN, which one NULL would empty."""
    return expected.join(present.select(*keys), list(keys), "left_anti")


def incomplete(parents: DataFrame, children: Sequence[DataFrame], key: str) -> DataFrame:
    """Parents that at least one of the child tables does not have."""
    complete = reduce(lambda a, b: a.intersect(b), (distinct_keys(c, key) for c in children))
    return parents.join(complete, key, "left_anti")


def missing_since_first(expected: DataFrame, present: DataFrame, key: str, date: str, first_of: DataFrame) -> DataFrame:
    """``missing``, from the smallest date of ``first_of`` on; if that is empty, from the start."""
    first = first_of.agg(F.min(date)).scalar()
    late = expected.where(F.coalesce(F.col(date) >= first, F.lit(True)))
    return missing(late, present, [key])


def refresh_dates(df: DataFrame, date: str, today: Column, days: int) -> DataFrame:
    """Distinct dates among the ``days`` before today; none for days <= 0."""
    return df.select(F.to_date(date).alias(date)).where(F.col(date).between(F.date_sub(today, days), F.date_sub(today, 1))).distinct()


def union_dates(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


def missing_dates(df: DataFrame, date: str, first: Column, last: Column) -> DataFrame:
    """Calendar dates from first to last (both included) that ``df`` does not have."""
    days = df.sparkSession.range(1).select(F.explode(F.sequence(first, last)).alias(date))
    return missing(days, df.select(F.to_date(date).alias(date)), [date])
