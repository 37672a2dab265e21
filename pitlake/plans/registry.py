"""The registry of queries: a name, a function of (spark, sf_dir), and SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None, *tables: str) -> Callable[[Callable[..., DataFrame]], Query]:
    """Register a function of some tables under its own name, with its SQL."""

    def register(f: Callable[..., DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(*(table(spark, sf_dir, t) for t in tables))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql is not None:
            SQL[f.__name__] = sql
        return run

    return register
