"""Point-in-time snapshots: append-only captures, read as of an instant."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import eastern_date
from ..operators.gaps import missing_dates

KEY = ("kind", "slate_date")


def known_by(df: DataFrame, date: str, cutoff: Column) -> DataFrame:
    return df.where(F.col(date) <= cutoff)


def known_before(df: DataFrame, date: str, cutoff: Column) -> DataFrame:
    return df.where(F.col(date) < cutoff)


def header(kind: str, slate_date: str, captured_at: str, rows: DataFrame) -> DataFrame:
    """One row for a capture, also of nothing: an empty capture is a fact of its own."""
    return rows.agg(
        F.lit(kind).alias("kind"), F.lit(slate_date).cast("date").alias("slate_date"), F.lit(captured_at).cast("timestamp").alias("captured_at_utc"), F.count("*").alias("n_rows")
    )


def write_capture(headers_path: str, data_path: str, kind: str, slate_date: str, captured_at: str, rows: DataFrame) -> None:
    """Append the rows, then the header: a capture without a header does not exist yet."""
    stamped = rows.withColumns({"kind": F.lit(kind), "slate_date": F.lit(slate_date).cast("date"), "captured_at_utc": F.lit(captured_at).cast("timestamp")})
    stamped.write.mode("append").partitionBy("kind", "slate_date").parquet(f"{data_path}/{kind}")
    header(kind, slate_date, captured_at, rows).write.mode("append").parquet(headers_path)


def latest_capture(headers: DataFrame, instant: Column) -> DataFrame:
    """Per kind and date the last capture strictly before ``instant``."""
    return headers.where(F.col("captured_at_utc") < instant).groupBy(*KEY).agg(F.max("captured_at_utc").alias("captured_at_utc"))


def as_of(headers: DataFrame, data: DataFrame, instant: Column) -> DataFrame:
    """The rows of each kind's and date's last capture before ``instant``; one row of NULLs and snapshot_was_empty where it had none."""
    last = latest_capture(headers, instant).join(headers, [*KEY, "captured_at_utc"])
    return last.join(data, [*KEY, "captured_at_utc"], "left").withColumn("snapshot_was_empty", F.col("n_rows") == 0)


def coverage(headers: DataFrame) -> DataFrame:
    return headers.groupBy("kind").agg(
        F.count("*").alias("n_captures"), F.countDistinct("slate_date").alias("n_dates"), F.min("slate_date").alias("first_date"), F.max("slate_date").alias("last_date"),
        F.count(F.when(F.col("n_rows") == 0, 1)).alias("n_empty"),
    )


def missing_snapshot_dates(headers: DataFrame, kind: str, first: Column, last: Column) -> DataFrame:
    return missing_dates(headers.where(F.col("kind") == kind), "slate_date", first, last)


def league_today(now: Column) -> Column:
    """The date of the slate at an instant: the calendar date in New York."""
    return eastern_date(now)


def capture_dates(spark: SparkSession, now: Column, days_ahead: int = 1) -> DataFrame:
    """The slate dates that a capture at ``now`` covers: today and the days ahead."""
    first = league_today(now)
    return spark.range(1).select(F.explode(F.sequence(first, F.date_add(first, days_ahead))).alias("slate_date"))


def capture_all(
    spark: SparkSession, headers_path: str, data_path: str, captured_at: str, sources: Mapping[str, Callable[[str], DataFrame]], days_ahead: int = 1,
    days: Sequence[str] | None = None,
) -> tuple[dict[tuple[str, str], int], list[tuple[str, str, str]]]:
    """One capture of every kind for each of the ``days``; without them for each slate date from today (in New York, at ``captured_at``) on.

    ``sources`` gives the rows of a kind for a date.  A kind that fails does not stop
    the others.  Returns the rows of each (kind, date) and the failures (kind, date, what).
    """
    dates = list(days) if days is not None else [str(r[0]) for r in capture_dates(spark, F.lit(captured_at).cast("timestamp"), days_ahead).collect()]  # a few days
    taken, failed = {}, []
    for kind, rows_of in sources.items():
        for day in dates:
            try:
                rows = rows_of(day).persist()
                write_capture(headers_path, data_path, kind, day, captured_at, rows)
                taken[kind, day] = rows.count()
                rows.unpersist()
            except Exception as error:  # noqa: BLE001  (reported; the other captures are due all the same)
                failed.append((kind, day, f"{type(error).__name__}: {str(error).splitlines()[0]}"))
    return taken, failed
