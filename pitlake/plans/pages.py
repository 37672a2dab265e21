"""Fetching pages by key: ids of events or days, a key a row, in tasks that wait between requests.

What is fetched comes from a table (the planner's gap, a range of days), so keys
are never gathered on the driver.  How a page is got is a function of its key; here
it is read from a folder where pages have landed.  A page that cannot be had is a row with a
reason, or stops the job, as the caller says.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow.fs import FileSelector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources.quotes import page_json, scraped_games, slate
from .archive import _opened, qualified

Fetch = Callable[[str], str]
_FETCHED = "key string, payload string, reason string, tries int"


class PageError(Exception):
    """A page that cannot be had: why, and whether another try may help."""

    def __init__(self, reason: str, transient: bool = False):
        super().__init__(reason)
        self.reason, self.transient = reason, transient


@dataclass(frozen=True)
class Folder:
    """Pages that lie as files ``root/KEY + suffix`` on any file system that tasks can open."""

    root: str
    suffix: str = ".html"

    def __call__(self, key: str) -> str:
        if not key or "/" in key or key.startswith("."):
            raise PageError("bad_key")
        fs, inside = _opened(f"{self.root}/{key}{self.suffix}")
        try:
            with fs.open_input_stream(inside) as f:
                return f.read().decode("utf-8")
        except FileNotFoundError:
            raise PageError("not_found") from None
        except UnicodeDecodeError:
            raise PageError("not_utf8") from None
        except OSError as error:
            raise PageError(f"io: {error}"[:200], transient=True) from error


@dataclass(frozen=True)
class Partitions:
    """Pages that a job has written as text, a partition each: the files of ``root/name=KEY``, in order of their names."""

    root: str
    name: str = "key"

    def __call__(self, key: str) -> str:
        if not key or "/" in key:
            raise PageError("bad_key")
        fs, inside = _opened(f"{self.root}/{self.name}={key}")
        try:
            files = sorted(f.path for f in fs.get_file_info(FileSelector(inside)) if f.is_file and not f.base_name.startswith(("_", ".")))
        except FileNotFoundError:
            raise PageError("not_found") from None
        parts = []
        for path in files:
            with fs.open_input_stream(path) as f:
                parts.append(f.read().decode("utf-8"))
        return "".join(parts)


def landed_folder(spark: SparkSession, root: str, suffix: str = ".html") -> Folder:
    return Folder(qualified(spark, root), suffix)


@dataclass(frozen=True)
class Manners:
    """How a task asks: seconds between pages, tries of a page that fails for now, seconds before the second try (then twice as many)."""

    pause: float = 0.0
    tries: int = 3
    backoff: float = 0.1

    def __post_init__(self) -> None:
        if self.tries < 1 or self.pause < 0 or self.backoff < 0:
            raise ValueError("a page is tried once or more, and nothing waits a negative time")


def _one(fetch: Fetch, key: str | None, strict: bool, manners: Manners) -> tuple[str | None, str | None, int]:
    if key is None:
        if strict:
            raise PageError("no_key")
        return None, "no_key", 0
    for attempt in range(1, manners.tries + 1):
        try:
            return fetch(key), None, attempt
        except PageError as error:
            if error.transient and attempt < manners.tries:
                time.sleep(manners.backoff * 2 ** (attempt - 1))
            elif strict:
                raise RuntimeError(f"page {key}: {error.reason}") from error
            else:
                return None, error.reason, attempt
    raise AssertionError("unreachable")


def fetch_pages(keys: DataFrame, column: str, fetch: Fetch, on_error: str = "warn", tasks: int | None = None, manners: Manners = Manners()) -> DataFrame:
    """key, payload, reason, tries: a row for each different key, with its page or the reason why there is none.

    ``tasks`` bounds the pages asked for at once (a provider's limit); ``on_error``
    is ``warn`` (the job goes on, reasons are rows) or ``raise``.  A task holds one page at a
    time; left out, ``tasks`` is the number of shuffle partitions, as keys are too small to be dealt out by their bytes.  A NULL key has reason no_key, an empty table gives none.  The result is
    lazy, and reading it twice fetches twice: write it first.
    """
    if on_error not in ("warn", "raise"):
        raise ValueError("on_error is warn or raise")
    strict = on_error == "raise"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waited = True
        for batch in batches:
            for key in batch.column(0).to_pylist():
                if not waited:
                    time.sleep(manners.pause)
                waited = not manners.pause
                payload, reason, tries = _one(fetch, key, strict, manners)
                row = ((key, pa.string()), (payload, pa.string()), (reason, pa.string()), (tries, pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in row], ["key", "payload", "reason", "tries"])

    wanted = keys.select(F.col(column).cast("string").alias("key")).distinct()
    n = tasks or int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = wanted.repartition(n, F.xxhash64("key"))  # by the key itself this would be the exchange of distinct(), which is made one task
    return dealt.mapInArrow(run, _FETCHED)


def days_between(spark: SparkSession, first: Column, last: Column) -> DataFrame:
    """day: each date from ``first`` to ``last``; none if they are the other way round."""
    days = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))
    return spark.range(1).select(F.explode(days).alias("day"))


def reasons(pages: DataFrame) -> DataFrame:
    """reason and n of the pages that were not had, the most frequent first."""
    return pages.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "reason")


def written(pages: DataFrame) -> DataFrame:
    """The pages as a table in the shared folder, so that nothing is asked for twice."""
    path = scratch_dir(pages.sparkSession)
    pages.write.parquet(path)
    return pages.sparkSession.read.schema(pages.schema).parquet(path)


def with_json(pages: DataFrame) -> DataFrame:
    """Pages reduced to the JSON in them; one without any has reason no_json."""
    body = F.when(F.col("reason").isNull(), page_json("payload"))
    return pages.withColumn("payload", F.nullif(body, F.lit(""))).withColumn("reason", F.coalesce("reason", F.when(F.col("payload").isNull(), "no_json")))


def scrape_events(events: DataFrame, fetch: Fetch, column: str = "event_id", on_error: str = "warn", **how) -> DataFrame:
    """``scraped_games`` of the line histories of some events, with key; pages that were not had keep their reason."""
    pages = with_json(fetch_pages(events, column, fetch, on_error, **how))
    games = scraped_games(pages.withColumnRenamed("reason", "__page"))
    return games.withColumn("reason", F.coalesce("__page", "reason")).drop("__page")


def discover_days(days: DataFrame, fetch: Fetch, column: str = "day", on_error: str = "warn", **how) -> tuple[DataFrame, DataFrame]:
    """The games that the pages of some days list, and the pages themselves (key, payload, reason, tries).

    A day whose page lists nothing has no slate and no reason.  The pages are
    fetched here, once, and written in the shared folder: both results read them.
    """
    pages = written(with_json(fetch_pages(days, column, fetch, on_error, **how)))
    return slate(pages.where("reason is null").select("payload", F.col("key").alias("ordinal"))), pages


def scrape_dates(days: DataFrame, slates: Fetch, histories: Fetch, column: str = "day", on_error: str = "warn", **how) -> DataFrame:
    """The line histories of every game that some days list; ids come from the listings, never from a range.

    A day that was not had is a row without an event, with the day as key and the reason.
    """
    listed, pages = discover_days(days, slates, column, on_error, **how)
    games = scrape_events(listed, histories, on_error=on_error, **how)
    lost = pages.where("reason is not null").select("key", "reason", "tries")
    return games.unionByName(lost, allowMissingColumns=True)
