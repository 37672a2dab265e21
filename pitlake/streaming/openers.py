"""Openers of a stream of ticks, kept as state: the least tick of each game, market and book.

The result is a log of changes.  A tick that is earlier than all before it opens, and
the one that opened until then is taken back, so the log summed up says at any
time what a batch over all ticks would.  Repeats and replays add nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: Whose opener it is.
MARKET = ("game_pk", "market", "book_slug")
CHANGES = "game_pk string, market string, book_slug string, line_ts timestamp, change int"
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LeastTick(StatefulProcessor):
    """One number a key: the microsecond of its least tick.  A micro-batch of a key is read in chunks and gives two rows at most."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.least = handle.getValueState("least", "at bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        low = min(int(chunk["at"].min()) for chunk in rows)
        before = self.least.get()[0] if self.least.exists() else None
        if before is not None and before <= low:
            return
        self.least.update((low,))
        changes = [(*key, low, 1)] + ([] if before is None else [(*key, before, -1)])
        yield pd.DataFrame(changes, columns=[*MARKET, "at", "change"])

    def close(self) -> None:
        pass


def opener_changes(ticks: DataFrame) -> DataFrame:
    """A stream of ticks to a stream of (game_pk, market, book_slug, line_ts, change): 1 opens, -1 takes back.

    Ticks without a time or without a part of the key open nothing.  State is one number a key and is
    kept for good: a tick may come however late.  Sets the session's state store
    to RocksDB, which this needs, where it is another.
    """
    spark = ticks.sparkSession
    if spark.conf.get(_STATE_STORE) != _ROCKS:
        spark.conf.set(_STATE_STORE, _ROCKS)
    timed = ticks.select(*MARKET, F.unix_micros("line_ts").alias("at")).dropna()
    found = timed.groupBy(*MARKET).transformWithStateInPandas(
        LeastTick(), "game_pk string, market string, book_slug string, at bigint, change int", outputMode="append", timeMode="none"
    )
    return found.select(*MARKET, F.timestamp_micros("at").alias("line_ts"), "change")


def write_changes(changes: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append the changes to a Parquet log, each once also over restarts; ``trigger`` as in ``write_ticks``."""
    sink = changes.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return sink.trigger(**(trigger or {"availableNow": True})).start()


def current_openers(log: DataFrame) -> DataFrame:
    """What the log says now: one opener of each game, market and book."""
    return log.groupBy(*MARKET, "line_ts").agg(F.sum("change").alias("n")).where("n > 0").drop("n")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHANGES).parquet(path)


def flagged_by_log(ticks: DataFrame, log: DataFrame) -> DataFrame:
    """Stored ticks with ``is_opener`` as the log has it."""
    openers = current_openers(log).withColumn("__opens", F.lit(True))
    return ticks.drop("is_opener").join(openers, [*MARKET, "line_ts"], "left").withColumn("is_opener", F.coalesce("__opens", F.lit(False))).drop("__opens")
