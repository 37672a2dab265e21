"""Streams of ticks and captures into the store.

The batch rules stay the truth: a micro-batch drops repeats within the watermark
and upserts, and the openers of the games it touches are set anew from their whole
history.  Upserts are idempotent, so a replayed micro-batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.quotes import repair_openers
from ..sources.catalog import TABLES
from ..sources.store import Store


def read_ticks(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    return spark.readStream.schema(TABLES["odds_ticks"].schema).option("maxFilesPerTrigger", max_files).parquet(path)


def distinct_ticks(ticks: DataFrame, delay: str = "1 day") -> DataFrame:
    """Each tick key once; state older than the delay is forgotten."""
    return ticks.withWatermark("line_ts", delay).dropDuplicatesWithinWatermark(list(TABLES["odds_ticks"].key))


def write_ticks(ticks: DataFrame, store: Store, checkpoint: str, **trigger) -> StreamingQuery:
    """Start the stream; ``trigger`` goes to DataStreamWriter.trigger (availableNow=True by default)."""

    def batch(df: DataFrame, _: int) -> None:
        df = df.persist()
        try:
            seasons = [r[0] for r in df.select("season_year").distinct().collect()]
            if seasons:
                store.upsert("odds_ticks", repair_openers(store.read("odds_ticks", seasons), df))
        finally:
            df.unpersist()

    return ticks.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def quote_rates(ticks: DataFrame, window: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """Ticks and games per book and window of time, final once the watermark has passed."""
    return (
        ticks.withWatermark("line_ts", delay)
        .groupBy(F.window("line_ts", window).alias("w"), "book_slug")
        .agg(F.count("*").alias("n_ticks"), F.approx_count_distinct("game_pk").alias("n_games"))
        .select(F.col("w.start").alias("from_ts"), "book_slug", "n_ticks", "n_games")
    )
