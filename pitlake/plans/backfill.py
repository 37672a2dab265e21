"""Filling a store from landed payloads: the gap only, oldest first, in batches that a restart resumes.

A batch is a block of calendar days of a season, so that it is the same batch in every
run.  What is done is kept in a ledger beside the tables: season, batch, table.  The
batch's name holds a digest of its games and payloads; one whose payloads were
corrected, or to which games were added, is another batch and is done anew.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import schedules
from ..sources.catalog import TableSpec
from ..sources.store import Store
from . import ingest

LEDGER = {
    "batches": TableSpec(
        "batches", ("season_year", "batch", "table_name"), "season_year", ("season_year", "batch", "table_name"), None,
        "season_year int, batch string, table_name string, games long, rows long, done_at timestamp",
    )
}


def open_ledger(store: Store) -> Store:
    return Store(store.spark, f"{store.root}/_ledger", LEDGER)


@dataclass(frozen=True)
class Filled:
    """Rows written by table, batches written now, and batches that the ledger had."""

    written: dict[str, int]
    batches: int
    skipped: int


def _block(season: int, days: int) -> Column:
    return F.floor(F.date_diff(F.col("game_date"), F.lit(f"{season}-01-01").cast("date")) / days)


def due_boxscores(store: Store, raw: DataFrame, season: int) -> DataFrame:
    """(game_pk, payload, game_date) of the payloads that say something of games without complete box scores."""
    said = raw.select("game_pk", "payload").join(ingest.skipped_boxscores(raw).select("game_pk"), "game_pk", "left_anti")
    return said.join(ingest.missing_boxscores(store, season).select("game_pk", "game_date"), "game_pk")


def fill_boxscores(store: Store, raw: DataFrame, season: int, limit: int | None = None, days: int = 7) -> Filled:
    """Box scores of the season's gap: at most ``limit`` games, oldest first, ``days`` days a batch.

    Each batch is written to one table after the other and every table noted when it
    is whole; a restart goes on with the table that is not.  A game whose payload fills no
    row of some table stays in the gap, but its batch is done.
    """
    if days < 1 or limit is not None and limit < 0:
        raise ValueError("a batch has a day or more, a limit is not negative")
    ledger = open_ledger(store)
    order = F.struct("game_date", "game_pk")
    last = None
    if limit is not None:  # where the limit ends: one row
        first = due_boxscores(store, raw, season).select("game_date", "game_pk").distinct().orderBy("game_date", "game_pk").limit(limit)
        last = first.agg(F.max(order).alias("last")).first()["last"]
        if last is None:
            return Filled(dict.fromkeys(ingest.GRAINS, 0), 0, 0)

    def due() -> DataFrame:
        rows = due_boxscores(store, raw, season).withColumn("block", _block(season, days))
        return rows if last is None else rows.where(order <= F.struct(F.lit(last["game_date"]).alias("game_date"), F.lit(last["game_pk"]).alias("game_pk")))

    said = F.xxhash64("game_pk", "payload")
    blocks = due().groupBy("block").agg(F.countDistinct("game_pk").alias("games"), F.bit_xor(said).alias("a"), F.bit_xor(F.xxhash64(said)).alias("b"))
    blocks = blocks.select("block", "games", F.concat_ws("-", "block", F.hex("a"), F.hex("b")).alias("batch")).orderBy("block").collect()  # a season has some 300 days
    noted: dict[str, set[str]] = {}
    for r in ledger.read("batches", [season]).select("batch", "table_name").where(F.col("batch").isin([b["batch"] for b in blocks])).collect():
        noted.setdefault(r["batch"], set()).add(r["table_name"])
    written, skipped = dict.fromkeys(ingest.GRAINS, 0), 0
    for b in blocks:
        left = [t for t in ingest.GRAINS if t not in noted.get(b["batch"], ())]
        if not left:
            skipped += 1
            continue
        mine = ingest.with_games(store, due().where(F.col("block") == b["block"]).drop("game_date", "block"), season).persist()
        try:
            for table in left:
                n = store.replace_children(table, ingest.GRAINS[table](mine), mine.select("game_pk"), season)
                note = store.spark.range(1).select(
                    F.lit(season).alias("season_year"), F.lit(b["batch"]).alias("batch"), F.lit(table).alias("table_name"),
                    F.lit(b["games"]).alias("games"), F.lit(n).alias("rows"), F.current_timestamp().alias("done_at"),
                )
                ledger.upsert("batches", note)
                written[table] += n
        finally:
            mine.unpersist()
    return Filled(written, len(blocks) - skipped, skipped)


def backfill_season(store: Store, season: int, schedule: DataFrame, today: str, venues: DataFrame | None = None, transactions: DataFrame | None = None, box: DataFrame | None = None, limit: int | None = None, days: int = 7) -> dict[str, int]:
    """A season in order of dependence, from what has landed; games of ``today`` are left for tomorrow."""
    written = ingest.update_games(store, schedule, season, exclude_dates=[today])
    if venues is not None:
        written["venues"] = ingest.update_venues(store, venues, season)
    if transactions is not None:
        written["transactions"] = ingest.update_transactions(store, transactions)
    if box is not None:
        filled = fill_boxscores(store, box, season, limit, days)
        written |= {f"boxscore_{t}": n for t, n in filled.written.items()}
    return written


def slate_captures(spark: SparkSession, landing: str, rosters: bool = True) -> dict:
    """The kinds of a capture and the rows of each for a date, from the payloads landed under schedule, transactions and rosters/DATE."""

    def of_day(df: DataFrame, column: str, day: str) -> DataFrame:
        return df.where(F.col(column) == F.lit(day).cast("date"))

    def probables(day: str) -> DataFrame:
        listed = of_day(schedules.games(ingest.landed(spark, f"{landing}/schedule"), strict=False), "game_date", day)
        return listed.select("game_pk", "game_date", "first_pitch_utc", "home_team_id", "away_team_id", "home_probable_pitcher_id", "away_probable_pitcher_id")

    kinds = {
        "probables": probables,
        "lineups": lambda day: of_day(schedules.lineups(ingest.landed(spark, f"{landing}/schedule")), "game_date", day),
        "transactions": lambda day: of_day(schedules.transactions(ingest.landed(spark, f"{landing}/transactions")), "known_date", day),
    }
    if rosters:
        kinds["rosters"] = lambda day: ingest.landed(spark, f"{landing}/rosters/{day}").withColumnRenamed("ordinal", "file")
    return kinds
