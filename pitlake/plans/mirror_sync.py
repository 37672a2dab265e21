"""Loading the star mirror from the store, season by season, and comparing the two.

The mirror is a second store: dimensions of books and games, insert-only lines by
season, and one row of provenance a season.  Loading again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.catalog import BOXSCORE_TABLES, DDL, TABLES, TableSpec, conform
from ..sources.sql_sink import SqlTarget, upsert_sql
from ..sources.store import Store
from . import mirror
from .validation import compare_counts

_GAMES = ", ".join(" ".join(DDL["odds_games"].split()).split(", ")[: mirror.GAME_COLUMNS])
#: The books are few and lie in one partition.
MIRROR = {
    "books": TableSpec("books", ("book_id",), "part", ("book_id",), None, "book_id int, slug string, name string, part int"),
    "odds_games": TableSpec("odds_games", ("game_pk",), "season_year", ("game_pk",), "game_pk", _GAMES),
    "odds_lines": TableSpec(
        "odds_lines", mirror.LINE_KEY, "season_year", mirror.LINE_KEY[:-1], "game_pk",
        "game_pk string, market_id int, book_id int, line_ts timestamp, season_year int, mins_to_tip int, is_pregame boolean, is_opener boolean, "
        "left_line smallint, left_price smallint, right_line smallint, right_price smallint",
    ),
    "load_meta": TableSpec(
        "load_meta", ("season_year",), "season_year", ("season_year",), None,
        "season_year int, source_ticks long, games_seen long, games_loaded long, loaded_ticks long, dropped_rows string, loaded_at timestamp",
    ),
    **{t: TABLES[t] for t in ("games", *BOXSCORE_TABLES)},
}


def open_mirror(spark: SparkSession, root: str) -> Store:
    return Store(spark, root, MIRROR)


def drop_mirror(spark: SparkSession, root: str) -> list[str]:
    """Delete the mirror's tables, and nothing else that lies there; the names of those that were there."""
    target = open_mirror(spark, root)
    return [t for t in MIRROR if target.drop(t)]


def sync_odds(store: Store, target: Store, season: int, loaded_at: Column, tagged: DataFrame | None = None) -> dict[str, int]:
    """Books, games and lines of a season that the mirror lacks, then the season's provenance; rows written per table.

    ``tagged`` (season_year, drop_reason, repair_reason) are the ticks as they were
    cleaned, for the account of drops and repairs.
    """
    ticks, games = store.read("odds_ticks", [season]), store.read("odds_games", [season])
    known = target.read("books").drop("part")
    books = mirror.books(known, ticks).withColumn("part", F.lit(0)).persist()
    try:
        written = {"books": target.insert_only("books", books)}
        written["odds_games"] = target.insert_only("odds_games", mirror.new_games(target.read("odds_games", [season]), games))
        lines = mirror.lines(ticks, books.drop("part"))
        written["odds_lines"] = target.insert_only("odds_lines", mirror.new_lines(target.read("odds_lines", [season]), lines))
        if tagged is None:
            tagged = ticks.select("season_year", F.lit(None).cast("string").alias("drop_reason"), F.lit(None).cast("string").alias("repair_reason"))
        meta = mirror.load_provenance(games, tagged, ticks).withColumn("loaded_at", loaded_at)
        written["load_meta"] = target.upsert("load_meta", meta)
        return written
    finally:
        books.unpersist()


def sync_tables(store: Store, target: Store, season: int, tables: Sequence[str] = ("games", *BOXSCORE_TABLES)) -> dict[str, int]:
    """The season's rows of some tables, upserted: corrections in the store reach the mirror."""
    return {t: target.upsert(t, conform(store.read(t, [season]), target.tables[t].schema)) for t in tables}


def sync_sql(store: Store, connect: Callable[[], Any], seasons: Sequence[int], tables: Sequence[str] = ("games", *BOXSCORE_TABLES), connections: int = 8, whole: bool = False, prefix: str = "", **how: Any) -> dict[str, int]:
    """The seasons' rows of some tables, upserted into a SQL database; rows sent per table."""
    sent = {}
    for t in tables:
        rows = store.read(t, seasons)
        sent[t] = rows.count()
        if sent[t]:
            upsert_sql(rows, SqlTarget(connect, prefix + t, store.tables[t].key, **how), connections, whole)
    return sent


def verify(store: Store, target: Store, seasons: Sequence[int]) -> DataFrame:
    """(table, local_rows, remote_rows, matches) of all that both sides hold."""
    pairs = {"odds_ticks": "odds_lines", "odds_games": "odds_games", **{t: t for t in ("games", *BOXSCORE_TABLES)}}

    def counts(side: Store, of: dict[str, str]) -> DataFrame:
        found = None
        for shown, table in of.items():
            one = side.read(table, seasons).agg(F.lit(shown).alias("table"), F.count("*").alias("rows"))
            found = one if found is None else found.unionByName(one)
        return found

    return compare_counts(counts(store, {t: t for t in pairs}), counts(target, pairs))
