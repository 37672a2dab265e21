"""The star mirror: dimensions with surrogate ids, insert-only facts, load provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import display_name
from ..functions.teams import MARKETS
from ..operators.gaps import missing
from ..sources.catalog import TABLES

#: How many columns of odds_games the game dimension takes, and the key of a line.
GAME_COLUMNS = 13
LINE_KEY = ("game_pk", "market_id", "book_id", "line_ts", "season_year")


def assign_ids(existing: DataFrame, names: DataFrame, name: str, id_col: str) -> DataFrame:
    """Existing ids, and for new names the ids from the largest on, in order of the name.

    The names of a dimension are few (books, brands), so one task may number them.
    """
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    new = missing(names.select(name).where(F.col(name).isNotNull()).distinct(), existing, [name])
    numbered = new.withColumn(id_col, (top + F.row_number().over(Window.orderBy(name))).cast(existing.schema[id_col].dataType))
    return existing.select(name, id_col).unionByName(numbered.select(name, id_col))


def books(existing: DataFrame, ticks: DataFrame) -> DataFrame:
    """book_id, slug, name of all books, old and new."""
    ids = assign_ids(existing.select("slug", "book_id"), ticks.select(F.col("book_slug").alias("slug")), "slug", "book_id")
    return ids.join(existing.select("slug", "name"), "slug", "left").select("book_id", "slug", F.coalesce("name", display_name("slug")).alias("name"))


def markets(like: DataFrame) -> DataFrame:
    return like.sparkSession.createDataFrame([(i, code) for code, i in MARKETS.items()], "market_id int, code string")


def lines(ticks: DataFrame, book: DataFrame) -> DataFrame:
    """Ticks with the ids of market and book; a tick without either stops the job."""
    market = F.broadcast(markets(ticks).select("market_id", F.col("code").alias("market")))
    df = ticks.join(market, "market", "left").join(book.select("book_id", F.col("slug").alias("book_slug")), "book_slug", "left")
    for key, name in (("market_id", "market"), ("book_id", "book_slug")):
        stop = F.raise_error(F.concat(F.lit(f"unmapped {name}: "), F.coalesce(name, F.lit("NULL")))).cast("int")
        df = df.withColumn(key, F.coalesce(F.col(key).cast("int"), stop))
    return df.drop("market", "book_slug", "game_date")


def new_lines(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert-only: the incoming lines whose key is not stored."""
    return missing(incoming, stored, LINE_KEY)


def new_games(stored: DataFrame, odds_games: DataFrame) -> DataFrame:
    return missing(odds_games.select(*TABLES["odds_games"].schema.names[:GAME_COLUMNS]), stored, ["game_pk"])


def load_provenance(odds_games: DataFrame, tagged: DataFrame, loaded: DataFrame) -> DataFrame:
    """Per season: ticks seen and loaded, games seen and loaded, and the count of each drop and repair reason as JSON."""
    games = odds_games.groupBy("season_year").agg(
        F.sum("source_tick_count").alias("source_ticks"), F.count("*").alias("games_seen"), F.count(F.when(F.col("ingest_status") == "complete", 1)).alias("games_loaded")
    )
    n = loaded.groupBy("season_year").agg(F.count("*").alias("loaded_ticks"))
    reasons = tagged.select("season_year", F.explode(F.array_compact(F.array("drop_reason", "repair_reason"))).alias("reason")).groupBy("season_year", "reason").count()
    folded = reasons.groupBy("season_year").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "count"))))).alias("dropped_rows"))
    return games.join(n, "season_year", "left").join(folded, "season_year", "left").na.fill(0, ["loaded_ticks"])


def available_seasons(provenance: DataFrame) -> DataFrame:
    return provenance.select("season_year").distinct().orderBy("season_year")
