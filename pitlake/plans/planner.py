"""What to fetch next, as a query over what is stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.gaps import incomplete, missing, missing_since_first, refresh_dates

#: The share of a day's games from which a book is expected to have all; statuses that end the wait for a game.
EXPECTED_SHARE = 0.5
SETTLED = ("complete", "no_quotes")
PITCHES_SETTLED = ("complete", "no_data")


def eligible(games: DataFrame) -> DataFrame:
    return games.where("is_final")


def missing_boxscores(games: DataFrame, children: Sequence[DataFrame]) -> DataFrame:
    """Finished games that a box-score table lacks, oldest first."""
    return incomplete(eligible(games), children, "game_pk").orderBy("game_date", "game_pk")


def missing_pitches(games: DataFrame, markers: DataFrame) -> DataFrame:
    done = markers.where(F.col("fetch_status").isin(*PITCHES_SETTLED))
    return missing(eligible(games), done, ["game_pk"]).orderBy("game_date", "game_pk")


def gap_games(games: DataFrame, odds_games: DataFrame, ticks: DataFrame, fetches: DataFrame | None) -> DataFrame:
    """Finished games without quotes, from the first stored date on.

    With ``fetches``, games that are settled or have ticks count as stored, so a
    rejected one stays a gap; without, games in the dimension or with ticks do.
    """
    known = odds_games if fetches is None else fetches.where(F.col("ingest_status").isin(*SETTLED))
    stored = known.select("game_pk").union(ticks.select("game_pk")).distinct()
    return missing_since_first(eligible(games), stored, "game_pk", "game_date", odds_games)


def book_coverage(ticks: DataFrame, date: str, book: str, game: str) -> DataFrame:
    """Per date and book: games with the book, games with any, whether all are expected, whether some lack."""
    per_book = ticks.groupBy(date, book).agg(F.countDistinct(game).alias("games_with_book"))
    per_date = ticks.groupBy(date).agg(F.countDistinct(game).alias("games_on_date"))
    expected = F.col("games_with_book") >= EXPECTED_SHARE * F.col("games_on_date")
    return per_book.join(per_date, date).withColumns({"expected": expected, "partial": expected & (F.col("games_with_book") < F.col("games_on_date"))})


def partial_dates(ticks: DataFrame, discontinued: Sequence[str] = ()) -> DataFrame:
    """Dates on which a book that has most games lacks some; discontinued books don't count."""
    live = ticks.where(~F.col("book_slug").isin(*discontinued)) if discontinued else ticks
    return book_coverage(live, "game_date", "book_slug", "game_pk").where("partial").select("game_date").distinct()


def plan_update(
    games: DataFrame, odds_games: DataFrame, ticks: DataFrame, fetches: DataFrame | None, today: Column, refresh_days: int = 3, discontinued: Sequence[str] = ()
) -> DataFrame:
    """(game_date, reasons): recent dates to refresh, dates with gaps, dates with partial books."""
    parts = (
        (refresh_dates(eligible(games), "game_date", today, refresh_days), "refresh"),
        (gap_games(games, odds_games, ticks, fetches).select("game_date").distinct(), "gap"),
        (partial_dates(ticks, discontinued), "partial"),
    )
    every = None
    for dates, reason in parts:
        one = dates.select(F.to_date("game_date").alias("game_date"), F.lit(reason).alias("reason"))
        every = one if every is None else every.unionByName(one)
    return every.groupBy("game_date").agg(F.array_sort(F.collect_set("reason")).alias("reasons")).orderBy("game_date")


def oldest(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def odds_coverage(odds_games: DataFrame, ticks: DataFrame) -> DataFrame:
    """Per season: ticks, games, pre-game share, books, and dimension rows by status."""
    facts = ticks.groupBy("season_year").agg(
        F.count("*").alias("n_ticks"), F.countDistinct("game_pk").alias("n_games"), F.countDistinct("book_slug").alias("n_books"),
        F.sum(F.col("is_pregame").cast("int")).alias("n_pregame"),
    )
    dims = odds_games.groupBy("season_year").agg(F.count("*").alias("n_listed"), F.count(F.when(F.col("ingest_status") == "complete", 1)).alias("n_complete"))
    return facts.join(dims, "season_year", "full").withColumn("pregame_share", F.bround(F.try_divide("n_pregame", "n_ticks"), 4)).orderBy("season_year")


def pitch_coverage(markers: DataFrame, statuses: Sequence[str] = ("complete", "no_data", "error")) -> DataFrame:
    """Games per season and status, a column a status, 0 where there is none."""
    return markers.groupBy("season_year").pivot("fetch_status", list(statuses)).agg(F.countDistinct("game_pk")).na.fill(0).orderBy("season_year")


def share_of_books(ticks: DataFrame) -> DataFrame:
    """Distinct books of each game, sorted."""
    return ticks.groupBy("game_pk").agg(F.array_sort(F.collect_set("book_slug")).alias("books"))
