"""Ingestion: landed payloads to the store, in the order that makes a crash harmless.

Fetching is outside: payloads lie in a landing folder as text files (one JSON
document each) or as a table with a ``payload`` column.  Facts are written before
the marker that says they are complete.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import boxscores, quotes as quote_source, schedules
from ..sources.catalog import BOXSCORE_TABLES, TABLES, conform
from ..sources.store import Store
from .planner import gap_games, missing_boxscores as boxscore_gap, missing_pitches as pitch_gap, plan_update
from .quotes import changed_openers, odds_tables, repair_openers, resolve_events


def landed(spark: SparkSession, path: str) -> DataFrame:
    """payload and ordinal of the JSON files under ``path``; files are ordered by name."""
    raw = spark.read.option("wholetext", True).text(path).select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("ordinal"))
    return raw


def landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """The JSON that HTML pages embed; pages without it have payload ''."""
    return landed(spark, path).withColumn("payload", quote_source.page_json("payload"))


def update_games(store: Store, raw: DataFrame, season: int, exclude_dates: Sequence[str] = (), include_unfinished: bool = False) -> dict[str, int]:
    """Games, umpires and lineups of a season from schedule payloads; rows written per table.

    The children of a game are replaced as a whole.
    """
    listed = schedules.games(raw).where(F.col("season_year") == season)
    if exclude_dates:
        listed = listed.where(~F.col("game_date").isin(*(F.lit(d).cast("date") for d in exclude_dates)))
    if not include_unfinished:
        listed = listed.where("is_final")
    listed = listed.persist()
    try:
        written = {"games": store.upsert("games", listed)}
        for table, rows in (("umpires", schedules.umpires(raw)), ("lineups", schedules.lineups(raw))):
            own = rows.join(listed.select("game_pk"), "game_pk", "left_semi")
            written[table] = store.replace_children(table, own, own.select("game_pk"), season)
        return written
    finally:
        listed.unpersist()


def missing_boxscores(store: Store, season: int) -> DataFrame:
    return boxscore_gap(store.read("games", [season]), [store.read(t, [season]) for t in BOXSCORE_TABLES])


GRAINS = {"team_games": boxscores.team_games, "batter_games": boxscores.batter_games, "pitcher_appearances": boxscores.pitcher_appearances, "umpires": boxscores.officials}


def skipped_boxscores(raw: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(game_pk, reason) of the payloads that say nothing: no_json, no_teams; of games that are not ``known``: unknown_game."""
    parsed = raw.select("game_pk", F.from_json("payload", boxscores.SCHEMA).alias("p"), F.try_parse_json("payload").alias("j"))
    teams = F.col("p.teams.home.team.id").isNotNull() & F.col("p.teams.away.team.id").isNotNull()
    reason = F.when(F.col("j").isNull(), "no_json").when(~F.coalesce(teams, F.lit(False)), "no_teams")
    if known is None:
        return parsed.select("game_pk", reason.alias("reason")).where("reason is not null")
    there = known.select("game_pk", F.lit(True).alias("__known")).distinct()
    judged = parsed.select("game_pk", reason.alias("reason")).join(there, "game_pk", "left")
    return judged.select("game_pk", F.when(F.col("__known").isNull(), "unknown_game").otherwise(F.col("reason")).alias("reason")).where("reason is not null")


def with_games(store: Store, rows: DataFrame, season: int) -> DataFrame:
    """Payloads of games that the store has, with what their rows take from the game."""
    meta = store.read("games", [season]).select("game_pk", "season_year", "game_date", "first_pitch_utc", "game_type", "venue_id")
    return rows.join(meta, "game_pk")


def update_boxscores(store: Store, raw: DataFrame, season: int, batches: int = 1) -> dict[str, int]:
    """The four grains of the season's games whose payloads (game_pk, payload) have landed.

    What a payload says replaces all that is stored of its game, so that a player
    whom a correction removes is gone.  Payloads without teams are left for the next
    run, and so are those of games that the store does not have (``skipped_boxscores``
    names both, given the games).  With several ``batches`` each is whole
    in all tables before the next begins.
    """
    rows = with_games(store, raw.select("game_pk", "payload").join(skipped_boxscores(raw).select("game_pk"), "game_pk", "left_anti"), season)
    written = dict.fromkeys(GRAINS, 0)
    for i in range(batches):
        mine = rows.where(F.pmod(F.xxhash64("game_pk"), F.lit(batches)) == i).persist()
        try:
            for table, parse in GRAINS.items():
                written[table] += store.replace_children(table, parse(mine), mine.select("game_pk"), season)
        finally:
            mine.unpersist()
    return written


def update_venues(store: Store, raw: DataFrame, season: int) -> int:
    return store.upsert("venues", schedules.venues(raw, season))


def update_transactions(store: Store, raw: DataFrame) -> int:
    return store.upsert("transactions", schedules.transactions(raw))


def update_season(store: Store, season: int, schedule: DataFrame, venues: DataFrame, box: DataFrame, transactions: DataFrame, today: str) -> dict[str, int]:
    """A whole season in order of dependence; games of today are left for tomorrow."""
    written = update_games(store, schedule, season, exclude_dates=[today])
    written["venues"] = update_venues(store, venues, season)
    written |= {f"boxscore_{t}": n for t, n in update_boxscores(store, box, season).items()}
    written["transactions"] = update_transactions(store, transactions)
    return written


def update_recent_days(store: Store, schedule: DataFrame, box: DataFrame, today: Column, days_back: int = 3, transactions: DataFrame | None = None) -> dict[str, int]:
    """The last ``days_back`` days before today once more: late corrections replace what is stored.

    Finished games are upserted; their umpires, lineups and box scores are replaced,
    season by season, and transactions are upserted.  Without such games nothing is written.
    """
    recent = schedules.games(schedule).where(F.col("game_date").between(F.date_sub(today, days_back), F.date_sub(today, 1)) & F.col("is_final")).persist()
    try:
        seasons = sorted(r[0] for r in recent.select("season_year").distinct().collect())  # one or two
        if not seasons:
            return {}
        written = {"games": store.upsert("games", recent)}
        for season in seasons:
            own = recent.where(F.col("season_year") == season).select("game_pk")
            for table, rows in (("umpires", schedules.umpires(schedule)), ("lineups", schedules.lineups(schedule))):
                written[table] = written.get(table, 0) + store.replace_children(table, rows.join(own, "game_pk", "left_semi"), own, season)
            for table, n in update_boxscores(store, box.join(own, "game_pk", "left_semi"), season).items():
                written[f"boxscore_{table}"] = written.get(f"boxscore_{table}", 0) + n
        if transactions is not None:
            written["transactions"] = update_transactions(store, transactions)
        return written
    finally:
        recent.unpersist()


# -- pitches ----------------------------------------------------------------------------


def missing_pitches(store: Store, season: int) -> DataFrame:
    return pitch_gap(store.read("games", [season]), store.read("statcast_games", [season]))


def update_pitches(store: Store, raw: DataFrame, fetched: DataFrame, season: int) -> dict[str, int]:
    """Pitches of the fetched games (game_pk, game_date, fetched_at_utc), then a marker each: complete, or no_data without pitches."""
    pitches = quote_source.pitches(raw, season).persist()
    try:
        facts = store.replace_children("statcast_pitches", pitches, fetched, season)
        n = pitches.groupBy("game_pk").agg(F.count("*").cast("int").alias("pitch_rows"))
        marks = fetched.join(n, "game_pk", "left").na.fill(0, ["pitch_rows"]).withColumn("season_year", F.lit(season))
        marks = marks.withColumn("fetch_status", F.when(F.col("pitch_rows") > 0, "complete").otherwise("no_data"))
        return {"statcast_pitches": facts, "statcast_games": store.upsert("statcast_games", conform(marks, TABLES["statcast_games"].schema))}
    finally:
        pitches.unpersist()


# -- odds -------------------------------------------------------------------------------


def current_plan(store: Store, seasons: Sequence[int], today: Column, refresh_days: int = 3, discontinued: Sequence[str] = ()) -> DataFrame:
    read = lambda t: store.read(t, seasons)
    return plan_update(read("games"), read("odds_games"), read("odds_ticks"), read("odds_fetches"), today, refresh_days, discontinued)


def odds_gap(store: Store, seasons: Sequence[int]) -> DataFrame:
    read = lambda t: store.read(t, seasons)
    return gap_games(read("games"), read("odds_games"), read("odds_ticks"), read("odds_fetches"))


def ingest_odds(store: Store, raw: DataFrame, season: int, fetched_at: Column) -> tuple[dict[str, int], DataFrame]:
    """Ticks, then repaired openers, then the dimension, then the completion marker of a season's line histories.

    Returns rows written per table and the account: (reason, n) of drops, repairs and unmatched events.
    """
    scraped = quote_source.scraped_games(raw).where(F.col("season_year") == season).persist()
    try:
        games = store.read("games", [season])
        load, dim, tagged = odds_tables(scraped.where("reason is null"), quote_source.ticks(scraped), games)
        load, dim = load.persist(), dim.withColumn("fetched_at_utc", fetched_at).persist()
        written = {"odds_ticks": store.upsert("odds_ticks", repair_openers(store.read("odds_ticks", [season]), load))}
        written["odds_games"] = store.upsert("odds_games", dim)
        written["odds_fetches"] = store.upsert("odds_fetches", conform(dim, TABLES["odds_fetches"].schema))
        unmatched = resolve_events(scraped.where("reason is null").drop("books", "views"), games).select("reason")
        reasons = tagged.select(F.explode(F.array_compact(F.array("drop_reason", "repair_reason"))).alias("reason"))
        account = reasons.unionByName(unmatched.where("reason is not null")).unionByName(scraped.where("reason is not null").select("reason"))
        return written, account.groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "reason")
    finally:
        scraped.unpersist()


def repair_all_openers(store: Store, season: int) -> int:
    """Set every opener flag of a season anew; the number of flags that changed."""
    return store.upsert("odds_ticks", changed_openers(store.read("odds_ticks", [season])))


# -- migrations -------------------------------------------------------------------------


def repair_store(store: Store, season: int) -> dict[str, int]:
    """Idempotent repairs of old rows: inherited runners that are 0 all season are unknown; plate appearances decide who had one."""
    teams = store.read("team_games", [season])
    names = ("inherited_runners", "inherited_runners_scored")
    known = teams.agg(*(F.coalesce(F.max(F.abs(n)), F.lit(0)).alias(n) for n in names)).first()
    changed = {}
    flat = [n for n in names if known[n] == 0]
    if flat:
        bad = teams.where(" or ".join(f"{n} is not null" for n in flat)).withColumns({n: F.lit(None).cast("int") for n in flat})
        changed["team_games"] = store.upsert("team_games", bad)
    batters = store.read("batter_games", [season])
    right = F.coalesce(F.col("plate_appearances") > 0, F.lit(False))
    changed["batter_games"] = store.upsert("batter_games", batters.where(~F.col("had_plate_appearance").eqNullSafe(right)).withColumn("had_plate_appearance", right))
    return changed
