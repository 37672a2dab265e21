"""Schedule, venue and transaction payloads, one JSON document per input row (column payload)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import as_id, backdated_days, game_type_name, is_backdated, is_ingested, is_injury, is_postseason, or_else, season_of, to_int
from ..functions.teams import HOME_PLATE, alias_table, team_table
from ..operators.ordered import keep_best_game, keep_first
from .catalog import TABLES, conform

_TEAM = "struct<team: struct<id: string, name: string>, score: string, probablePitcher: struct<id: string>>"
_TOTALS = "struct<runs: string, hits: string, errors: string>"
_LINEUP = "array<struct<id: string, fullName: string, primaryPosition: struct<code: string, abbreviation: string>>>"
SCHEDULE = (
    "dates array<struct<games: array<struct<gamePk: string, season: string, officialDate: string, gameDate: string, gameType: string, seriesDescription: string, "
    "gameNumber: string, doubleHeader: string, dayNight: string, scheduledInnings: string, status: struct<statusCode: string, detailedState: string, abstractGameState: string>, "
    f"venue: struct<id: string, name: string>, teams: struct<home: {_TEAM}, away: {_TEAM}>, "
    f"linescore: struct<currentInning: string, teams: struct<home: {_TOTALS}, away: {_TOTALS}>>, "
    "weather: struct<condition: string, temp: string, wind: string>, seriesGameNumber: string, gamesInSeries: string, "
    f"officials: array<struct<official: struct<id: string, fullName: string>, officialType: string>>, lineups: struct<homePlayers: {_LINEUP}, awayPlayers: {_LINEUP}>>>>>"
)


def listed_games(raw: DataFrame) -> DataFrame:
    """One row per listed game of an ingested type: g, its season, date and start, and ordinal, its place in the payloads.

    ``raw`` may carry an ordinal of its own (column ordinal); payloads are ordered by it.
    """
    first = F.col("ordinal") if "ordinal" in raw.columns else F.lit(0)
    days = raw.select(first.alias("file"), F.posexplode(F.from_json("payload", SCHEDULE)["dates"]).alias("day", "d"))
    games = days.select("file", "day", F.posexplode("d.games").alias("place", "g"))
    games = games.where(is_ingested("g.gameType"))
    return games.select(
        F.struct("file", "day", "place").alias("ordinal"), "g", as_id("g.gamePk").alias("game_pk"),
        F.to_date("g.officialDate").alias("game_date"), F.to_timestamp("g.gameDate").alias("first_pitch_utc"),
    ).withColumn("season_year", season_of("game_date"))


def with_participants(games: DataFrame) -> DataFrame:
    """Adds home/away ids and names, and participants: 'known', 'placeholder' or 'unknown'.

    A team that is neither in the team table by id nor in the alias table by name is
    a placeholder on a postseason game that is not over, else unknown.
    """
    spark = games.sparkSession
    ids = team_table(spark).select("team_id", F.lit(True).alias("known"))
    names = alias_table(spark).select("alias", "team_name")
    df = games
    for side in ("home", "away"):
        df = df.withColumns({f"{side}_team_id": as_id(f"g.teams.{side}.team.id"), "__name": F.trim(f"g.teams.{side}.team.name")})
        df = df.join(F.broadcast(ids), F.col(f"{side}_team_id") == F.col("team_id"), "left").withColumnRenamed("known", f"__{side}").drop("team_id")
        df = df.join(F.broadcast(names), F.col("__name") == F.col("alias"), "left").withColumnRenamed("team_name", f"{side}_team_name").drop("alias", "__name")
    open_bracket = is_postseason("g.gameType") & F.coalesce(F.col("g.status.abstractGameState") != "Final", F.lit(True))
    placeholder, unknown = F.lit(False), F.lit(False)
    for side in ("home", "away"):
        strange = F.col(f"__{side}").isNull()
        placeholder = placeholder | (strange & open_bracket)
        unknown = unknown | F.col(f"{side}_team_name").isNull()
    kind = F.when(placeholder, "placeholder").when(unknown, "unknown").otherwise("known")
    return df.withColumn("participants", kind).drop("__home", "__away")


def games(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Games with known teams, one row per game id, the best listing.

    With ``strict`` an unknown team that is no placeholder stops the job.
    """
    df = with_participants(listed_games(raw)).where("participants != 'placeholder'")
    if strict:
        name = F.when(F.col("participants") == "unknown", F.raise_error(F.concat(F.lit("unknown team in game "), F.col("game_pk"))).cast("string"))
        df = df.withColumn("game_pk", F.coalesce(name, F.col("game_pk")))
    else:
        df = df.where("participants = 'known'")
    c = F.col

    def total(side: str, what: str) -> Column:
        return to_int(f"g.linescore.teams.{side}.{what}")

    df = df.withColumns(
        {
            "game_type": c("g.gameType"), "season_type": game_type_name("g.gameType"), "series_description": c("g.seriesDescription"),
            "game_number": or_else(F.coalesce(to_int("g.gameNumber"), F.lit(1)), F.lit(1)), "doubleheader": F.coalesce("g.doubleHeader", F.lit("N")),
            "day_night": c("g.dayNight"), "scheduled_innings": or_else(F.coalesce(to_int("g.scheduledInnings"), F.lit(9)), F.lit(9)),
            "status_code": c("g.status.statusCode"), "status_detailed": c("g.status.detailedState"), "status_abstract": c("g.status.abstractGameState"),
            "venue_id": as_id("g.venue.id"), "venue_name": c("g.venue.name"),
            "home_score": F.coalesce(total("home", "runs"), to_int("g.teams.home.score")), "away_score": F.coalesce(total("away", "runs"), to_int("g.teams.away.score")),
            "home_hits": total("home", "hits"), "away_hits": total("away", "hits"), "home_errors": total("home", "errors"), "away_errors": total("away", "errors"),
            "innings_played": to_int("g.linescore.currentInning"), "home_probable_pitcher_id": as_id("g.teams.home.probablePitcher.id"),
            "away_probable_pitcher_id": as_id("g.teams.away.probablePitcher.id"), "weather_condition": c("g.weather.condition"),
            "weather_temp_f": to_int("g.weather.temp"), "weather_wind": c("g.weather.wind"), "series_game_number": to_int("g.seriesGameNumber"),
            "games_in_series": to_int("g.gamesInSeries"),
        }
    ).withColumns(
        {
            "total_runs": c("home_score") + c("away_score"), "run_line_margin": c("home_score") - c("away_score"),
            "extra_innings": c("innings_played") > c("scheduled_innings"),
        }
    )
    df = df.withColumn("is_final", F.coalesce((c("status_abstract") == "Final") & c("total_runs").isNotNull(), F.lit(False)))
    return conform(keep_best_game(df, "ordinal"), TABLES["games"].schema)


def umpires(raw: DataFrame) -> DataFrame:
    df = listed_games(raw).select("game_pk", "season_year", "game_date", "ordinal", F.posexplode("g.officials").alias("at", "o"))
    df = df.withColumns(
        {
            "official_id": as_id("o.official.id"), "official_name": F.col("o.official.fullName"), "official_type": F.col("o.officialType"),
            "is_home_plate": F.coalesce(F.col("o.officialType") == HOME_PLATE, F.lit(False)),
        }
    )
    return conform(keep_first(df, TABLES["umpires"].key, [F.col("ordinal"), F.col("at")]), TABLES["umpires"].schema)


def lineups(raw: DataFrame) -> DataFrame:
    """Listed batters with their slot, from 1 in the order listed; a player listed twice has the lower slot."""
    both = F.array(
        F.struct(F.lit(True).alias("home"), F.col("g.teams.home.team.id").alias("team"), F.col("g.lineups.homePlayers").alias("players")),
        F.struct(F.lit(False).alias("home"), F.col("g.teams.away.team.id").alias("team"), F.col("g.lineups.awayPlayers").alias("players")),
    )
    meta = ("game_pk", "season_year", "game_date", "ordinal")
    df = listed_games(raw).select(*meta, F.explode(both).alias("s")).select(*meta, "s.home", as_id("s.team").alias("team_id"), F.posexplode("s.players").alias("at", "p"))
    df = df.withColumns(
        {
            "player_id": as_id("p.id"), "player_name": F.col("p.fullName"), "lineup_slot": F.col("at") + 1,
            "position_code": F.col("p.primaryPosition.code"), "position_abbrev": F.col("p.primaryPosition.abbreviation"),
        }
    )
    return conform(keep_first(df, TABLES["lineups"].key, [F.col("lineup_slot"), F.col("ordinal")]), TABLES["lineups"].schema)


VENUES = (
    "venues array<struct<id: string, name: string, active: boolean, season: string, location: struct<city: string, stateAbbrev: string, country: string, elevation: string, azimuthAngle: string, "
    "defaultCoordinates: struct<latitude: string, longitude: string>>, timeZone: struct<id: string, offset: string>, "
    "fieldInfo: struct<capacity: string, turfType: string, roofType: string, leftLine: string, left: string, leftCenter: string, center: string, rightCenter: string, right: string, rightLine: string>>>"
)


def venues(raw: DataFrame, season: int) -> DataFrame:
    df = raw.select(F.explode(F.from_json("payload", VENUES)["venues"]).alias("v"))
    c, field = F.col, "v.fieldInfo"
    df = df.withColumns(
        {
            "venue_id": as_id("v.id"), "season": F.coalesce(to_int("v.season"), F.lit(season)), "venue_name": c("v.name"), "active": c("v.active"),
            "city": c("v.location.city"), "state": c("v.location.stateAbbrev"), "country": c("v.location.country"),
            "latitude": c("v.location.defaultCoordinates.latitude").try_cast("double"), "longitude": c("v.location.defaultCoordinates.longitude").try_cast("double"),
            "elevation_ft": c("v.location.elevation").try_cast("double"), "azimuth_angle": c("v.location.azimuthAngle").try_cast("double"),
            "timezone_id": c("v.timeZone.id"), "timezone_offset": to_int("v.timeZone.offset"), "capacity": to_int(f"{field}.capacity"),
            "turf_type": c(f"{field}.turfType"), "roof_type": c(f"{field}.roofType"),
            **{ours: to_int(f"{field}.{theirs}") for ours, theirs in (("left_line", "leftLine"), ("left", "left"), ("left_center", "leftCenter"), ("center", "center"), ("right_center", "rightCenter"), ("right", "right"), ("right_line", "rightLine"))},
        }
    )
    return conform(df, TABLES["venues"].schema)


TRANSACTIONS = (
    "transactions array<struct<id: string, person: struct<id: string, fullName: string>, date: string, effectiveDate: string, resolutionDate: string, "
    "fromTeam: struct<id: string>, toTeam: struct<id: string>, typeCode: string, typeDesc: string, description: string>>"
)


def transactions(raw: DataFrame) -> DataFrame:
    """Announced moves; rows without a date of announcement are dropped."""
    df = raw.select(F.explode(F.from_json("payload", TRANSACTIONS)["transactions"]).alias("t"))

    def day(name: str) -> Column:
        return F.to_date(F.try_to_timestamp(F.substring(F.col(f"t.{name}"), 1, 10), F.lit("yyyy-MM-dd")))

    df = df.withColumns({"known_date": day("date"), "effective_date": day("effectiveDate"), "resolution_date": day("resolutionDate")}).where("known_date is not null")
    df = df.withColumns(
        {
            "transaction_id": as_id("t.id"), "player_id": as_id("t.person.id"), "player_name": F.col("t.person.fullName"), "season_year": season_of("known_date"),
            "backdated_days": backdated_days("known_date", "effective_date"), "is_backdated": is_backdated("known_date", "effective_date"),
            "from_team_id": as_id("t.fromTeam.id"), "to_team_id": as_id("t.toTeam.id"), "type_code": F.col("t.typeCode"), "type_desc": F.col("t.typeDesc"),
            "description": F.col("t.description"), "is_injury_related": is_injury("t.description", "t.typeDesc"),
        }
    )
    return conform(df, TABLES["transactions"].schema)


def repeated_listings(raw: DataFrame) -> DataFrame:
    """game_pk and how often it is listed, where more than once."""
    n = F.count("*").over(Window.partitionBy("game_pk"))
    return listed_games(raw).select("game_pk", n.alias("n")).where("n > 1").distinct()
