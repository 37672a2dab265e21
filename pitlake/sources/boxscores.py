"""Box-score payloads to four grains: teams, batters, pitchers, officials.

Input rows are (payload string, and the game's own columns game_pk, season_year,
game_date, first_pitch_utc, game_type, venue_id).  Statistics are parsed as maps:
an empty map says that a player has none, a missing key counts as 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import as_id, innings_to_outs, lineup_slot, obp, or_else, rate, substitution_index, to_int, whip
from ..functions.teams import HOME_PLATE
from .catalog import TABLES, conform

_STATS = "map<string,string>"
_PLAYER = f"struct<person: struct<id: string, fullName: string>, position: struct<code: string, abbreviation: string>, battingOrder: string, stats: struct<batting: {_STATS}, pitching: {_STATS}>>"
_SIDE = f"struct<team: struct<id: string, name: string>, teamStats: struct<batting: {_STATS}, pitching: {_STATS}, fielding: {_STATS}>, players: map<string, {_PLAYER}>, batters: array<string>, pitchers: array<string>, bullpen: array<string>, bench: array<string>>"
_LISTED = f"struct<team: struct<id: string>, players: map<string, {_PLAYER}>, pitchers: array<string>>"
SCHEMA = f"teams struct<home: {_SIDE}, away: {_SIDE}>, officials array<struct<official: struct<id: string, fullName: string>, officialType: string>>"
_PLAYERS = f"teams struct<home: {_LISTED}, away: {_LISTED}>"
_META = ("game_pk", "season_year", "game_date", "first_pitch_utc", "game_type", "venue_id")

# Our column and the provider's statistic.
_BATTING = {
    "plate_appearances": "plateAppearances", "at_bats": "atBats", "hits": "hits", "doubles": "doubles", "triples": "triples",
    "home_runs": "homeRuns", "rbi": "rbi", "walks": "baseOnBalls", "intentional_walks": "intentionalWalks", "strikeouts": "strikeOuts",
    "hit_by_pitch": "hitByPitch", "sac_flies": "sacFlies", "sac_bunts": "sacBunts", "total_bases": "totalBases", "stolen_bases": "stolenBases",
    "caught_stealing": "caughtStealing", "grounded_into_double_play": "groundIntoDoublePlay", "left_on_base": "leftOnBase",
    "ground_outs": "groundOuts", "air_outs": "airOuts",
}
_TEAM_BATTING = _BATTING | {"runs_scored": "runs", "fly_outs": "flyOuts", "line_outs": "lineOuts", "pop_outs": "popOuts"}
_TEAM_PITCHING = {
    "batters_faced": "battersFaced", "hits_allowed": "hits", "home_runs_allowed": "homeRuns", "walks_allowed": "baseOnBalls",
    "intentional_walks_allowed": "intentionalWalks", "strikeouts_thrown": "strikeOuts", "hit_batsmen": "hitBatsmen", "earned_runs": "earnedRuns",
    "runs_allowed": "runs", "wild_pitches": "wildPitches", "balks": "balks", "pitching_ground_outs": "groundOuts", "pitching_air_outs": "airOuts",
    "strikes": "strikes", "balls": "balls",
}
_PITCHING = {
    "batters_faced": "battersFaced", "strikes": "strikes", "balls": "balls", "runs_allowed": "runs", "earned_runs": "earnedRuns", "hits_allowed": "hits",
    "doubles_allowed": "doubles", "triples_allowed": "triples", "home_runs_allowed": "homeRuns", "walks_allowed": "baseOnBalls",
    "intentional_walks_allowed": "intentionalWalks", "strikeouts": "strikeOuts", "hit_batsmen": "hitBatsmen", "wild_pitches": "wildPitches",
    "balks": "balks", "ground_outs": "groundOuts", "air_outs": "airOuts", "fly_outs": "flyOuts", "line_outs": "lineOuts", "pop_outs": "popOuts",
    "inherited_runners": "inheritedRunners", "inherited_runners_scored": "inheritedRunnersScored", "wins": "wins", "losses": "losses", "saves": "saves",
    "holds": "holds", "blown_saves": "blownSaves", "complete_games": "completeGames", "games_started": "gamesStarted",
}


def _texts(names: set[str]) -> str:
    return f"struct<{', '.join(f'{n}: string' for n in sorted(names))}>"


# What team rows need of a payload: statistics by name, as fields; players are not parsed.
_TEAM_SIDE = (
    f"struct<team: struct<id: string>, teamStats: struct<batting: {_texts({*_TEAM_BATTING.values()})}, "
    f"pitching: {_texts({*_TEAM_PITCHING.values(), 'outs', 'inningsPitched', 'pitchesThrown', 'numberOfPitches', 'inheritedRunners', 'inheritedRunnersScored'})}, "
    "fielding: struct<errors: string>>, batters: array<string>, pitchers: array<string>, bullpen: array<string>, bench: array<string>>"
)
_TEAMS = f"teams struct<home: {_TEAM_SIDE}, away: {_TEAM_SIDE}>"


def _counts(stats: Column, names: dict[str, str]) -> dict[str, Column]:
    return {ours: to_int(stats[theirs], 0) for ours, theirs in names.items()}


def _outs(stats: Column) -> Column:
    return or_else(to_int(stats["outs"], 0), innings_to_outs(stats["inningsPitched"]))


def _pitches(stats: Column) -> Column:
    return or_else(to_int(stats["pitchesThrown"], 0), to_int(stats["numberOfPitches"], 0))


def sides(raw: DataFrame, schema: str = SCHEMA) -> DataFrame:
    """Two rows a game: the game's columns, home, own side and the other's team; ``schema`` is what is parsed of a payload."""
    parsed = raw.select(*_META, F.from_json("payload", schema).alias("p"))
    both = F.array(
        F.struct(F.lit(True).alias("home"), F.col("p.teams.home").alias("own"), F.struct(F.col("p.teams.away.team").alias("team")).alias("other")),
        F.struct(F.lit(False).alias("home"), F.col("p.teams.away").alias("own"), F.struct(F.col("p.teams.home.team").alias("team")).alias("other")),
    )
    return parsed.select(*_META, F.explode(both).alias("s")).select(*_META, "s.home", "s.own", "s.other")


def team_games(raw: DataFrame) -> DataFrame:
    own = F.col("own.teamStats")
    df = sides(raw, _TEAMS).withColumns(
        {
            "team_id": as_id("own.team.id"), "opponent_team_id": as_id("other.team.id"),
            **_counts(own["batting"], _TEAM_BATTING), **_counts(own["pitching"], _TEAM_PITCHING),
            "outs_recorded": _outs(own["pitching"]), "pitches_thrown": _pitches(own["pitching"]),
            # the team aggregate does not publish these: NULL, not 0
            "inherited_runners": to_int(own["pitching"]["inheritedRunners"]), "inherited_runners_scored": to_int(own["pitching"]["inheritedRunnersScored"]),
            "errors": to_int(own["fielding"]["errors"], 0),
            **{f"{n}_{w}": F.greatest(F.size(F.col(f"own.{f}")), F.lit(0)) for n, w, f in (("batters", "used", "batters"), ("pitchers", "used", "pitchers"), ("bullpen", "size", "bullpen"), ("bench", "size", "bench"))},
        }
    )
    c = F.col
    df = df.withColumns(
        {
            "singles": c("hits") - c("doubles") - c("triples") - c("home_runs"),
            "run_margin": c("runs_scored") - c("runs_allowed"), "total_runs": c("runs_scored") + c("runs_allowed"), "win": c("runs_scored") > c("runs_allowed"),
            "innings_pitched": rate("outs_recorded", F.lit(3)),
            "baserunners_allowed": c("hits_allowed") + c("walks_allowed") + c("hit_batsmen"),
            "obp": obp(c("hits"), c("walks"), c("hit_by_pitch"), c("at_bats"), c("sac_flies")),
            "slg": rate("total_bases", "at_bats"), "iso": rate(c("total_bases") - c("hits"), "at_bats"),
            "babip": rate(c("hits") - c("home_runs"), c("at_bats") - c("strikeouts") - c("home_runs") + c("sac_flies")),
            "runs_per_pa": rate("runs_scored", "plate_appearances"), "k_pct": rate("strikeouts", "plate_appearances"),
            "bb_pct": rate("walks", "plate_appearances"), "hr_per_pa": rate("home_runs", "plate_appearances"),
            "ground_out_air_out_ratio": rate("ground_outs", "air_outs"), "k_pct_allowed": rate("strikeouts_thrown", "batters_faced"),
            "bb_pct_allowed": rate("walks_allowed", "batters_faced"), "hr_per_bf_allowed": rate("home_runs_allowed", "batters_faced"),
            "whip": whip(c("walks_allowed"), c("hits_allowed"), c("outs_recorded")),
            "pitches_per_batter_faced": rate("pitches_thrown", "batters_faced"), "strike_pct": rate("strikes", "pitches_thrown"),
        }
    )
    return conform(df, TABLES["team_games"].schema)


def _players(raw: DataFrame, kind: str) -> DataFrame:
    """One row per player with statistics of a kind, in column ``st``."""
    df = sides(raw, _PLAYERS).select(*_META, "home", as_id("own.team.id").alias("team_id"), as_id("other.team.id").alias("opponent_team_id"), F.col("own.pitchers").alias("order"), F.explode(F.map_values("own.players")).alias("pl"))
    df = df.withColumn("st", F.col(f"pl.stats.{kind}")).where(F.size("st") > 0)
    return df.withColumns({"player_id": as_id("pl.person.id"), "player_name": F.col("pl.person.fullName")})


def batter_games(raw: DataFrame) -> DataFrame:
    df = _players(raw, "batting")
    c = F.col
    df = df.withColumns(
        {
            "position_code": c("pl.position.code"), "position_abbrev": c("pl.position.abbreviation"), "lineup_slot": lineup_slot("pl.battingOrder"),
            "substitution_index": substitution_index("pl.battingOrder"), **_counts(c("st"), _BATTING | {"runs": "runs"}),
        }
    )
    df = df.withColumns(
        {
            "is_starter": F.coalesce(c("substitution_index") == 0, F.lit(False)), "had_plate_appearance": c("plate_appearances") > 0,
            "singles": c("hits") - c("doubles") - c("triples") - c("home_runs"),
        }
    )
    return conform(df, TABLES["batter_games"].schema)


def pitcher_appearances(raw: DataFrame) -> DataFrame:
    c = F.col
    df = _players(raw, "pitching").withColumns({**_counts(c("st"), _PITCHING), "outs_recorded": _outs(c("st")), "pitches_thrown": _pitches(c("st"))})
    place = F.array_position(F.transform("order", lambda x: F.trim(x)), F.col("player_id")).cast("int")
    df = df.withColumns(
        {
            "is_starter": c("games_started") > 0, "appearance_number": F.when(place > 0, place), "innings_pitched": rate("outs_recorded", F.lit(3)),
            "k_pct": rate("strikeouts", "batters_faced"), "bb_pct": rate("walks_allowed", "batters_faced"), "hr_per_bf": rate("home_runs_allowed", "batters_faced"),
            "whip": whip(c("walks_allowed"), c("hits_allowed"), c("outs_recorded")), "pitches_per_batter_faced": rate("pitches_thrown", "batters_faced"),
            "strike_pct": rate("strikes", "pitches_thrown"), "ground_out_air_out_ratio": rate("ground_outs", "air_outs"),
        }
    )
    return conform(df, TABLES["pitcher_appearances"].schema)


def officials(raw: DataFrame) -> DataFrame:
    df = raw.select(*_META, F.explode(F.from_json("payload", SCHEMA)["officials"]).alias("o"))
    df = df.select(
        *_META, as_id("o.official.id").alias("official_id"), F.col("o.official.fullName").alias("official_name"),
        F.col("o.officialType").alias("official_type"), F.coalesce(F.col("o.officialType") == HOME_PLATE, F.lit(False)).alias("is_home_plate"),
    )
    return conform(df, TABLES["umpires"].schema)
