"""The tables: keys, partitions, orders and schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The columns of each table, as DDL.
DDL = {
    "games": """
        game_pk STRING NOT NULL, season_year INT NOT NULL, game_date DATE NOT NULL, first_pitch_utc TIMESTAMP, game_type STRING NOT NULL,
        season_type STRING, series_description STRING, game_number INT, doubleheader STRING, day_night STRING, scheduled_innings INT,
        status_code STRING, status_detailed STRING, status_abstract STRING, is_final BOOLEAN NOT NULL, venue_id STRING, venue_name STRING,
        home_team_id STRING NOT NULL, home_team_name STRING, away_team_id STRING NOT NULL, away_team_name STRING, home_score INT,
        away_score INT, home_hits INT, away_hits INT, home_errors INT, away_errors INT, innings_played INT, extra_innings BOOLEAN,
        total_runs INT, run_line_margin INT, home_probable_pitcher_id STRING, away_probable_pitcher_id STRING, weather_condition STRING,
        weather_temp_f INT, weather_wind STRING, series_game_number INT, games_in_series INT
    """,
    "team_games": """
        game_pk STRING NOT NULL, team_id STRING NOT NULL, season_year INT NOT NULL, game_date DATE NOT NULL, first_pitch_utc TIMESTAMP,
        game_type STRING, venue_id STRING, home BOOLEAN NOT NULL, opponent_team_id STRING NOT NULL, runs_scored INT, runs_allowed INT,
        run_margin INT, total_runs INT, win BOOLEAN, plate_appearances INT, at_bats INT, outs_recorded INT, innings_pitched DOUBLE,
        batters_faced INT, pitches_thrown INT, baserunners_allowed INT, left_on_base INT, hits INT, singles INT, doubles INT, triples INT,
        home_runs INT, total_bases INT, walks INT, intentional_walks INT, strikeouts INT, hit_by_pitch INT, sac_flies INT, sac_bunts INT,
        stolen_bases INT, caught_stealing INT, grounded_into_double_play INT, rbi INT, ground_outs INT, air_outs INT, fly_outs INT,
        line_outs INT, pop_outs INT, hits_allowed INT, home_runs_allowed INT, walks_allowed INT, intentional_walks_allowed INT,
        strikeouts_thrown INT, hit_batsmen INT, earned_runs INT, wild_pitches INT, balks INT, inherited_runners INT,
        inherited_runners_scored INT, pitching_ground_outs INT, pitching_air_outs INT, strikes INT, balls INT, errors INT, obp DOUBLE, slg
        DOUBLE, iso DOUBLE, babip DOUBLE, runs_per_pa DOUBLE, k_pct DOUBLE, bb_pct DOUBLE, hr_per_pa DOUBLE, ground_out_air_out_ratio
        DOUBLE, k_pct_allowed DOUBLE, bb_pct_allowed DOUBLE, hr_per_bf_allowed DOUBLE, whip DOUBLE, pitches_per_batter_faced DOUBLE,
        strike_pct DOUBLE, batters_used INT, pitchers_used INT, bullpen_size INT, bench_size INT
    """,
    "batter_games": """
        game_pk STRING NOT NULL, team_id STRING NOT NULL, player_id STRING NOT NULL, season_year INT NOT NULL, game_date DATE NOT NULL,
        opponent_team_id STRING, home BOOLEAN, player_name STRING, position_code STRING, position_abbrev STRING, lineup_slot INT,
        substitution_index INT, is_starter BOOLEAN, had_plate_appearance BOOLEAN, plate_appearances INT, at_bats INT, runs INT, hits INT,
        singles INT, doubles INT, triples INT, home_runs INT, rbi INT, walks INT, intentional_walks INT, strikeouts INT, hit_by_pitch INT,
        sac_flies INT, sac_bunts INT, total_bases INT, stolen_bases INT, caught_stealing INT, grounded_into_double_play INT, left_on_base
        INT, ground_outs INT, air_outs INT
    """,
    "pitcher_appearances": """
        game_pk STRING NOT NULL, team_id STRING NOT NULL, player_id STRING NOT NULL, season_year INT NOT NULL, game_date DATE NOT NULL,
        first_pitch_utc TIMESTAMP, opponent_team_id STRING, home BOOLEAN, venue_id STRING, player_name STRING, is_starter BOOLEAN,
        appearance_number INT, outs_recorded INT, innings_pitched DOUBLE, batters_faced INT, pitches_thrown INT, strikes INT, balls INT,
        runs_allowed INT, earned_runs INT, hits_allowed INT, doubles_allowed INT, triples_allowed INT, home_runs_allowed INT,
        walks_allowed INT, intentional_walks_allowed INT, strikeouts INT, hit_batsmen INT, wild_pitches INT, balks INT, ground_outs INT,
        air_outs INT, fly_outs INT, line_outs INT, pop_outs INT, inherited_runners INT, inherited_runners_scored INT, wins INT, losses
        INT, saves INT, holds INT, blown_saves INT, complete_games INT, k_pct DOUBLE, bb_pct DOUBLE, hr_per_bf DOUBLE, whip DOUBLE,
        pitches_per_batter_faced DOUBLE, strike_pct DOUBLE, ground_out_air_out_ratio DOUBLE
    """,
    "umpires": """
        game_pk STRING NOT NULL, season_year INT NOT NULL, game_date DATE NOT NULL, official_id STRING NOT NULL, official_name STRING,
        official_type STRING NOT NULL, is_home_plate BOOLEAN NOT NULL
    """,
    "lineups": """
        game_pk STRING NOT NULL, season_year INT NOT NULL, game_date DATE NOT NULL, team_id STRING NOT NULL, home BOOLEAN, player_id
        STRING NOT NULL, player_name STRING, lineup_slot INT, position_code STRING, position_abbrev STRING
    """,
    "venues": """
        venue_id STRING NOT NULL, season INT NOT NULL, venue_name STRING, city STRING, state STRING, country STRING, latitude DOUBLE,
        longitude DOUBLE, elevation_ft DOUBLE, azimuth_angle DOUBLE, timezone_id STRING, timezone_offset INT, capacity INT, turf_type
        STRING, roof_type STRING, left_line INT, left INT, left_center INT, center INT, right_center INT, right INT, right_line INT,
        active BOOLEAN
    """,
    "transactions": """
        transaction_id STRING NOT NULL, player_id STRING, player_name STRING, season_year INT NOT NULL, known_date DATE NOT NULL,
        effective_date DATE, resolution_date DATE, is_backdated BOOLEAN, backdated_days INT, from_team_id STRING, to_team_id STRING,
        type_code STRING, type_desc STRING, description STRING, is_injury_related BOOLEAN
    """,
    "statcast_games": """
        game_pk STRING NOT NULL, season_year INT NOT NULL, game_date DATE NOT NULL, fetch_status STRING NOT NULL, pitch_rows INT NOT NULL,
        fetched_at_utc TIMESTAMP NOT NULL
    """,
    "statcast_pitches": """
        game_pk STRING NOT NULL, game_date DATE, game_year INT, game_type STRING, home_team STRING, away_team STRING, inning INT,
        inning_topbot STRING, at_bat_number INT NOT NULL, pitch_number INT NOT NULL, pitch_type STRING, pitch_name STRING, description
        STRING, events STRING, batter_id STRING, pitcher_id STRING, stand STRING, p_throws STRING, balls INT, strikes INT, outs_when_up
        INT, on_1b STRING, on_2b STRING, on_3b STRING, release_speed DOUBLE, effective_speed DOUBLE, release_spin_rate DOUBLE, spin_axis
        DOUBLE, release_extension DOUBLE, release_pos_x DOUBLE, release_pos_y DOUBLE, release_pos_z DOUBLE, pfx_x DOUBLE, pfx_z DOUBLE,
        plate_x DOUBLE, plate_z DOUBLE, zone INT, sz_top DOUBLE, sz_bot DOUBLE, launch_speed DOUBLE, launch_angle DOUBLE, hit_distance_sc
        DOUBLE, launch_speed_angle INT, bb_type STRING, estimated_ba_using_speedangle DOUBLE, estimated_slg_using_speedangle DOUBLE,
        estimated_woba_using_speedangle DOUBLE, woba_value DOUBLE, woba_denom DOUBLE, babip_value DOUBLE, iso_value DOUBLE, hc_x DOUBLE,
        hc_y DOUBLE, hit_location INT, if_fielding_alignment STRING, of_fielding_alignment STRING, home_score INT, away_score INT,
        bat_score INT, fld_score INT, post_home_score INT, post_away_score INT, delta_home_win_exp DOUBLE, delta_run_exp DOUBLE,
        n_thruorder_pitcher INT, n_priorpa_thisgame_player_at_bat INT, arm_angle DOUBLE, bat_speed DOUBLE, swing_length DOUBLE,
        season_year INT NOT NULL
    """,
    "odds_ticks": """
        game_pk STRING NOT NULL, season_year INT NOT NULL, game_date DATE, market STRING NOT NULL, book_slug STRING NOT NULL, line_ts
        TIMESTAMP NOT NULL, mins_to_tip INT NOT NULL, is_pregame BOOLEAN NOT NULL, is_opener BOOLEAN NOT NULL, left_line SMALLINT,
        left_price SMALLINT, right_line SMALLINT, right_price SMALLINT
    """,
    "odds_games": """
        game_pk STRING NOT NULL, event_id INT NOT NULL, game_date DATE NOT NULL, season_year INT NOT NULL, first_pitch_utc TIMESTAMP NOT
        NULL, team_home_id STRING, team_away_id STRING, team_home STRING, team_away STRING, starter_home STRING, starter_away STRING,
        is_doubleheader BOOLEAN NOT NULL, game_number INT NOT NULL, ingest_status STRING, source_tick_count INT, usable_tick_count INT,
        dropped_tick_count INT, fetched_at_utc TIMESTAMP
    """,
    "odds_fetches": """
        game_pk STRING NOT NULL, season_year INT NOT NULL, game_date DATE NOT NULL, event_id INT, ingest_status STRING NOT NULL,
        source_tick_count INT NOT NULL, usable_tick_count INT NOT NULL, dropped_tick_count INT NOT NULL, fetched_at_utc TIMESTAMP NOT NULL
    """,
}


@dataclass(frozen=True)
class TableSpec:
    """A table of the store: rows are unique by ``key``, files lie by ``partition``."""

    name: str
    key: tuple[str, ...]
    partition: str | None
    order: tuple[str, ...]
    game: str | None = "game_pk"
    ddl: str | None = None

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl or DDL[self.name])


def _spec(name: str, key: str, order: str, partition: str = "season_year", game: str | None = "game_pk") -> TableSpec:
    return TableSpec(name, tuple(key.split()), partition, tuple(order.split()), game)


TABLES = {
    s.name: s
    for s in (
        _spec("games", "game_pk", "game_date first_pitch_utc game_pk"),
        _spec("team_games", "game_pk team_id", "game_date game_pk team_id"),
        _spec("batter_games", "game_pk team_id player_id", "game_date game_pk team_id lineup_slot"),
        _spec("pitcher_appearances", "game_pk team_id player_id", "game_date game_pk team_id appearance_number"),
        _spec("umpires", "game_pk official_id official_type", "game_date game_pk official_type"),
        _spec("lineups", "game_pk team_id player_id", "game_date game_pk team_id lineup_slot"),
        _spec("venues", "venue_id season", "season venue_id", "season", None),
        _spec("transactions", "transaction_id", "known_date transaction_id", game=None),
        _spec("odds_games", "game_pk", "game_date first_pitch_utc game_pk"),
        _spec("odds_ticks", "game_pk market book_slug line_ts", "game_date game_pk market book_slug line_ts"),
        _spec("odds_fetches", "game_pk", "game_date game_pk"),
        _spec("statcast_games", "game_pk", "game_date game_pk"),
        _spec("statcast_pitches", "game_pk at_bat_number pitch_number", "game_date game_pk at_bat_number pitch_number"),
    )
}
#: The tables that a complete box score fills.
BOXSCORE_TABLES = ("team_games", "batter_games", "pitcher_appearances", "umpires")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``: missing ones NULL, others cast, extra ones dropped."""
    have = set(df.columns)
    return df.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))
