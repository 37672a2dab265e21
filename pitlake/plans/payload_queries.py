"""The parsers, over payloads in the providers' shapes made of the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources import boxscores, quotes, schedules
from . import pages
from .quotes import odds_tables
from .registry import query

c = F.col


def key() -> Column:
    return c("o_orderkey")

_TEAM = ("111", "147", "119", "112")
_NAME = ("Boston Red Sox", "New York Yankees", "Los Angeles Dodgers", "Chicago Cubs")


def _json(*columns: Column) -> Column:
    return F.to_json(F.struct(*columns))


def _pick(values: tuple[str, ...], n: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), n.cast("int"))


# -- schedules --------------------------------------------------------------------------


def _side(n: Column, score: Column) -> Column:
    return F.struct(F.struct(_pick(_TEAM, n).alias("id"), _pick(_NAME, n).alias("name")).alias("team"), score.alias("score"))


def _schedule(orders: DataFrame) -> DataFrame:
    """One payload an order; every tenth game is listed twice, first unfinished; every twelfth is of a type that is not ingested."""
    final = c("o_orderstatus") == "F"
    player = lambda n: F.struct(n.alias("id"), F.concat(F.lit("player "), n.cast("string")).alias("fullName"), F.struct(F.lit("2").alias("code"), F.lit("C").alias("abbreviation")).alias("primaryPosition"))

    def listing(state: Column, home_runs: Column) -> Column:
        return F.struct(
            key().alias("gamePk"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("officialDate"), F.date_format("o_orderdate", "yyyy-MM-dd'T'17:05:00'Z'").alias("gameDate"),
            F.when(key() % 12 == 0, "S").when(key() % 12 == 1, "W").otherwise("R").alias("gameType"), (key() % 2).alias("gameNumber"), F.lit("N").alias("doubleHeader"),
            F.struct(state.alias("abstractGameState")).alias("status"), F.struct((key() % 40).alias("id")).alias("venue"),
            F.struct(_side(key() % 2, home_runs), _side(key() % 2 + 2, c("o_custkey") % 9)).alias("both"),
            F.struct((key() % 4 + 8).alias("currentInning")).alias("linescore"),
            F.array(F.struct(F.struct((key() % 50).alias("id"), F.lit("u").alias("fullName")).alias("official"), F.lit("Home Plate").alias("officialType")),
                    F.struct(F.struct((key() % 50 + 50).alias("id"), F.lit("v").alias("fullName")).alias("official"), F.lit("First Base").alias("officialType"))).alias("officials"),
            F.struct(F.array(player(key() % 7), player(key() % 7 + 1), player(key() % 7)).alias("homePlayers"), F.array(player(key() % 5 + 20)).alias("awayPlayers")).alias("lineups"),
        )

    done = F.when(final, "Final").otherwise("Live")
    first, last = listing(F.when(key() % 10 == 0, "Preview").otherwise(done), F.lit(99)), listing(done, key() % 12)
    listed = F.when(key() % 10 == 0, F.array(first, last)).otherwise(F.array(last))
    text = F.to_json(F.struct(F.array(F.struct(listed.alias("games"))).alias("dates")))
    # a struct of two unnamed sides becomes the provider's home and away
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, '"both":', '"teams":'), '"col1":', '"home":'), '"col2":', '"away":')
    return orders.select(text.alias("payload"))


_LISTED = """s AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS game_pk, CAST(year(o_orderdate) AS INTEGER) AS season_year, CAST(o_orderdate AS DATE) AS game_date, o_orderstatus = 'F' AS is_final, o_orderkey % 12 AS home, o_custkey % 9 AS away,
    ['111', '147', '119', '112'] AS teams FROM orders WHERE o_orderkey % 12 <> 0)"""


@query(
    f"""WITH {_LISTED} SELECT game_pk, season_year, game_date, CASE WHEN k % 12 = 1 THEN 'World Series' ELSE 'Regular Season' END AS season_type, 1 AS game_number, is_final,
        CAST(CASE WHEN NOT is_final AND k % 10 = 0 THEN 99 ELSE home END AS INTEGER) AS home_score, CAST(away AS INTEGER) AS away_score,
        CAST(CASE WHEN NOT is_final AND k % 10 = 0 THEN 99 ELSE home END + away AS INTEGER) AS total_runs, CAST(k % 4 + 8 AS INTEGER) AS innings_played, k % 4 + 8 > 9 AS extra_innings,
        teams[k % 2 + 1] AS home_team_id, teams[k % 2 + 3] AS away_team_id FROM s""",
    "orders",
)
def schedule_games(orders: DataFrame) -> DataFrame:
    """The best listing of each game: a finished one first, then the first listed."""
    names = ("game_pk", "season_year", "game_date", "season_type", "game_number", "is_final", "home_score", "away_score", "total_runs", "innings_played", "extra_innings", "home_team_id", "away_team_id")
    return schedules.games(_schedule(orders)).select(*names)


@query(
    f"""WITH {_LISTED} SELECT game_pk, season_year, CAST(k % 50 AS VARCHAR) AS official_id, 'Home Plate' AS official_type, true AS is_home_plate FROM s
        UNION ALL SELECT game_pk, season_year, CAST(k % 50 + 50 AS VARCHAR), 'First Base', false FROM s""",
    "orders",
)
def schedule_umpires(orders: DataFrame) -> DataFrame:
    return schedules.umpires(_schedule(orders)).select("game_pk", "season_year", "official_id", "official_type", "is_home_plate")


@query(
    f"""WITH {_LISTED} SELECT game_pk, teams[k % 2 + 1] AS team_id, true AS home, CAST(k % 7 AS VARCHAR) AS player_id, 1 AS lineup_slot FROM s
        UNION ALL SELECT game_pk, teams[k % 2 + 1], true, CAST(k % 7 + 1 AS VARCHAR), 2 FROM s UNION ALL SELECT game_pk, teams[k % 2 + 3], false, CAST(k % 5 + 20 AS VARCHAR), 1 FROM s""",
    "orders",
)
def schedule_lineups(orders: DataFrame) -> DataFrame:
    """A player listed twice has the lower slot."""
    return schedules.lineups(_schedule(orders)).select("game_pk", "team_id", "home", "player_id", "lineup_slot")


@query(f"WITH {_LISTED} SELECT game_pk, CAST(2 AS BIGINT) AS n FROM s WHERE k % 10 = 0", "orders")
def schedule_repeats(orders: DataFrame) -> DataFrame:
    return schedules.repeated_listings(_schedule(orders)).select("game_pk", "n")


@query(
    """SELECT CAST(s_suppkey AS VARCHAR) AS venue_id, 2025 AS season, s_name AS venue_name, CAST(s_nationkey + 0.5 AS DOUBLE) AS latitude, CAST(300 + s_suppkey % 50 AS INTEGER) AS left_line,
              CAST(CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 40000 END AS INTEGER) AS capacity FROM supplier""",
    "supplier",
)
def venues(supplier: DataFrame) -> DataFrame:
    place = F.struct(F.struct((c("s_nationkey") + F.lit(0.5)).alias("latitude")).alias("defaultCoordinates"))
    field = F.struct((c("s_suppkey") % 50 + 300).alias("leftLine"), F.when(c("s_suppkey") % 3 != 0, 40000).alias("capacity"))
    one = F.struct(c("s_suppkey").alias("id"), c("s_name").alias("name"), place.alias("location"), field.alias("fieldInfo"))
    return schedules.venues(supplier.select(_json(F.array(one).alias("venues")).alias("payload")), 2025).select("venue_id", "season", "venue_name", "latitude", "left_line", "capacity")


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_orderdate AS DATE) AS known_date, CAST(year(o_orderdate) AS INTEGER) AS season_year, CAST(o_orderkey % 5 - 2 AS INTEGER) AS backdated_days,
              o_orderkey % 5 > 2 AS is_backdated, o_orderkey % 4 = 0 AS is_injury_related FROM orders WHERE o_orderkey % 6 <> 0""",
    "orders",
)
def transactions(orders: DataFrame) -> DataFrame:
    """Moves without a date of announcement are dropped."""
    day = lambda x: F.date_format(x, "yyyy-MM-dd")
    effective = F.date_add(F.to_date("o_orderdate"), (F.lit(2) - key() % 5).cast("int"))
    move = F.struct(
        key().alias("id"), F.when(key() % 6 != 0, day("o_orderdate")).alias("date"), day(effective).alias("effectiveDate"),
        F.when(key() % 4 == 0, "placed on the Injured List").otherwise("optioned").alias("description"),
    )
    df = schedules.transactions(orders.select(_json(F.array(move).alias("transactions")).alias("payload")))
    return df.select("transaction_id", "known_date", "season_year", "backdated_days", "is_backdated", "is_injury_related")


# -- box scores -------------------------------------------------------------------------


def _box(orders: DataFrame) -> DataFrame:
    def player(n: Column, order: Column, batting: Column, pitching: Column) -> Column:
        return F.struct(F.struct(n.alias("id"), F.lit("p").alias("fullName")).alias("person"), order.alias("battingOrder"), F.struct(batting.alias("batting"), pitching.alias("pitching")).alias("stats"))

    none = F.create_map().cast("map<string,string>")
    stats = lambda **values: F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*(x.cast("string") for x in values.values())))

    def side(team: Column, runs: Column, allowed: Column, first: Column) -> Column:
        pitching = stats(runs=allowed, hits=key() % 9, baseOnBalls=key() % 4, hitBatsmen=key() % 2, outs=F.lit(0), inningsPitched=F.concat((key() % 3 + 7).cast("string"), F.lit("."), (key() % 3).cast("string")), battersFaced=key() % 20 + 20)
        batting = stats(runs=runs, hits=key() % 10 + 3, doubles=key() % 3, triples=key() % 2, homeRuns=F.lit(1), atBats=key() % 8 + 30, plateAppearances=key() % 8 + 34, baseOnBalls=key() % 4, hitByPitch=key() % 2, sacFlies=F.lit(1), totalBases=key() % 10 + 9, strikeOuts=key() % 7)
        hitter = player(first, F.lit("100"), stats(hits=key() % 4, atBats=F.lit(4), plateAppearances=key() % 3), none)
        bench = player(first + 1, F.lit("101"), stats(hits=F.lit(0), plateAppearances=F.lit(0)), none)
        arm = player(first + 2, F.lit(None).cast("string"), none, stats(outs=key() % 10 + 12, gamesStarted=F.lit(1), baseOnBalls=key() % 4, hits=key() % 9, pitchesThrown=F.lit(0), numberOfPitches=key() % 30 + 60, strikes=key() % 20 + 30))
        listed = F.map_from_arrays(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.array(hitter, bench, arm))
        return F.struct(
            F.struct(team.alias("id")).alias("team"), F.struct(batting.alias("batting"), pitching.alias("pitching"), stats(errors=key() % 3).alias("fielding")).alias("teamStats"),
            listed.alias("players"), F.array(first, first + 1).alias("batters"), F.array(first + 9, first + 2).alias("pitchers"),
        )

    home, away = key() % 12, c("o_custkey") % 11
    teams = F.struct(side(F.lit(1), home, away, F.lit(100)).alias("home"), side(F.lit(2), away, home, F.lit(200)).alias("away"))
    officials = F.array(F.struct(F.struct((key() % 50).alias("id"), F.lit("u").alias("fullName")).alias("official"), F.when(key() % 2 == 0, "Home Plate").otherwise("First Base").alias("officialType")))
    return orders.select(
        key().cast("string").alias("game_pk"), F.year("o_orderdate").alias("season_year"), F.to_date("o_orderdate").alias("game_date"), c("o_orderdate").alias("first_pitch_utc"),
        F.lit("R").alias("game_type"), F.lit("9").alias("venue_id"), _json(teams.alias("teams"), officials.alias("officials")).alias("payload"),
    )


_BOX = """b AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS game_pk, side, CAST(side + 1 AS VARCHAR) AS team_id, CASE side WHEN 0 THEN o_orderkey % 12 ELSE o_custkey % 11 END AS runs, CASE side WHEN 0 THEN o_custkey % 11 ELSE o_orderkey % 12 END AS allowed
    FROM orders, (SELECT unnest([0, 1]) AS side)),
    t AS (SELECT *, 3 * (k % 3 + 7) + k % 3 AS outs, k % 10 + 3 AS h, k % 8 + 30 AS ab FROM b)"""


@query(
    f"""WITH {_BOX} SELECT game_pk, team_id, side = 0 AS home, CAST(runs AS INTEGER) AS runs_scored, CAST(allowed AS INTEGER) AS runs_allowed, CAST(runs - allowed AS INTEGER) AS run_margin, runs > allowed AS win, CAST(outs AS INTEGER) AS outs_recorded,
        CAST(h - k % 3 - k % 2 - 1 AS INTEGER) AS singles, CAST(k % 9 + k % 4 + k % 2 AS INTEGER) AS baserunners_allowed, round_even((h + k % 4 + k % 2) / (ab + k % 4 + k % 2 + 1), 6) AS obp, round_even((k % 10 + 9) / ab, 6) AS slg,
        round_even((h - 1) / (ab - k % 7 - 1 + 1), 6) AS babip, round_even(outs / 3, 6) AS innings_pitched, round_even((k % 4 + k % 9) / round_even(outs / 3, 6), 6) AS whip, CAST(k % 3 AS INTEGER) AS errors, CAST(NULL AS INTEGER) AS inherited_runners, 2 AS pitchers_used FROM t""",
    "orders",
)
def box_teams(orders: DataFrame) -> DataFrame:
    names = ("game_pk", "team_id", "home", "runs_scored", "runs_allowed", "run_margin", "win", "outs_recorded", "singles", "baserunners_allowed", "obp", "slg", "babip", "innings_pitched", "whip", "errors", "inherited_runners", "pitchers_used")
    return boxscores.team_games(_box(orders)).select(*names)


@query(
    f"""WITH {_BOX} SELECT game_pk, team_id, CAST((side + 1) * 100 AS VARCHAR) AS player_id, 1 AS lineup_slot, 0 AS substitution_index, true AS is_starter, k % 3 > 0 AS had_plate_appearance, CAST(k % 4 AS INTEGER) AS hits, 4 AS at_bats FROM b
        UNION ALL SELECT game_pk, team_id, CAST((side + 1) * 100 + 1 AS VARCHAR), 1, 1, false, false, 0, 0 FROM b""",
    "orders",
)
def box_batters(orders: DataFrame) -> DataFrame:
    """Players with an empty map of batting statistics are not batters; a missing statistic is 0."""
    return boxscores.batter_games(_box(orders)).select("game_pk", "team_id", "player_id", "lineup_slot", "substitution_index", "is_starter", "had_plate_appearance", "hits", "at_bats")


@query(
    f"""WITH {_BOX} SELECT game_pk, team_id, CAST((side + 1) * 100 + 2 AS VARCHAR) AS player_id, true AS is_starter, 2 AS appearance_number, CAST(k % 10 + 12 AS INTEGER) AS outs_recorded, CAST(k % 30 + 60 AS INTEGER) AS pitches_thrown,
        round_even((k % 20 + 30) / (k % 30 + 60), 6) AS strike_pct, round_even((k % 4 + k % 9) / round_even((k % 10 + 12) / 3, 6), 6) AS whip, CAST(NULL AS DOUBLE) AS k_pct FROM b""",
    "orders",
)
def box_pitchers(orders: DataFrame) -> DataFrame:
    """Pitches fall back to the other count where the first is 0; rates without a denominator are NULL."""
    return boxscores.pitcher_appearances(_box(orders)).select("game_pk", "team_id", "player_id", "is_starter", "appearance_number", "outs_recorded", "pitches_thrown", "strike_pct", "whip", "k_pct")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS game_pk, CAST(o_orderkey % 50 AS VARCHAR) AS official_id, CASE WHEN o_orderkey % 2 = 0 THEN 'Home Plate' ELSE 'First Base' END AS official_type, o_orderkey % 2 = 0 AS is_home_plate FROM orders", "orders")
def box_officials(orders: DataFrame) -> DataFrame:
    return boxscores.officials(_box(orders)).select("game_pk", "official_id", "official_type", "is_home_plate")


# -- line histories ---------------------------------------------------------------------


def _pages(events: DataFrame) -> DataFrame:
    """One page a user: a game of 6 p.m., the user's events as total quotes of a book a kind of event; every eleventh page has no id, every thirteenth no JSON."""
    user = c("user_id")
    quote = F.struct(
        "ts", "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("oddsDate"), F.when(c("event_id") % 5 != 0, F.floor("value") % 30).alias("total"),
        (-110 - F.floor("value") % 50).alias("overOdds"), F.lit("100").alias("underOdds"),
    )
    views = events.groupBy("user_id", "event_type").agg(F.array_sort(F.collect_list(quote)).alias("totalHistory"))
    views = views.groupBy("user_id").agg(F.collect_list(F.struct(F.concat(F.lit("m_"), "event_type").alias("sportsbook"), "totalHistory")).alias("views"))
    view = F.struct(
        F.when(user % 11 != 0, user).alias("gameId"), F.lit("2024-01-15T23:00:00+00:00").alias("startDate"),
        F.struct(_pick(_NAME, user % 2).alias("fullName")).alias("homeTeam"), F.struct(_pick(_NAME, user % 2 + 2).alias("name")).alias("awayTeam"),
    )
    books = F.array(F.struct(F.lit("m_view").alias("machineName"), F.lit("The View! Book").alias("name")))
    model = F.struct(books.alias("sportsbooks"), F.struct(view.alias("gameView"), c("views").alias("oddsViews")).alias("lineHistory"))
    text = _json(F.struct(F.struct(model.alias("lineHistoryModel")).alias("pageProps")).alias("props"))
    page = F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">'), text, F.lit("</script></html>"))
    return views.select("user_id", F.when(user % 13 == 0, "<html></html>").otherwise(page).alias("html"))


def _scraped(events: DataFrame) -> DataFrame:
    return quotes.scraped_games(_pages(events).select("user_id", quotes.page_json("html").alias("payload")))


@query(
    """SELECT user_id, CASE WHEN user_id % 13 = 0 THEN 'no_json' WHEN user_id % 11 = 0 THEN 'no_game_id' END AS reason, CASE WHEN user_id % 13 > 0 AND user_id % 11 > 0 THEN CAST(user_id AS INTEGER) END AS event_id,
              CASE WHEN user_id % 13 > 0 THEN DATE '2024-01-15' END AS game_date, CASE WHEN user_id % 13 > 0 THEN CASE user_id % 2 WHEN 0 THEN 'Boston Red Sox' ELSE 'New York Yankees' END END AS team_home
       FROM (SELECT DISTINCT user_id FROM events)""",
    "events",
)
def line_pages(events: DataFrame) -> DataFrame:
    """The JSON that pages embed, and what a page that cannot be read lacks."""
    return _scraped(events).select("user_id", "reason", "event_id", "game_date", "team_home")


_QUOTES = """q AS (SELECT *, date_trunc('minute', ts) AS minute, CASE WHEN event_type = 'view' THEN 'the_view_book' ELSE 'm_' || event_type END AS book_slug FROM events WHERE user_id % 13 > 0 AND user_id % 11 > 0),
    k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, minute ORDER BY ts DESC, event_id DESC) AS r FROM q) WHERE r = 1),
    f AS (SELECT CAST(user_id AS INTEGER) AS event_id, book_slug, CAST(epoch(minute) AS BIGINT) AS at_second, CAST(CASE WHEN event_id % 5 <> 0 THEN floor(value) % 30 END AS DOUBLE) AS line, CAST(-110 - floor(value) % 50 AS INTEGER) AS price,
                 CAST((epoch(minute) - epoch(TIMESTAMP '2024-01-15 23:00:00')) // 60 AS INTEGER) AS minutes, row_number() OVER (PARTITION BY user_id, book_slug ORDER BY minute) = 1 AS is_opener FROM k)"""


@query(f"WITH {_QUOTES} SELECT * FROM f", "events")
def line_ticks(events: DataFrame) -> DataFrame:
    """The last quote of a minute in each view, with one opener a book."""
    df = quotes.ticks(_scraped(events))
    return df.select("event_id", "book_slug", F.unix_timestamp("line_ts").alias("at_second"), c("left_line").alias("line"), c("left_price").alias("price"), c("minutes_to_tip").alias("minutes"), "is_opener")


def _odds(events: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The listed games of the pages' teams: one of each pair, at the pages' own start."""
    scraped = _scraped(events).where("reason is null")
    games = events.select("user_id").distinct().where("user_id < 2").select(
        c("user_id").cast("string").alias("game_pk"), F.lit("2024-01-15").cast("date").alias("game_date"), _pick(_TEAM, c("user_id") % 2).alias("home_team_id"), _pick(_TEAM, c("user_id") % 2 + 2).alias("away_team_id"),
        F.lit("2024-01-15 23:00:00").cast("timestamp").alias("first_pitch_utc"), F.lit(1).alias("game_number"),
    )
    return odds_tables(scraped, quotes.ticks(scraped), games)


_ACCOUNT = f"""WITH {_QUOTES}, u AS (SELECT *, CASE WHEN minutes < 0 AND (line < 3 OR line > 25) THEN 'line_out_of_bounds_cleared' END AS repair FROM f WHERE event_id % 2 IN (SELECT DISTINCT user_id FROM events WHERE user_id < 2))"""


@query(
    _ACCOUNT + " SELECT event_id, CAST(count(*) AS INTEGER) AS source_tick_count, CAST(count(*) AS INTEGER) AS usable_tick_count, 'complete' AS ingest_status FROM u GROUP BY 1", "events"
)
def odds_dimension(events: DataFrame) -> DataFrame:
    return _odds(events)[1].select("event_id", "source_tick_count", "usable_tick_count", "ingest_status")


@query(_ACCOUNT + " SELECT event_id, book_slug, at_second, repair AS repair_reason, CAST(NULL AS VARCHAR) AS drop_reason FROM u", "events")
def odds_account(events: DataFrame) -> DataFrame:
    """Every tick with why it was repaired or dropped."""
    return _odds(events)[2].select("event_id", "book_slug", F.unix_timestamp("line_ts").alias("at_second"), "repair_reason", "drop_reason")


@query(
    """WITH r AS (SELECT user_id AS event_id, min(event_id) AS first FROM events GROUP BY 1) SELECT CAST(event_id AS INTEGER) AS event_id, DATE '2024-01-14' AS game_date, CASE event_id % 2 WHEN 0 THEN 'Boston Red Sox' ELSE 'New York Yankees' END AS team_home FROM r WHERE event_id % 7 > 0""",
    "events",
)
def slate_games(events: DataFrame) -> DataFrame:
    """The games of a day page: the first listing of each, those without an offset in their start left out."""
    user = c("user_id")
    view = lambda start: F.struct(F.struct(user.alias("gameId"), start.alias("startDate"), F.struct(_pick(_NAME, user % 2).alias("fullName")).alias("homeTeam")).alias("gameView"))
    first = view(F.when(user % 7 == 0, "2024-01-15T03:00:00").otherwise("2024-01-15T03:00:00Z"))
    again = view(F.when(user % 7 == 0, None).otherwise("2024-01-18T03:00:00Z"))
    model = F.struct(F.array(F.struct(F.struct(F.array(first, again).alias("gameRows")).alias("oddsTableModel"))).alias("oddsTables"))
    days = events.select("user_id").distinct().select(_json(F.struct(model.alias("pageProps")).alias("props")).alias("payload"), user.cast("string").alias("ordinal"))
    return quotes.slate(days).select("event_id", "game_date", "team_home")


@query(
    """WITH k AS (SELECT o_orderkey, o_orderkey // 500 AS page FROM orders)
       SELECT page, CASE WHEN page % 7 = 3 THEN 'not_found' WHEN page % 7 = 5 THEN 'no_json' END AS reason,
              CASE WHEN page % 7 IN (3, 5) THEN 0 ELSE count(DISTINCT o_orderkey) END AS n_games,
              CAST(CASE WHEN page % 7 NOT IN (3, 5) THEN min(o_orderkey) END AS INTEGER) AS first_event, CAST(CASE WHEN page % 7 NOT IN (3, 5) THEN max(o_orderkey) END AS INTEGER) AS last_event
       FROM k GROUP BY page""",
    "orders",
)
def paged_slates(orders: DataFrame) -> DataFrame:
    """Listing pages of 500 ids each, landed but for every seventh, and fetched by key: the games found, or why there are none."""
    page = F.floor(key() / 500)
    view = F.struct(F.struct(key().alias("gameId"), F.lit("2024-01-15T03:00:00Z").alias("startDate")).alias("gameView"))
    rows = orders.select(page.alias("page"), view.alias("row")).groupBy("page").agg(F.collect_list("row").alias("gameRows"))  # 500 ids at most
    model = F.struct(F.array(F.struct(F.struct("gameRows").alias("oddsTableModel"))).alias("oddsTables"))
    text = F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">'), _json(F.struct(model.alias("pageProps")).alias("props")), F.lit("</script></html>"))
    land = rows.select(c("page").alias("key"), F.when(c("page") % 7 == 5, "<html></html>").otherwise(text).alias("value")).where(c("key") % 7 != 3)
    root = scratch_dir(orders.sparkSession)
    land.repartition("key").write.partitionBy("key").text(root)
    wanted = orders.select(page.alias("page")).distinct()
    listed, got = pages.discover_days(wanted, pages.Partitions(pages.qualified(orders.sparkSession, root)), "page")
    found = listed.select(F.floor(c("event_id") / 500).alias("page"), "event_id").groupBy("page").agg(F.count("*").alias("n_games"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"))
    return got.select(c("key").cast("bigint").alias("page"), "reason").join(found, "page", "left").na.fill(0, ["n_games"])


@query(
    """WITH p AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_suppkey % 3 ORDER BY l_partkey DESC, l_suppkey DESC, l_shipdate DESC) AS r FROM lineitem WHERE l_linenumber <> 4)
       SELECT CAST(l_orderkey AS VARCHAR) AS game_pk, l_linenumber AS at_bat_number, CAST(l_suppkey % 3 AS INTEGER) AS pitch_number, CAST(l_partkey AS VARCHAR) AS batter_id, CAST(l_shipdate AS DATE) AS game_date,
              CASE WHEN l_partkey % 2 = 0 THEN l_quantity END AS release_speed, CASE WHEN l_partkey % 3 = 0 THEN CAST(l_partkey AS VARCHAR) END AS on_1b, 2025 AS season_year FROM p WHERE r = 1""",
    "lineitem",
)
def pitches(lineitem: DataFrame) -> DataFrame:
    """Raw pitch rows, all text: typed, renamed, those without a number left out, the last of equal keys."""
    text = lambda x: x.cast("string")
    raw = lineitem.select(
        text(c("l_orderkey").cast("double")).alias("game_pk"), F.when(c("l_linenumber") != 4, text(c("l_linenumber"))).alias("at_bat_number"), text(c("l_suppkey") % 3).alias("pitch_number"),
        F.concat(text(c("l_partkey")), F.lit(".0")).alias("batter"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("game_date"), F.when(c("l_partkey") % 2 == 0, text(c("l_quantity"))).alias("release_speed"),
        F.when(c("l_partkey") % 3 == 0, F.concat(text(c("l_partkey")), F.lit(".0"))).alias("on_1b"), F.struct("l_partkey", "l_suppkey", "l_shipdate").alias("__ordinal"),
    )
    return quotes.pitches(raw, 2025).select("game_pk", "at_bat_number", "pitch_number", "batter_id", "game_date", "release_speed", "on_1b", "season_year")
