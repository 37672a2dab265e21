"""The domain's plans over games, box scores and quotes made of the driver's tables.

``orders`` are games, ``lineitem`` pitches and batters, ``events`` quotes; the SQL
makes the same tables and says each plan again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import keep_last
from . import features, mirror, outcomes, planner, snapshots
from .quotes import changed_openers, match_rate, repair_openers, resolve_events
from .registry import query
from .validation import checks, compare_counts, validate

c = F.col


def key() -> Column:
    return c("o_orderkey")



def _str(x: Column) -> Column:
    return x.cast("string")


def _games(orders: DataFrame) -> DataFrame:
    home, away = (key() % 12).cast("int"), (c("o_custkey") % 11).cast("int")
    return orders.select(
        _str(key()).alias("game_pk"), F.year("o_orderdate").alias("season_year"), F.to_date("o_orderdate").alias("game_date"), c("o_orderdate").alias("first_pitch_utc"),
        (c("o_orderstatus") == "F").alias("is_final"), _str(c("o_custkey") % 30).alias("home_team_id"), _str(key() * 7 % 30).alias("away_team_id"),
        home.alias("home_score"), away.alias("away_score"), F.when(key() % 97 != 0, home + away + F.when(key() % 101 == 0, 1).otherwise(0)).alias("total_runs"),
        (home - away).alias("run_line_margin"), (key() % 9 + 4).cast("int").alias("innings_played"),
    )


_G = """g AS (SELECT CAST(o_orderkey AS VARCHAR) AS game_pk, o_orderkey AS k, CAST(year(o_orderdate) AS INTEGER) AS season_year, CAST(o_orderdate AS DATE) AS game_date, o_orderstatus = 'F' AS is_final,
    o_custkey % 30 AS home_team, o_orderkey * 7 % 30 AS away_team, o_orderkey % 12 AS home_score, o_custkey % 11 AS away_score,
    CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey % 12 + o_custkey % 11 + CASE WHEN o_orderkey % 101 = 0 THEN 1 ELSE 0 END END AS total_runs,
    o_orderkey % 12 - o_custkey % 11 AS margin, o_orderkey % 9 + 4 AS innings FROM orders)"""


# -- the 26 checks ----------------------------------------------------------------------


def _store(orders: DataFrame, lineitem: DataFrame, events: DataFrame) -> dict[str, DataFrame]:
    games = _games(orders)
    k = c("game_pk").cast("long")
    side = lambda home: F.struct(
        F.lit(home).alias("home"), c("home_team_id" if home else "away_team_id").alias("team_id"), c("away_team_id" if home else "home_team_id").alias("opponent_team_id"),
        ((c("home_score") + F.when(k % 13 == 0, 1).otherwise(0)) if home else c("away_score")).alias("runs_scored"), c("away_score" if home else "home_score").alias("runs_allowed"),
        (3 * c("innings_played") - ((k % 5).cast("int") if home else F.lit(0))).alias("outs_recorded"),
    )
    teams = games.where(c("home_team_id") != c("away_team_id")).select("game_pk", F.explode(F.array(side(True), side(False))).alias("s")).select("game_pk", "s.*").where(c("home") | (k % 17 != 0))
    arms = teams.select("game_pk", "team_id", F.explode(F.array(
        F.struct(F.lit(True).alias("is_starter"), (c("outs_recorded") - 3 + F.when(k % 19 == 0, 1).otherwise(0)).alias("outs_recorded")),
        F.struct((k % 23 == 0).alias("is_starter"), F.lit(3).alias("outs_recorded")),
    )).alias("a")).select("game_pk", "team_id", "a.*")
    game = _str(c("l_orderkey")).alias("game_pk")
    batters = lineitem.select(
        game, c("l_linestatus").alias("team_id"), (c("l_linenumber") < 9).alias("is_starter"), (c("l_suppkey") % 5).alias("at_bats"), (c("l_partkey") % 5).alias("hits"),
        (c("l_partkey") % 2).alias("doubles"), (c("l_partkey") % 3).alias("triples"), F.lit(0).alias("home_runs"),
    )
    return {
        "games": games.unionByName(games.where(k % 41 == 0)), "team_games": teams, "pitcher_appearances": arms, "batter_games": batters,
        "umpires": games.select("game_pk", (k % 29 != 0).alias("is_home_plate")),
        "odds_ticks": events.select(_str(c("user_id")).alias("game_pk"), c("event_type").alias("market"), _str(c("event_id") % 3).alias("book_slug"), (c("event_id") % 7 == 0).alias("is_opener")),
        "statcast_pitches": lineitem.select(_str(c("l_orderkey") + F.when(c("l_orderkey") % 31 == 0, 10**9).otherwise(0)).alias("game_pk"), c("l_linenumber").alias("at_bat_number"), (c("l_suppkey") % 3).alias("pitch_number")),
        "statcast_games": games.select("game_pk", F.when(c("is_final"), "complete").otherwise("no_data").alias("fetch_status"), (k % 6).cast("int").alias("pitch_rows")),
    }


_FOUND = {
    ("duplicate_game_pk", "games"): "SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM gg GROUP BY game_pk)",
    ("implausible_runs", "games"): "SELECT count(*) FROM gg WHERE home_score > 40 OR away_score > 40 OR home_score < 0 OR away_score < 0",
    ("final_without_score", "games"): "SELECT count(*) FROM gg WHERE is_final AND total_runs IS NULL",
    ("total_runs_mismatch", "games"): "SELECT count(*) FROM gg WHERE total_runs <> home_score + away_score",
    ("short_game", "games"): "SELECT count(*) FROM gg WHERE innings < 5",
    ("same_team_both_sides", "games"): "SELECT count(*) FROM gg WHERE home_team = away_team",
    ("wrong_row_count", "team_games"): "SELECT count(*) FROM (SELECT game_pk FROM tg GROUP BY 1 HAVING count(*) <> 2)",
    ("implausible_runs", "team_games"): "SELECT count(*) FROM tg WHERE scored > 40 OR allowed > 40",
    ("implausible_outs", "team_games"): "SELECT count(*) FROM tg WHERE outs < 12 OR outs > 120",
    ("self_opponent", "team_games"): "SELECT count(*) FROM tg WHERE team = opponent",
    ("outs_inconsistent_with_innings", "team_games"): "SELECT count(*) FROM tg JOIN gg USING (game_pk) WHERE outs < 3 * (innings - 1) OR outs > 3 * innings",
    ("runs_not_reciprocal", "team_games"): "SELECT count(*) FROM tg a JOIN tg b ON a.game_pk = b.game_pk AND a.team = b.opponent WHERE a.scored <> b.allowed",
    ("runs_disagree_with_games", "team_games"): "SELECT count(*) FROM tg JOIN gg USING (game_pk) WHERE scored <> CASE WHEN home THEN home_score ELSE away_score END",
    ("orphan_game_pk", "team_games"): "SELECT count(*) FROM tg WHERE game_pk NOT IN (SELECT game_pk FROM gg)",
    ("wrong_starter_count", "pitcher_appearances"): "SELECT count(*) FROM (SELECT game_pk, team FROM pa WHERE starter GROUP BY 1, 2 HAVING count(*) <> 1)",
    ("implausible_outs", "pitcher_appearances"): "SELECT count(*) FROM pa WHERE outs > 120",
    ("outs_disagree_with_team_game", "pitcher_appearances"): "SELECT count(*) FROM (SELECT game_pk, team, sum(outs) AS total FROM pa GROUP BY 1, 2) JOIN tg USING (game_pk, team) WHERE outs <> total",
    ("wrong_starting_lineup_size", "batter_games"): "SELECT count(*) FROM (SELECT l_orderkey, l_linestatus FROM lineitem WHERE l_linenumber < 9 GROUP BY 1, 2 HAVING count(*) NOT IN (9, 10))",
    ("hits_exceed_at_bats", "batter_games"): "SELECT count(*) FROM lineitem WHERE l_partkey % 5 > l_suppkey % 5",
    ("extra_base_hits_exceed_hits", "batter_games"): "SELECT count(*) FROM lineitem WHERE l_partkey % 2 + l_partkey % 3 > l_partkey % 5",
    ("missing_home_plate_umpire", "umpires"): "SELECT count(*) FROM gg WHERE k % 29 = 0",
    ("multiple_openers", "odds_ticks"): "SELECT count(*) FROM (SELECT 1 FROM events GROUP BY user_id, event_type, event_id % 3 HAVING count(*) FILTER (event_id % 7 = 0) > 1)",
    ("missing_opener", "odds_ticks"): "SELECT count(*) FROM (SELECT 1 FROM events GROUP BY user_id, event_type, event_id % 3 HAVING count(*) FILTER (event_id % 7 = 0) = 0)",
    ("duplicate_pitch_key", "statcast_pitches"): "SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber, l_suppkey % 3 HAVING count(*) > 1)",
    ("orphan_game_pk", "statcast_pitches"): "SELECT count(*) FROM lineitem WHERE l_orderkey % 31 = 0 OR l_orderkey NOT IN (SELECT k FROM g)",
    ("pitch_row_count_mismatch", "statcast_games"): "SELECT count(*) FROM g LEFT JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_orderkey % 31 <> 0 GROUP BY 1) p USING (k) WHERE is_final AND k % 6 <> coalesce(n, 0)",
}
_CHECKS = f"""WITH {_G}, gg AS (SELECT * FROM g UNION ALL SELECT * FROM g WHERE k % 41 = 0), diff AS (SELECT * FROM g WHERE home_team <> away_team),
    tg AS (SELECT game_pk, k, true AS home, home_team AS team, away_team AS opponent, home_score + CASE WHEN k % 13 = 0 THEN 1 ELSE 0 END AS scored, away_score AS allowed, 3 * innings - k % 5 AS outs FROM diff
           UNION ALL SELECT game_pk, k, false, away_team, home_team, away_score, home_score, 3 * innings FROM diff WHERE k % 17 <> 0),
    pa AS (SELECT game_pk, team, true AS starter, outs - 3 + CASE WHEN k % 19 = 0 THEN 1 ELSE 0 END AS outs FROM tg UNION ALL SELECT game_pk, team, k % 23 = 0, 3 FROM tg)"""


@query(
    _CHECKS + " SELECT * FROM (" + " UNION ALL ".join(f"""SELECT '{n}' AS "check", '{t}' AS "table", CAST(({q}) AS BIGINT) AS "rows" """ for (n, t), q in _FOUND.items()) + """) WHERE "rows" > 0""",
    "orders", "lineitem", "events",
)
def checks_26(orders: DataFrame, lineitem: DataFrame, events: DataFrame) -> DataFrame:
    """All checks of the library, in one query."""
    return validate(_store(orders, lineitem, events), checks()).select("check", "table", "rows")


@query(
    """SELECT coalesce(a.k, b.k) AS "table", a.n AS local_rows, b.n AS remote_rows, coalesce(a.n = b.n, false) AS matches
       FROM (SELECT o_orderstatus AS k, count(*) AS n FROM orders GROUP BY 1) a FULL JOIN (SELECT o_orderstatus AS k, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 7 > 0 OR o_orderstatus = 'F' GROUP BY 1) b ON a.k = b.k""",
    "orders",
)
def mirror_counts(orders: DataFrame) -> DataFrame:
    rows = lambda df: df.groupBy(c("o_orderstatus").alias("table")).agg(F.count("*").alias("rows"))
    return compare_counts(rows(orders), rows(orders.where(((c("o_orderstatus") != "P") & (key() % 7 > 0)) | (c("o_orderstatus") == "F"))))


# -- the planner ------------------------------------------------------------------------

#: Quotes: each event is one of the game that its user's number names, on that game's date.
_T = """t AS (SELECT CAST(user_id * 3 AS VARCHAR) AS game_pk, event_type AS book_slug, event_id % 3 AS market, ts, event_id, value, CAST(trunc(value * 10) AS INTEGER) % 60 - 30 AS mins FROM events),
    tk AS (SELECT t.*, g.game_date, g.season_year, g.margin, g.total_runs, g.is_final FROM t JOIN g USING (game_pk))"""


def _ticks(orders: DataFrame, events: DataFrame) -> DataFrame:
    mins = (c("value") * 10).cast("int") % 60 - 30
    quotes = events.select(
        _str(c("user_id") * 3).alias("game_pk"), c("event_type").alias("book_slug"), F.get(F.array(*map(F.lit, ("totals", "run_line", "money_line"))), (c("event_id") % 3).cast("int")).alias("market"),
        c("ts").alias("line_ts"), "event_id", "value", mins.alias("mins_to_tip"), (mins < 0).alias("is_pregame"),
    )
    return quotes.join(_games(orders).select("game_pk", "game_date", "season_year"), "game_pk")


_DIMS = "dims AS (SELECT * FROM g WHERE k % 5 = 0 AND game_date >= DATE '1995-06-01')"
_FETCHES = "done AS (SELECT game_pk FROM g WHERE k % 4 < 2 UNION SELECT game_pk FROM t)"
_GAP = "gap AS (SELECT * FROM g WHERE is_final AND game_date >= (SELECT min(game_date) FROM dims) AND game_pk NOT IN (SELECT game_pk FROM done))"
_PARTIAL = """partial AS (SELECT DISTINCT game_date FROM (SELECT CAST(ts AS DATE) AS game_date, book_slug, count(DISTINCT game_pk) AS n FROM tk WHERE book_slug <> 'error' GROUP BY 1, 2)
    JOIN (SELECT CAST(ts AS DATE) AS game_date, count(DISTINCT game_pk) AS every FROM tk WHERE book_slug <> 'error' GROUP BY 1) USING (game_date) WHERE n >= 0.5 * every AND n < every)"""


def _planned(orders: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    games, k = _games(orders), c("game_pk").cast("long")
    dims = games.where((k % 5 == 0) & (c("game_date") >= F.lit("1995-06-01").cast("date")))
    status = F.get(F.array(*map(F.lit, ("complete", "no_quotes", "rejected", "error"))), (k % 4).cast("int"))
    quotes = events.select(_str(c("user_id") * 3).alias("game_pk"))
    return games, dims, quotes, games.select("game_pk", status.alias("ingest_status"))


def _by_day(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Quotes by their own day, so that a day has several games."""
    return _ticks(orders, events).withColumn("game_date", F.to_date("line_ts"))


@query(f"WITH {_G}, {_T}, {_DIMS}, {_FETCHES}, {_GAP} SELECT game_pk, game_date FROM gap", "orders", "events")
def odds_gap(orders: DataFrame, events: DataFrame) -> DataFrame:
    return planner.gap_games(*_planned(orders, events)).select("game_pk", "game_date")


@query(f"WITH {_G}, {_T}, {_PARTIAL} SELECT game_date FROM partial", "orders", "events")
def partial_dates(orders: DataFrame, events: DataFrame) -> DataFrame:
    return planner.partial_dates(_by_day(orders, events), ["error"])


@query(
    f"""WITH {_G}, {_T}, {_DIMS}, {_FETCHES}, {_GAP}, {_PARTIAL},
        every AS (SELECT DISTINCT game_date, 'refresh' AS reason FROM g WHERE is_final AND game_date BETWEEN DATE '1998-06-01' - 3 AND DATE '1998-06-01' - 1
                  UNION SELECT game_date, 'gap' FROM gap UNION SELECT game_date, 'partial' FROM partial)
        SELECT game_date, string_agg(reason, ',' ORDER BY reason) AS reasons FROM every GROUP BY 1""",
    "orders", "events",
)
def update_plan(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Dates to fetch next, with their reasons."""
    games, dims, _, fetches = _planned(orders, events)
    plan = planner.plan_update(games, dims, _by_day(orders, events), fetches, F.lit("1998-06-01").cast("date"), 3, ["error"])
    return plan.select("game_date", F.array_join("reasons", ",").alias("reasons"))


@query(
    f"""WITH {_G} SELECT game_pk, game_date FROM g WHERE is_final AND (k NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') OR k NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F'))""",
    "orders", "lineitem",
)
def boxscore_gap(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    child = lambda test: lineitem.where(test).select(_str(c("l_orderkey")).alias("game_pk"))
    return planner.missing_boxscores(_games(orders), [child("l_returnflag = 'R'"), child("l_linestatus = 'F'")]).select("game_pk", "game_date")


@query(f"WITH {_G} SELECT game_pk, game_date FROM g WHERE is_final AND k % 4 >= 2", "orders")
def pitch_gap(orders: DataFrame) -> DataFrame:
    status = F.get(F.array(*map(F.lit, ("complete", "no_data", "error", "partial"))), (key() % 4).cast("int"))
    return planner.missing_pitches(_games(orders), orders.select(_str(key()).alias("game_pk"), status.alias("fetch_status"))).select("game_pk", "game_date")


@query(
    f"""WITH {_G}, {_T}, f AS (SELECT season_year, count(*) AS n_ticks, count(DISTINCT game_pk) AS n_games, count(DISTINCT book_slug) AS n_books, CAST(count(*) FILTER (mins < 0) AS BIGINT) AS n_pregame FROM tk GROUP BY 1),
        d AS (SELECT season_year, count(*) AS n_listed, count(*) FILTER (k % 3 = 0) AS n_complete FROM g WHERE k % 5 = 0 GROUP BY 1)
        SELECT season_year, n_ticks, n_games, n_books, n_pregame, n_listed, n_complete, round_even(n_pregame / n_ticks, 4) AS pregame_share FROM f FULL JOIN d USING (season_year)""",
    "orders", "events",
)
def odds_coverage(orders: DataFrame, events: DataFrame) -> DataFrame:
    k = c("game_pk").cast("long")
    listed = _games(orders).where(k % 5 == 0).select("game_pk", "season_year", F.when(k % 3 == 0, "complete").otherwise("rejected").alias("ingest_status"))
    return planner.odds_coverage(listed, _ticks(orders, events))


@query(
    f"""WITH {_G} SELECT season_year, count(DISTINCT k) FILTER (is_final) AS complete, count(DISTINCT k) FILTER (NOT is_final AND k % 2 = 0) AS no_data, CAST(0 AS BIGINT) AS error FROM g GROUP BY 1""",
    "orders",
)
def pitch_coverage(orders: DataFrame) -> DataFrame:
    status = F.when(c("is_final"), "complete").when(c("game_pk").cast("long") % 2 == 0, "no_data").otherwise("pending")
    return planner.pitch_coverage(_games(orders).withColumn("fetch_status", status))


@query(f"WITH {_G}, {_T} SELECT game_pk, string_agg(DISTINCT book_slug, ',' ORDER BY book_slug) AS books FROM tk GROUP BY 1", "orders", "events")
def books_of_games(orders: DataFrame, events: DataFrame) -> DataFrame:
    return planner.share_of_books(_ticks(orders, events)).select("game_pk", F.array_join("books", ",").alias("books"))


# -- identity, openers ------------------------------------------------------------------

_NAMES = ("Red Sox", "New York Yankees", "L.A. Dodgers", "Mars")
_EVENTS = """e AS (SELECT event_id, CAST(ts AS DATE) AS game_date, ts, user_id % 4 AS h, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 2 END AS a FROM events WHERE event_type = 'view'),
    l AS (SELECT event_id AS pk, CAST(ts AS DATE) AS game_date, CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END AS ts, user_id % 3 AS h, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 2 END AS a FROM events WHERE event_type = 'purchase'),
    m AS (SELECT e.event_id, e.h, l.pk, count(l.pk) OVER (PARTITION BY e.event_id) AS n, abs(CAST(floor(epoch(e.ts)) AS BIGINT) - CAST(floor(epoch(l.ts)) AS BIGINT)) AS apart,
                 row_number() OVER (PARTITION BY e.event_id ORDER BY abs(CAST(floor(epoch(e.ts)) AS BIGINT) - CAST(floor(epoch(l.ts)) AS BIGINT)) NULLS LAST, l.pk NULLS LAST) AS r
          FROM e LEFT JOIN l ON e.game_date = l.game_date AND e.h = l.h AND e.a = l.a AND e.h <> 3),
    q AS (SELECT event_id, pk, n, apart, CASE WHEN h = 3 THEN 'unknown_team_name' WHEN n = 0 THEN 'no_game_on_date' WHEN n > 1 AND coalesce(apart > 10800, true) THEN 'doubleheader_no_close_start' END AS reason FROM m WHERE r = 1)"""


def _resolved(events: DataFrame) -> DataFrame:
    """Views are scraped events, purchases listed games of the same teams and day; some have no start."""
    named = F.array(*map(F.lit, _NAMES))
    away = F.when(c("event_id") % 2 == 0, 1).otherwise(2)
    ids = F.array(*map(F.lit, ("111", "147", "119")))
    scraped = events.where("event_type = 'view'").select(
        "event_id", F.to_date("ts").alias("game_date"), c("ts").alias("first_pitch_utc"), F.get(named, (c("user_id") % 4).cast("int")).alias("team_home"), F.get(named, away).alias("team_away"),
    )
    listed = events.where("event_type = 'purchase'").select(
        c("event_id").alias("game_pk"), F.to_date("ts").alias("game_date"), F.when(c("event_id") % 5 != 0, c("ts")).alias("first_pitch_utc"),
        F.get(ids, (c("user_id") % 3).cast("int")).alias("home_team_id"), F.get(ids, away).alias("away_team_id"), F.lit(1).alias("game_number"),
    )
    return resolve_events(scraped, listed)


@query(
    f"""WITH {_EVENTS} SELECT event_id, CASE WHEN reason IS NULL THEN pk END AS game_pk, reason, n > 1 AS is_doubleheader, reason IS NULL AND coalesce(apart > 900, false) AS disagrees,
        CAST(apart // 60 AS INTEGER) AS delta_minutes FROM q""",
    "events",
)
def identity(events: DataFrame) -> DataFrame:
    return _resolved(events).select("event_id", "game_pk", "reason", "is_doubleheader", "disagrees", "delta_minutes")


@query(f"WITH {_EVENTS} SELECT count(*) AS n_events, count(*) FILTER (reason IS NULL) AS n_matched, round_even(count(*) FILTER (reason IS NULL) / count(*), 9) AS rate FROM q", "events")
def identity_rate(events: DataFrame) -> DataFrame:
    return match_rate(_resolved(events)).select("n_events", "n_matched", F.bround("rate", 9).alias("rate"))


_ONE = "one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY game_pk, market, book_slug, ts ORDER BY event_id DESC) AS r0 FROM tk) WHERE r0 = 1)"
_FLAGGED = f"{_ONE}, o AS (SELECT *, row_number() OVER (PARTITION BY game_pk, market, book_slug ORDER BY ts) = 1 AS opener FROM one)"


def _stored(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Stored ticks whose flags say that every ninth event is an opener."""
    one = keep_last(_ticks(orders, events), ["game_pk", "market", "book_slug", "line_ts"], "event_id")
    return one.withColumn("is_opener", c("event_id") % 9 == 0)


@query(f"WITH {_G}, {_T}, {_FLAGGED} SELECT event_id, opener AS is_opener FROM o WHERE opener <> (event_id % 9 = 0)", "orders", "events")
def wrong_openers(orders: DataFrame, events: DataFrame) -> DataFrame:
    return changed_openers(_stored(orders, events)).select("event_id", "is_opener")


@query(
    f"""WITH {_G}, {_T}, {_FLAGGED} SELECT event_id, opener AS is_opener FROM o WHERE game_pk IN (SELECT game_pk FROM one WHERE event_id % 10 = 0)""",
    "orders", "events",
)
def openers_of_touched_games(orders: DataFrame, events: DataFrame) -> DataFrame:
    """A batch of every tenth tick: whole histories of the games it touches, with one opener each."""
    stored = _stored(orders, events)
    incoming = c("event_id") % 10 == 0
    return repair_openers(stored.where(~incoming), stored.where(incoming)).select("event_id", "is_opener")


# -- mirror -----------------------------------------------------------------------------


@query(
    f"""WITH {_G}, {_T}, b AS (SELECT book_slug AS slug, CASE book_slug WHEN 'view' THEN 1 WHEN 'click' THEN 4 ELSE 4 + row_number() OVER (PARTITION BY book_slug IN ('view', 'click') ORDER BY book_slug) END AS book_id FROM (SELECT DISTINCT book_slug FROM tk)),
        l AS (SELECT event_id, CAST(market + 1 AS INTEGER) AS market_id, CAST(book_id AS INTEGER) AS book_id FROM tk JOIN b ON slug = book_slug)
        SELECT event_id, market_id, book_id FROM l WHERE event_id % 3 <> 1 OR event_id % 2 <> 0""",
    "orders", "events",
)
def mirror_lines(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Facts with the ids of market and book; those stored (even events of run lines) are not loaded again."""
    ticks = keep_last(_ticks(orders, events), ["event_id"], "event_id")
    known = events.sparkSession.createDataFrame([(1, "view", "View"), (4, "click", "Click")], "book_id int, slug string, name string")
    facts = mirror.lines(ticks.withColumn("line_ts", c("event_id")), mirror.books(known, ticks))
    stored = facts.where((c("market_id") == 2) & (c("event_id") % 2 == 0))
    return mirror.new_lines(stored, facts).select("event_id", "market_id", "book_id")


@query(
    f"""WITH {_G}, {_T}, tagged AS (SELECT season_year, CASE WHEN event_id % 11 = 0 THEN 'empty_quote' END AS d, CASE WHEN event_id % 7 = 0 THEN 'moneyline_line_cleared' END AS r FROM tk),
        why AS (SELECT season_year, d AS reason FROM tagged WHERE d IS NOT NULL UNION ALL SELECT season_year, r FROM tagged WHERE r IS NOT NULL),
        n AS (SELECT season_year, string_agg('"' || reason || '":' || n, ',' ORDER BY reason) AS s FROM (SELECT season_year, reason, count(*) AS n FROM why GROUP BY ALL) GROUP BY 1)
        SELECT g.season_year, CAST(sum(g.k % 9) AS BIGINT) AS source_ticks, count(*) AS games_seen, count(*) FILTER (k % 3 = 0) AS games_loaded, coalesce(any_value(loaded), 0) AS loaded_ticks, any_value('{{' || s || '}}') AS dropped_rows
        FROM g LEFT JOIN (SELECT season_year, count(*) FILTER (d IS NULL) AS loaded FROM tagged GROUP BY 1) USING (season_year) LEFT JOIN n USING (season_year) GROUP BY 1""",
    "orders", "events",
)
def provenance(orders: DataFrame, events: DataFrame) -> DataFrame:
    k, e = c("game_pk").cast("long"), c("event_id")
    listed = _games(orders).select("season_year", (k % 9).alias("source_tick_count"), F.when(k % 3 == 0, "complete").otherwise("rejected").alias("ingest_status"))
    tagged = _ticks(orders, events).select("season_year", F.when(e % 11 == 0, "empty_quote").alias("drop_reason"), F.when(e % 7 == 0, "moneyline_line_cleared").alias("repair_reason"))
    return mirror.load_provenance(listed, tagged, tagged.where("drop_reason is null"))


# -- outcomes, snapshots, features --------------------------------------------------------

_CLOSE = f"""{_ONE}, f AS (SELECT *, row_number() OVER (PARTITION BY game_pk, market, book_slug ORDER BY ts DESC) AS r FROM one WHERE mins < 0),
    p AS (SELECT game_pk, market, book_slug, CAST(floor(value) AS INTEGER) % 30 AS line, -110 - CAST(floor(value) AS INTEGER) % 50 AS lp, 100 + CAST(floor(value) AS INTEGER) % 40 AS rp, total_runs, margin FROM f WHERE r = 1 AND is_final),
    x AS (SELECT *, CASE market WHEN 0 THEN total_runs - line / 2 WHEN 1 THEN margin - line / 2 END AS residual, -lp / (-lp + 100) AS u, 100 / (rp + 100) AS v FROM p),
    y AS (SELECT game_pk, CASE market WHEN 0 THEN 'totals' WHEN 1 THEN 'run_line' ELSE 'money_line' END AS market, book_slug, residual, CASE market WHEN 0 THEN residual > 0 WHEN 1 THEN residual < 0 ELSE margin < 0 END AS left_won,
                 u / (u + v) AS fair_left, v / (u + v) AS fair_right, u + v - 1 AS overround FROM x)"""


def _closing(orders: DataFrame, events: DataFrame) -> DataFrame:
    whole = F.floor("value").cast("int")
    line = whole % 30
    ticks = _stored(orders, events).withColumns(
        {"left_line": line, "right_line": -line, "left_price": -110 - whole % 50, "right_price": 100 + whole % 40},
    )
    return outcomes.closing_outcomes(ticks, _games(orders))


@query(
    f"""WITH {_G}, {_T}, {_CLOSE} SELECT game_pk, market, book_slug, CAST(residual AS DOUBLE) AS residual, left_won, round_even(fair_left, 6) AS fair_left, round_even(fair_right, 6) AS fair_right, round_even(overround, 6) AS overround FROM y""",
    "orders", "events",
)
def closing_outcomes(orders: DataFrame, events: DataFrame) -> DataFrame:
    df = _closing(orders, events)
    return df.select("game_pk", "market", "book_slug", "residual", "left_won", *(F.bround(x, 6).alias(x) for x in ("fair_left", "fair_right", "overround")))


@query(
    f"""WITH {_G}, {_T}, {_CLOSE} SELECT market, count(*) AS n, round(avg(residual), 6) AS mean_residual, round(stddev_samp(residual), 6) AS std_residual, round(avg(fair_left), 6) AS mean_fair_left,
        round(avg(CAST(left_won AS INTEGER)), 6) AS realised_left, round(avg(overround), 6) AS mean_overround FROM y GROUP BY 1""",
    "orders", "events",
)
def orientation(orders: DataFrame, events: DataFrame) -> DataFrame:
    report = outcomes.orientation_report(_closing(orders, events))
    return report.select("market", "n", *(F.round(x, 6).alias(x) for x in ("mean_residual", "std_residual", "mean_fair_left", "realised_left", "mean_overround")))


_CAPTURES = """h AS (SELECT event_type AS kind, CAST(ts AS DATE) AS slate, ts AS captured, event_id, event_id % 4 = 0 AS empty FROM events WHERE event_id % 2 = 0)"""


def _captures(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every other event is a capture of its kind and day; every fourth one of nothing."""
    heads = events.where("event_id % 2 = 0").select(
        c("event_type").alias("kind"), F.to_date("ts").alias("slate_date"), c("ts").alias("captured_at_utc"), F.when(c("event_id") % 4 == 0, 0).otherwise(2).alias("n_rows"), "event_id"
    )
    data = heads.where("n_rows > 0").select("kind", "slate_date", "captured_at_utc", F.explode(F.array(F.lit(1), F.lit(2))).alias("item"))
    return keep_last(heads, ["kind", "slate_date", "captured_at_utc"], "event_id").drop("event_id"), data


@query(
    f"""WITH {_CAPTURES}, last AS (SELECT kind, slate, max(captured) AS captured FROM h WHERE captured < TIMESTAMP '2024-01-20 12:00:00' GROUP BY 1, 2),
        v AS (SELECT l.kind, l.slate, h.empty FROM last l JOIN h USING (kind, slate, captured))
        SELECT kind, slate, item, empty AS was_empty FROM v LEFT JOIN (SELECT unnest([1, 2]) AS item) ON NOT empty""",
    "events",
)
def snapshot_rows(events: DataFrame) -> DataFrame:
    """What was known strictly before an instant; a capture of nothing is a row of its own."""
    found = snapshots.as_of(*_captures(events), F.lit("2024-01-20 12:00:00").cast("timestamp_ntz"))
    return found.select("kind", c("slate_date").alias("slate"), "item", c("snapshot_was_empty").alias("was_empty"))


@query(
    f"WITH {_CAPTURES} SELECT kind, count(*) AS n_captures, count(DISTINCT slate) AS n_dates, min(slate) AS first_date, max(slate) AS last_date, count(*) FILTER (empty) AS n_empty FROM h GROUP BY 1", "events"
)
def snapshot_coverage(events: DataFrame) -> DataFrame:
    return snapshots.coverage(_captures(events)[0])


@query(
    f"""WITH {_CAPTURES} SELECT CAST(d AS DATE) AS slate_date FROM generate_series(TIMESTAMP '2023-12-25', TIMESTAMP '2024-02-15', INTERVAL 1 DAY) x(d) WHERE CAST(d AS DATE) NOT IN (SELECT slate FROM h WHERE kind = 'purchase')""",
    "events",
)
def snapshot_gaps(events: DataFrame) -> DataFrame:
    return snapshots.missing_snapshot_dates(_captures(events)[0], "purchase", F.lit("2023-12-25").cast("date"), F.lit("2024-02-15").cast("date"))


_ARMS = """a AS (SELECT l_suppkey % 30 AS team_id, l_orderkey AS game_pk, CAST(l_shipdate AS DATE) AS d, l_linenumber = 1 AS starter, l_partkey % 40 AS pitches FROM lineitem),
    s AS (SELECT team_id, game_pk, d, sum(CASE WHEN starter THEN 0 ELSE pitches END) AS load FROM a GROUP BY 1, 2, 3)"""


@query(
    f"""WITH {_ARMS} SELECT team_id, game_pk, d AS game_date, CAST(load AS BIGINT) AS relief, CAST(coalesce(sum(load) OVER (PARTITION BY team_id ORDER BY date_diff('day', DATE '1970-01-01', d) RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS relief_before FROM s""",
    "lineitem",
)
def bullpen(lineitem: DataFrame) -> DataFrame:
    arms = lineitem.select((c("l_suppkey") % 30).alias("team_id"), c("l_orderkey").alias("game_pk"), F.to_date("l_shipdate").alias("game_date"), (c("l_linenumber") == 1).alias("is_starter"), (c("l_partkey") % 40).alias("pitches_thrown"))
    return features.bullpen_load(arms).select("team_id", "game_pk", "game_date", c("relief_pitches").alias("relief"), c("relief_pitches_BEFORE").alias("relief_before"))


@query(
    """WITH s AS (SELECT o_custkey % 30 AS team_id, o_orderkey AS game_pk, o_orderdate, o_orderkey % 12 AS runs FROM orders)
       SELECT team_id, game_pk, round_even(avg(runs) OVER (PARTITION BY team_id ORDER BY o_orderdate, game_pk ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 6) AS runs_before FROM s""",
    "orders",
)
def team_form(orders: DataFrame) -> DataFrame:
    rows = orders.select((c("o_custkey") % 30).alias("team_id"), key().alias("game_pk"), c("o_orderdate").alias("first_pitch_utc"), (key() % 12).alias("runs"))
    return features.team_features(rows, ["runs"]).select("team_id", "game_pk", F.bround("runs_BEFORE", 6).alias("runs_before"))


@query(
    """WITH s AS (SELECT o_custkey AS player, o_orderkey AS game_pk, o_orderdate, o_orderkey % 100 AS pitches FROM orders WHERE o_orderstatus = 'F')
       SELECT player, game_pk, round_even(avg(pitches) OVER (PARTITION BY player ORDER BY o_orderdate, game_pk ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS pitches_before FROM s""",
    "orders",
)
def starter_form(orders: DataFrame) -> DataFrame:
    rows = orders.select(c("o_custkey").alias("player_id"), key().alias("game_pk"), c("o_orderdate").alias("first_pitch_utc"), (key() % 100).alias("pitches"), (c("o_orderstatus") == "F").alias("is_starter"))
    return features.starter_features(rows, ["pitches"]).select(c("player_id").alias("player"), "game_pk", F.bround("pitches_BEFORE", 6).alias("pitches_before"))

@query(
    """WITH s AS (SELECT o_custkey % 30 AS team_id, o_orderkey AS game_pk, o_orderdate, o_orderkey % 12 AS runs FROM orders WHERE o_orderkey % 1000 <> 9)
       SELECT team_id, game_pk, round_even(avg(runs) OVER (PARTITION BY team_id ORDER BY o_orderdate, game_pk ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 6) AS runs_before FROM s""",
    "orders",
)
def team_form_refresh(orders: DataFrame) -> DataFrame:
    """Games that come, go and are corrected: only the windows that they reach are computed anew, and all are as if computed from the start."""

    def games(rows: DataFrame, right: bool) -> DataFrame:
        runs = key() % 12 if right else F.when(key() % 1000 == 8, 99).otherwise(key() % 12)
        return rows.select((c("o_custkey") % 30).alias("team_id"), key().alias("game_pk"), c("o_orderdate").alias("first_pitch_utc"), runs.alias("runs"))

    before = features.team_features(games(orders.where("o_orderkey % 1000 <> 7"), False), ["runs"])
    touched = games(orders.where("o_orderkey % 1000 IN (7, 8, 9)"), True)
    after = features.refresh_team_features(before, games(orders.where("o_orderkey % 1000 <> 9"), True), touched, ["runs"])
    return after.select("team_id", "game_pk", F.bround("runs_BEFORE", 6).alias("runs_before"))


@query(
    f"""WITH {_ARMS}, t AS (SELECT * FROM s WHERE game_pk % 1000 <> 9)
        SELECT team_id, game_pk, d AS game_date, CAST(load AS BIGINT) AS relief, CAST(coalesce(sum(load) OVER (PARTITION BY team_id ORDER BY date_diff('day', DATE '1970-01-01', d) RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS relief_before FROM t""",
    "lineitem",
)
def bullpen_refresh(lineitem: DataFrame) -> DataFrame:
    def arms(rows: DataFrame) -> DataFrame:
        return rows.select((c("l_suppkey") % 30).alias("team_id"), c("l_orderkey").alias("game_pk"), F.to_date("l_shipdate").alias("game_date"), (c("l_linenumber") == 1).alias("is_starter"), (c("l_partkey") % 40).alias("pitches_thrown"))

    before = features.bullpen_load(arms(lineitem.where("l_orderkey % 1000 <> 7")))
    touched = arms(lineitem.where("l_orderkey % 1000 IN (7, 9)"))
    after = features.refresh_bullpen_load(before, arms(lineitem.where("l_orderkey % 1000 <> 9")), touched)
    return after.select("team_id", "game_pk", "game_date", c("relief_pitches").alias("relief"), c("relief_pitches_BEFORE").alias("relief_before"))
