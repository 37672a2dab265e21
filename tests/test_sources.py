import datetime as dt
import json

import pytest

from pitlake.plans import ingest
from pitlake.sources import boxscores, quotes, schedules
from pitlake.sources.store import Store


def raw(spark, *payloads):
    return spark.createDataFrame([(json.dumps(p), i) for i, p in enumerate(payloads)], "payload string, ordinal int")


def side(team, batters, pitchers):
    players = {}
    for i, (order, stats) in enumerate(batters):
        players[f"B{i}"] = {"person": {"id": 100 + i, "fullName": f"b{i}"}, "position": {"code": "4", "abbreviation": "2B"}, "battingOrder": order, "stats": {"batting": stats, "pitching": {}}}
    for i, stats in enumerate(pitchers):
        players[f"P{i}"] = {"person": {"id": 200 + i, "fullName": f"p{i}"}, "stats": {"batting": {}, "pitching": stats}}
    return {
        "team": {"id": team, "name": f"T{team}"}, "players": players, "batters": [100], "pitchers": [201, 200], "bullpen": [], "bench": [1, 2],
        "teamStats": {
            "batting": {"plateAppearances": 38, "atBats": 34, "hits": 9, "doubles": 2, "triples": 0, "homeRuns": 1, "baseOnBalls": 3, "strikeOuts": 8, "hitByPitch": 1, "sacFlies": 0, "totalBases": 14, "runs": 5},
            "pitching": {"inningsPitched": "9.0", "outs": 0, "battersFaced": 36, "numberOfPitches": 140, "hits": 7, "baseOnBalls": 2, "hitBatsmen": 0, "strikeOuts": 9, "homeRuns": 1, "runs": 3, "strikes": 90},
            "fielding": {"errors": 1},
        },
    }


@pytest.fixture
def box(spark):
    home = side(147, [("100", {"atBats": 4, "hits": 2, "plateAppearances": 4}), ("101", {"atBats": 0})], [{"outs": 8, "gamesStarted": 0}, {"outs": 19, "gamesStarted": 1, "strikeOuts": 7, "battersFaced": 25}])
    payload = {"teams": {"home": home, "away": side(111, [], [])}, "officials": [{"official": {"id": 9, "fullName": "u"}, "officialType": "Home Plate"}]}
    meta = spark.createDataFrame([("5", 2025, None, None, "R", "3", json.dumps(payload))], "game_pk string, season_year int, game_date date, first_pitch_utc timestamp, game_type string, venue_id string, payload string")
    return meta


def test_boxscore_teams(box):
    rows = {r["team_id"]: r for r in boxscores.team_games(box).collect()}
    home = rows["147"]
    assert set(rows) == {"147", "111"} and home["home"] and home["opponent_team_id"] == "111"
    assert (home["outs_recorded"], home["pitches_thrown"], home["singles"], home["run_margin"], home["win"]) == (27, 140, 6, 2, True)
    assert (home["obp"], home["slg"], home["whip"]) == (round(13 / 38, 6), round(14 / 34, 6), round(9 / 9.0, 6))
    assert home["inherited_runners"] is None and home["errors"] == 1 and home["bench_size"] == 2 and home["rbi"] == 0


def test_boxscore_players(box):
    bats = {r["player_id"]: r for r in boxscores.batter_games(box).collect()}
    assert set(bats) == {"100", "101"}
    assert bats["100"]["is_starter"] and not bats["101"]["is_starter"] and bats["101"]["lineup_slot"] == 1 and not bats["101"]["had_plate_appearance"]
    arms = {r["player_id"]: r for r in boxscores.pitcher_appearances(box).collect()}
    assert arms["201"]["is_starter"] and arms["201"]["appearance_number"] == 1 and arms["200"]["appearance_number"] == 2 and arms["201"]["k_pct"] == 0.28
    assert [(r["official_id"], r["is_home_plate"]) for r in boxscores.officials(box).collect()] == [("9", True)]


def game(pk, home, away, kind="R", state="Final", score=(5, 3), date="2025-06-01", **more):
    return {
        "gamePk": pk, "officialDate": date, "gameDate": f"{date}T23:10:00Z", "gameType": kind, "status": {"abstractGameState": state},
        "teams": {"home": {"team": home, "score": score and score[0]}, "away": {"team": away, "score": score and score[1]}}, **more,
    }


NYY, BOS = {"id": 147, "name": "New York Yankees"}, {"id": 111, "name": " Boston Red Sox "}


def test_schedule(spark):
    seed = {"id": 4618, "name": "AL Wild Card #1"}
    lineup = {"homePlayers": [{"id": 1, "fullName": "a"}, {"id": 2, "fullName": "b"}], "awayPlayers": []}
    payload = {"dates": [{"games": [
        game(1, NYY, BOS, state="Preview", score=None), game(1, NYY, BOS, linescore={"currentInning": 10, "teams": {"home": {"runs": 6}, "away": {"runs": 3}}}, lineups=lineup, scheduledInnings=0,
             officials=[{"official": {"id": 7, "fullName": "u"}, "officialType": "Home Plate"}]),
        game(2, seed, BOS, kind="F", state="Preview", score=None), game(3, NYY, BOS, kind="S"),
    ]}]}
    rows = schedules.games(raw(spark, payload)).collect()
    assert [r["game_pk"] for r in rows] == ["1"]
    g = rows[0]
    assert (g["is_final"], g["home_score"], g["total_runs"], g["run_line_margin"], g["extra_innings"], g["scheduled_innings"], g["away_team_name"]) == (True, 6, 9, 3, True, 9, "Boston Red Sox")
    assert [(r["player_id"], r["lineup_slot"]) for r in schedules.lineups(raw(spark, payload)).orderBy("lineup_slot").collect()] == [("1", 1), ("2", 2)]
    assert schedules.umpires(raw(spark, payload)).count() == 1
    assert [tuple(r) for r in schedules.repeated_listings(raw(spark, payload)).collect()] == [("1", 2)]


def test_unknown_teams(spark):
    new = {"id": 9999, "name": "Nashville Stars"}
    for kind, state in (("R", "Final"), ("F", "Final")):
        with pytest.raises(Exception, match="unknown team in game 4"):
            schedules.games(raw(spark, {"dates": [{"games": [game(4, new, BOS, kind, state)]}]})).collect()
    assert schedules.games(raw(spark, {"dates": [{"games": [game(4, new, BOS)]}]}), strict=False).collect() == []
    known_name = {"id": 9999, "name": "NY Yankees"}
    assert schedules.games(raw(spark, {"dates": [{"games": [game(4, known_name, BOS)]}]})).count() == 1


def test_venues_and_transactions(spark):
    v = schedules.venues(raw(spark, {"venues": [{"id": 3, "name": "F", "active": True, "location": {"city": "B", "elevation": 20, "defaultCoordinates": {"latitude": 42.3}}, "fieldInfo": {"leftLine": 310}}]}), 2025).first()
    assert (v["venue_id"], v["season"], v["latitude"], v["left_line"], v["capacity"]) == ("3", 2025, 42.3, 310, None)
    moves = [{"id": 1, "date": "2025-05-25", "effectiveDate": "2025-05-22", "typeDesc": "Status Change", "description": "placed on the 15-day injured list"}, {"id": 2, "effectiveDate": "2025-05-22"}, {"id": 3, "date": "2025-05-25"}]
    rows = {r["transaction_id"]: r for r in schedules.transactions(raw(spark, {"transactions": moves})).collect()}
    assert set(rows) == {"1", "3"}
    assert (rows["1"]["backdated_days"], rows["1"]["is_backdated"], rows["1"]["is_injury_related"]) == (3, True, True) and not rows["3"]["is_backdated"]


def history(event=343244, start="2025-06-01T23:10:00+00:00", views=()):
    view = {"gameId": event, "startDate": start, "homeTeam": {"fullName": "New York Yankees"}, "awayTeam": {"fullName": "Boston Red Sox"}, "homeStarter": {"firstName": "A", "lastName": "B"}}
    books = [{"machineName": "fan", "name": "Fanatics Sportsbook"}]
    return {"props": {"pageProps": {"lineHistoryModel": {"sportsbooks": books, "lineHistory": {"gameView": view, "oddsViews": list(views)}}}}}


def quote(minute, total=8.5, over=-110, under=-110, second=0):
    return {"oddsDate": f"2025-06-01T20:{minute:02d}:{second:02d}+00:00", "total": total, "overOdds": over, "underOdds": under}


def test_line_history(spark):
    views = [
        {"sportsbook": "fan", "totalHistory": [quote(5, over=-105), quote(7, over=225), quote(7, over=200, second=30), quote(9), quote(9, None, None, None, 30)]},
        {"sportsbook": "fan", "totalHistory": [quote(3)]}, {"sportsbook": "other", "moneyLineHistory": [{"oddsDate": "2025-06-01T23:30:00+00:00", "homeOdds": -120, "awayOdds": 100}]}, {"sportsbook": " "},
    ]
    games = quotes.scraped_games(raw(spark, history(views=views), history(event=None), history(start="2025-06-01T23:10:00"), {"x": 1}))
    assert sorted(str(r["reason"]) for r in games.collect()) == ["None", "no_game_id", "no_json", "no_start"]
    g = games.where("reason is null").first()
    assert (g["event_id"], str(g["game_date"]), g["starter_home"], g["team_away"]) == (343244, "2025-06-01", "A B", "Boston Red Sox")
    rows = quotes.ticks(games).orderBy("book_slug", "line_ts").collect()
    got = [(r["book_slug"], r["market"], r["line_ts"].minute, r["left_price"], r["is_opener"]) for r in rows]
    assert got == [("fanatics_sportsbook", "totals", 3, -110, True), ("fanatics_sportsbook", "totals", 5, -105, False), ("fanatics_sportsbook", "totals", 7, 200, False), ("other", "money_line", 30, 100, True)]
    assert rows[-1]["minutes_to_tip"] == 20 and rows[0]["minutes_to_tip"] < 0


def test_pages_and_slates(spark):
    html = '<x><script id="__NEXT_DATA__" type="application/json" a="b">{"a":\n1}</script>'
    df = spark.createDataFrame([(html,), ("<p>",)], "html string").coalesce(1).select(quotes.page_json("html"))
    assert [r[0] for r in df.collect()] == ['{"a":\n1}', ""]
    row = lambda i, start="2025-06-02T01:10:00Z": {"gameView": {"gameId": i, "startDate": start}}
    slate = {"props": {"pageProps": {"oddsTables": [{"oddsTableModel": {"gameRows": [row(1), row(1, "2025-06-03T01:10:00Z"), row(None), row(2, "naive")]}}]}}}
    assert [(r["event_id"], str(r["game_date"])) for r in quotes.slate(raw(spark, slate)).collect()] == [(1, "2025-06-01")]


def test_pitches_count_by_file_and_place(spark, tmp_path):
    """The last row of a key is that of the last file, and in it of the last line, though files are split and packed otherwise."""
    line = lambda speed, n=1: f"7,2025-06-01,1,{n},{speed}"
    head = "game_pk,game_date,at_bat_number,pitch_number,release_speed"
    (tmp_path / "b.csv").write_text("\n".join([head, line(1.0), *(line(50.0 + i, i) for i in range(2, 900)), line(2.0)]))
    (tmp_path / "a.csv").write_text("\n".join([head, *(line(80.0, 1000 + i) for i in range(2000)), line(9.0), line(8.0, 5)]))
    for size in ("1k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = {r["pitch_number"]: r["release_speed"] for r in quotes.pitches(quotes.read_pitches(spark, str(tmp_path)), 2025).collect()}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert (got[1], got[5], got[1000], len(got)) == (2.0, 55.0, 80.0, 899 + 2000)


def test_pitches(spark):
    rows = [("7.0", "2025-06-01", "1", "2", "5.0", "6.0", "95.1", "8.0"), ("7.0", "2025-06-01", "1", "2", "5.0", "6.0", "96.1", None), ("7.0", "2025-06-01", None, "2", None, None, None, None)]
    df = spark.createDataFrame(rows, "game_pk string, game_date string, at_bat_number string, pitch_number string, batter string, pitcher string, release_speed string, on_1b string").coalesce(1)
    got = quotes.pitches(df, 2025).collect()
    assert len(got) == 1 and (got[0]["game_pk"], got[0]["batter_id"], got[0]["release_speed"], got[0]["on_1b"], got[0]["launch_speed"]) == ("7", "5", 96.1, None, None)
    with pytest.raises(Exception, match="pitch feed: too many"):
        quotes.pitches(spark.createDataFrame([("too many",)], "error string"), 2025).collect()


def test_season_end_to_end(spark, tmp_path, box):
    store = Store(spark, str(tmp_path / "s"))
    payload = {"dates": [{"games": [game(5, NYY, BOS, officials=[{"official": {"id": 7, "fullName": "u"}, "officialType": "Home Plate"}]), game(6, BOS, NYY, state="Live"), game(8, BOS, NYY, date="2025-06-02")]}]}
    assert ingest.update_games(store, raw(spark, payload), 2025, exclude_dates=["2025-06-02"]) == {"games": 1, "umpires": 1, "lineups": 0}
    assert [r["game_pk"] for r in ingest.missing_boxscores(store, 2025).collect()] == ["5"]
    written = ingest.update_boxscores(store, box.select("game_pk", "payload"), 2025)
    assert written == {"team_games": 2, "batter_games": 2, "pitcher_appearances": 2, "umpires": 1}
    assert ingest.missing_boxscores(store, 2025).count() == 0
    views = [{"sportsbook": "fan", "totalHistory": [quote(5), quote(6, total=85.0), quote(7, total=None, over=0, under=5)]}]
    from pyspark.sql import functions as F

    done, account = ingest.ingest_odds(store, raw(spark, history(views=views), history(event=9, start="2024-06-01T23:10:00Z")), 2025, F.lit("2025-06-02").cast("timestamp"))
    assert done == {"odds_ticks": 2, "odds_games": 1, "odds_fetches": 1}
    assert {r["reason"]: r["n"] for r in account.collect()} == {"line_out_of_bounds_cleared": 1, "empty_quote": 1}
    assert ingest.odds_gap(store, [2025]).count() == 0 and ingest.repair_all_openers(store, 2025) == 0
    fetched = spark.createDataFrame([("5",), ("8",)], "game_pk string").selectExpr("game_pk", "date'2025-06-01' game_date", "timestamp'2025-06-02' fetched_at_utc")
    csv = spark.createDataFrame([("5", "2025-06-01", "1", "1")], "game_pk string, game_date string, at_bat_number string, pitch_number string")
    assert ingest.missing_pitches(store, 2025).count() == 1
    assert ingest.update_pitches(store, csv, fetched, 2025) == {"statcast_pitches": 1, "statcast_games": 2}
    assert ingest.missing_pitches(store, 2025).count() == 0
    assert ingest.repair_store(store, 2025) == {"batter_games": 0, "team_games": 0}


def test_team_rows_parse_no_players(spark):
    """Statistics are fields of the schema; odd payloads give what they gave when they were looked up in maps."""
    side = {"team": {"id": 7}, "teamStats": {"batting": {"hits": 5, "doubles": "2", "homeRuns": None, "atBats": {"x": 1}}, "fielding": {"errors": 1}}, "players": {"a": 3}, "batters": [1, 2]}
    payloads = [{"teams": {"home": side, "away": {"team": {"id": " "}}}}, {"teams": {"home": side}}, {}, None, "no json"]
    rows = [(str(i), 2025, dt.date(2025, 6, 1), None, "R", "9", p if p is None or isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    df = boxscores.team_games(spark.createDataFrame(rows, "game_pk string, season_year int, game_date date, first_pitch_utc timestamp, game_type string, venue_id string, payload string"))
    got = {(r["game_pk"], r["home"]): (r["team_id"], r["opponent_team_id"], r["hits"], r["singles"], r["at_bats"], r["errors"], r["batters_used"], r["inherited_runners"]) for r in df.collect()}
    home, none = (5, 3, 0, 1, 2, None), (0, 0, 0, 0, 0, None)
    assert got == {("0", True): ("7", None, *home), ("1", True): ("7", None, *home)} | {("0", False): (None, "7", *none), ("1", False): (None, "7", *none)} | {(str(i), h): (None, None, *none) for i in (2, 3, 4) for h in (True, False)}
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "players" not in plan and "plateAppearances" in plan
