import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pitlake.operators.gaps import incomplete, missing_since_first, refresh_dates
from pitlake.operators.ordered import duplicates, keep_best_game, keep_last
from pitlake.plans import archive, features, mirror, outcomes, planner, snapshots
from pitlake.plans.quotes import changed_openers, match_rate, odds_tables, resolve_events, tag_ticks
from pitlake.plans.validation import checks, compare_counts, validate

DAY = dt.date(2025, 6, 1)


def at(hour, minute=0, day=1):
    return dt.datetime(2025, 6, day, hour, minute)


def test_keep_best_and_last(spark):
    rows = [("1", False, at(1), 0), ("1", True, None, 1), ("1", True, at(5), 2), ("1", True, at(4), 3), ("2", False, None, 4)]
    best = keep_best_game(spark.createDataFrame(rows, "game_pk string, is_final boolean, first_pitch_utc timestamp, o int"), "o")
    assert sorted(r["o"] for r in best.collect()) == [3, 4]
    df = spark.createDataFrame([("a", 1), ("a", None), ("a", 3), ("b", None)], "k string, o int")
    assert sorted(((r["k"], r["o"]) for r in keep_last(df, ["k"], "o").collect()), key=str) == [("a", 3), ("b", None)]
    assert [(r["k"], r["n"], r["extra"]) for r in duplicates(df, ["k"]).collect()] == [("a", 3, 2)]


GAMES = "game_pk string, game_date date, home_team_id string, away_team_id string, first_pitch_utc timestamp, game_number int"
EVENT = "event_id int, game_date date, first_pitch_utc timestamp, team_home string, team_away string, starter_home string, starter_away string, season_year int"


def event(i, when, home="New York Yankees", away="Red Sox", day=DAY):
    return (i, day, when, home, away, None, None, 2025)


def test_identity(spark):
    games = spark.createDataFrame([("g1", DAY, "147", "111", at(17, 35), 1), ("g2", DAY, "147", "111", at(23, 10), 2), ("g3", DAY, "119", "137", at(20), 1)], GAMES)
    events = [
        event(1, at(17, 35)), event(2, at(23, 5)), event(3, at(6)), event(4, at(17), home="Mars"), event(5, at(17), day=dt.date(2025, 6, 9)),
        event(6, at(20, 20), home="LA Dodgers", away="Giants"), event(7, at(5), home="L.A. Dodgers", away="SF"), event(8, at(17), home=None),
    ]
    got = {r["event_id"]: r for r in resolve_events(spark.createDataFrame(events, EVENT), games).collect()}
    assert {i: r["game_pk"] for i, r in got.items()} == {1: "g1", 2: "g2", 3: None, 4: None, 5: None, 6: "g3", 7: "g3", 8: None}
    assert {i: r["reason"] for i, r in got.items() if r["reason"]} == {3: "doubleheader_no_close_start", 4: "unknown_team_name", 5: "no_game_on_date", 8: "unknown_team_name"}
    assert got[1]["is_doubleheader"] and not got[6]["is_doubleheader"] and got[6]["disagrees"] and not got[2]["disagrees"] and got[6]["delta_minutes"] == 20
    rate = match_rate(spark.createDataFrame([(1, None), (2, "x")], "event_id int, reason string")).first()
    assert (rate["n_events"], rate["n_matched"], rate["rate"]) == (2, 1, 0.5)


def test_match_rate_of_a_day_with_very_many_games(spark):
    """Each event would meet 20,000 games in pairs."""
    games = spark.range(20_000).selectExpr("cast(id as string) game_pk", "date'2025-06-01' game_date", "'147' home_team_id", "'111' away_team_id", "timestamp_seconds(1748736000 + id * 4) first_pitch_utc", "1 game_number")
    events = spark.range(20_000).selectExpr("id event_id", "date'2025-06-01' game_date", "timestamp_seconds(1748736001 + id * 4) first_pitch_utc", "if(id % 4 = 0, 'Mars', 'New York Yankees') team_home", "'Red Sox' team_away")
    resolved = resolve_events(events, games)
    assert tuple(match_rate(resolved).first()) == (20_000, 15_000, 0.75)
    assert resolved.where("reason is null and game_pk <> cast(event_id as string)").count() == 0
    plan = resolved._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_match_rate_joins_nothing_but_names(spark):
    """60 events and games of one day and pair of teams: the plan has the joins of the two names and none of events with games."""
    games = spark.range(60).selectExpr("cast(id as string) game_pk", "date'2025-06-01' game_date", "'147' home_team_id", "'111' away_team_id", "timestamp_seconds(1748736000 + id * 4) first_pitch_utc", "1 game_number")
    events = spark.range(60).selectExpr("id event_id", "date'2025-06-01' game_date", "timestamp_seconds(1748736001 + id * 4) first_pitch_utc", "if(id % 4 = 0, 'Mars', 'New York Yankees') team_home", "'Red Sox' team_away")
    rate = match_rate(resolve_events(events, games))
    assert tuple(rate.first()) == (60, 45, 0.75)
    assert rate._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2


TICK = "event_id int, season_year int, game_date date, market string, book_slug string, line_ts timestamp, minutes_to_tip int, left_line double, left_price int, right_line double, right_price int"


def tick(market, left, right, lp=-110, rp=-110, mins=-90, n=0, event=1):
    return (event, 2025, DAY, market, "b", at(10, n), mins, left, lp, right, rp)


def test_tick_rules(spark):
    rows = [
        tick("totals", 8.5, 8.5, n=0), tick("totals", 8.5, 9.5, n=1), tick("run_line", 1.5, -1.5, n=2), tick("run_line", 1.5, 1.5, n=3), tick("money_line", 1.0, None, n=4),
        tick("totals", 85.0, 85.0, n=5), tick("totals", 85.0, 85.0, mins=30, n=6), tick("run_line", 9.5, -9.5, mins=120, n=7), tick("totals", None, None, -100000, 50, n=8), tick("totals", None, 8.5, None, None, n=9),
    ]
    got = {r["line_ts"].minute: r for r in tag_ticks(spark.createDataFrame(rows, TICK)).collect()}
    assert {n: r["drop_reason"] for n, r in got.items() if r["drop_reason"]} == {1: "totals_sides_disagree", 3: "run_line_not_mirrored", 8: "empty_quote"}
    assert {n: r["repair_reason"] for n, r in got.items() if r["repair_reason"]} == {4: "moneyline_line_cleared", 5: "line_out_of_bounds_cleared"}
    assert got[5]["left_line_code"] is None and got[6]["left_line_code"] == 170 and got[2]["right_line_code"] == -3 and got[4]["left_price_code"] == -110
    with pytest.raises(Exception, match="multiple of a half"):
        tag_ticks(spark.createDataFrame([tick("totals", 8.25, 8.25)], TICK)).collect()


def test_odds_tables_account_for_every_tick(spark):
    games = spark.createDataFrame([("g1", DAY, "147", "111", at(17, 35), 1), ("g3", DAY, "119", "137", at(20), 1), ("g4", DAY, "112", "113", at(20), 1)], GAMES)
    events = spark.createDataFrame([event(1, at(17, 35)), event(2, at(20), "Dodgers", "Giants"), event(3, at(20), "Cubs", "Reds"), event(4, at(1), "x", "y")], EVENT)
    ticks = spark.createDataFrame([tick("totals", 8.5, 8.5, n=0), tick("totals", 9.0, 9.0, n=5), tick("totals", 8.5, 9.5, n=1), tick("totals", 8.5, 9.5, event=2), tick("totals", 8.5, 8.5, event=4)], TICK)
    load, dim, tagged = odds_tables(events, ticks, games)
    status = {r["game_pk"]: (r["ingest_status"], r["source_tick_count"], r["usable_tick_count"], r["dropped_tick_count"]) for r in dim.collect()}
    assert status == {"g1": ("complete", 3, 2, 1), "g3": ("rejected", 1, 0, 1), "g4": ("no_quotes", 0, 0, 0)}
    rows = load.orderBy("line_ts").collect()
    assert [r["is_opener"] for r in rows] == [True, False] and rows[0]["left_line"] == 17
    assert tagged.count() == load.count() + tagged.where("drop_reason is not null").count()
    wrong = load.withColumn("is_opener", F.lit(True))
    assert changed_openers(wrong).count() == 1 and changed_openers(load).count() == 0


def test_quotes_of_a_page_are_not_sorted_with_its_event(spark):
    """Scraped events carry their pages' books and views, which hold all quotes; matching needs neither."""
    games = spark.createDataFrame([("g1", DAY, "147", "111", at(17, 35), 1)], GAMES)
    events = spark.createDataFrame([event(1, at(17, 35)), event(2, at(17, 35))], EVENT)
    scraped = events.selectExpr("*", "cast(null as string) reason", "array_repeat(team_home, 5) books", "array_repeat(team_away, 5) views")
    ticks = spark.createDataFrame([tick("totals", 8.5, 8.5), tick("totals", 8.5, 9.5, n=1)], TICK)
    tables = odds_tables(scraped, ticks, games)
    assert {r["event_id"]: (r["ingest_status"], r["source_tick_count"], r["usable_tick_count"]) for r in tables[1].collect()} == {1: ("complete", 2, 1), 2: ("no_quotes", 0, 0)}
    for df in tables:
        assert "array_repeat" not in df._jdf.queryExecution().optimizedPlan().toString()


PLAN = "game_pk string, game_date date, season_year int, is_final boolean"


def test_planner(spark):
    games = spark.createDataFrame([(str(i), dt.date(2025, 6, i), 2025, True) for i in (1, 2, 3)] + [("0", dt.date(2017, 5, 1), 2017, True), ("9", dt.date(2025, 6, 3), 2025, False)], PLAN)
    dims = games.where("game_pk = '1'").select("game_pk", "game_date", "season_year")
    none = spark.createDataFrame([], "game_pk string, game_date date, book_slug string, season_year int")
    gaps = lambda dim, fetches=None, ticks=none: sorted(r["game_pk"] for r in planner.gap_games(games, dim, ticks, fetches).collect())
    assert gaps(dims) == ["2", "3"]
    assert gaps(dims.limit(0)) == ["0", "1", "2", "3"]
    fetches = spark.createDataFrame([("1", "complete"), ("2", "rejected"), ("3", "no_quotes")], "game_pk string, ingest_status string")
    assert gaps(dims, fetches) == ["2"]
    ticks = spark.createDataFrame([(str(g), DAY, b, 2025) for b, n in (("a", 3), ("b", 2), ("c", 1)) for g in range(n)], none.schema)
    assert [r[0] for r in planner.partial_dates(ticks).collect()] == [DAY] and planner.partial_dates(ticks, ["b"]).count() == 0
    plan = {str(r["game_date"]): r["reasons"] for r in planner.plan_update(games, dims, ticks, None, F.lit("2025-06-04").cast("date"), 1).collect()}
    assert plan == {"2025-06-01": ["partial"], "2025-06-03": ["gap", "refresh"]}  # game 2 has ticks
    assert refresh_dates(games, "game_date", F.lit("2025-06-04").cast("date"), 0).count() == 0
    assert incomplete(games, [dims, games], "game_pk").count() == 4
    assert missing_since_first(games, dims, "game_pk", "game_date", dims).count() == 3
    marks = spark.createDataFrame([("1", 2025, "complete"), ("2", 2025, "no_data"), ("3", 2025, "complete")], "game_pk string, season_year int, fetch_status string")
    assert planner.pitch_coverage(marks).first().asDict() == {"season_year": 2025, "complete": 2, "no_data": 1, "error": 0}


def tables(spark, **change):
    base = {
        "games": ("game_pk string, is_final boolean, home_score int, away_score int, total_runs int, innings_played int, home_team_id string, away_team_id string", [("1", True, 5, 3, 8, 9, "H", "A")]),
        "team_games": ("game_pk string, team_id string, opponent_team_id string, home boolean, runs_scored int, runs_allowed int, outs_recorded int", [("1", "H", "A", True, 5, 3, 27), ("1", "A", "H", False, 3, 5, 24)]),
        "pitcher_appearances": ("game_pk string, team_id string, is_starter boolean, outs_recorded int", [("1", "H", True, 19), ("1", "H", False, 8), ("1", "A", True, 24)]),
        "batter_games": ("game_pk string, team_id string, is_starter boolean, at_bats int, hits int, doubles int, triples int, home_runs int", [("1", "H", True, 4, 2, 1, 0, 0)] * 9),
        "umpires": ("game_pk string, official_id string, is_home_plate boolean", [("1", "u", True)]),
        "odds_ticks": ("game_pk string, market string, book_slug string, is_opener boolean", [("1", "m", "b", True), ("1", "m", "b", False)]),
        "statcast_pitches": ("game_pk string, at_bat_number int, pitch_number int", [("1", 1, 1), ("1", 1, 2)]),
        "statcast_games": ("game_pk string, fetch_status string, pitch_rows int", [("1", "complete", 2), ("2", "no_data", 0)]),
    }
    return {n: spark.createDataFrame(change.get(n, rows), schema) for n, (schema, rows) in base.items()}


@pytest.mark.parametrize(
    "change,expected",
    [
        ({}, {}),
        ({"games": [("1", True, 5, 3, 8, 9, "H", "A")] * 3}, {("duplicate_game_pk", "games"): 2, ("outs_inconsistent_with_innings", "team_games"): 0}),
        ({"games": [("1", True, 99, 3, 102, 9, "H", "A")]}, {("implausible_runs", "games"): 1, ("runs_disagree_with_games", "team_games"): 1}),
        ({"games": [("1", True, None, 3, 8, 4, "H", "H")]}, {("total_runs_mismatch", "games"): 1, ("short_game", "games"): 1, ("same_team_both_sides", "games"): 1, ("outs_inconsistent_with_innings", "team_games"): 2}),
        ({"games": [("1", True, 5, 3, None, 9, "H", "A")]}, {("final_without_score", "games"): 1}),
        ({"team_games": [("1", "H", "H", True, 5, 3, 9)]}, {("wrong_row_count", "team_games"): 1, ("implausible_outs", "team_games"): 1, ("self_opponent", "team_games"): 1, ("outs_inconsistent_with_innings", "team_games"): 1, ("runs_not_reciprocal", "team_games"): 1, ("outs_disagree_with_team_game", "pitcher_appearances"): 1}),
        ({"team_games": [("1", "H", "A", True, None, 3, 27), ("1", "A", "H", False, 3, 5, 24)]}, {("runs_not_reciprocal", "team_games"): 1, ("runs_disagree_with_games", "team_games"): 1}),
        ({"pitcher_appearances": [("1", "H", True, 19), ("1", "H", True, 121)]}, {("wrong_starter_count", "pitcher_appearances"): 1, ("implausible_outs", "pitcher_appearances"): 1, ("outs_disagree_with_team_game", "pitcher_appearances"): 1}),
        ({"batter_games": [("1", "H", True, 3, 4, 1, 0, 0), ("1", "H", False, 4, 1, 1, 0, 1)]}, {("wrong_starting_lineup_size", "batter_games"): 1, ("hits_exceed_at_bats", "batter_games"): 1, ("extra_base_hits_exceed_hits", "batter_games"): 1}),
        ({"umpires": [("1", "u", False)]}, {("missing_home_plate_umpire", "umpires"): 1}),
        ({"umpires": []}, {}),
        ({"odds_ticks": [("1", "m", "b", True), ("1", "m", "b", True), ("1", "m", "c", False)]}, {("multiple_openers", "odds_ticks"): 1, ("missing_opener", "odds_ticks"): 1}),
        ({"statcast_pitches": [("1", 1, 1), ("1", 1, 1), ("7", 1, 1)]}, {("duplicate_pitch_key", "statcast_pitches"): 2, ("orphan_game_pk", "statcast_pitches"): 1}),
        ({"statcast_games": [("1", "complete", 5), ("8", "complete", 1)]}, {("pitch_row_count_mismatch", "statcast_games"): 2}),
    ],
)
def test_validation(spark, change, expected):
    found = {(r["check"], r["table"]): r["rows"] for r in validate(tables(spark, **change)).collect()}
    assert found == {k: n for k, n in expected.items() if n}


def test_all_checks_scan_a_table_once(spark, tmp_path):
    for name, df in tables(spark).items():
        df.write.parquet(f"{tmp_path}/{name}")
    plan = validate({n: spark.read.parquet(f"{tmp_path}/{n}") for n in tables(spark)})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 8 and plan.count("Exchange ") <= 5 and "Join" not in plan


def test_verdicts_are_those_of_joins(spark):
    """Against pairs of rows by hand, with repeated keys, NULLs and sides of one team."""
    rnd = random.Random(3)
    pick = lambda *of: rnd.choice(of)
    pk = lambda: pick("1", "2", "3", "4", None)
    games = [(pk(), True, pick(1, 2, None), pick(1, 2, None), 3, pick(8, 9, 10, None), "H", "A") for _ in range(9)]
    teams = [(pk(), pick("H", "A", None), pick("H", "A"), pick(True, False, None), pick(1, 2, None), pick(1, 2, None), pick(24, 25, 26, 27, None)) for _ in range(40)]
    arms = [(pk(), pick("H", "A"), pick(True, False, None), pick(12, 13, None)) for _ in range(30)]
    marks = [(pk(), pick("complete", "no_data"), pick(0, 3, 4, None)) for _ in range(30)]
    pitches = [(pk(), pick(1, 2, None), pick(1, 2, 3)) for _ in range(25)]
    ticks = [(pk(), pick("m", None), pick("b", "c"), pick(True, False, False, None)) for _ in range(25)]
    same = lambda a, b: a is not None and a == b
    pairs = [(t, g) for t in teams for g in games if same(t[0], g[0])]
    sums: dict = {}
    for game, team, _, outs in arms:
        sums[game, team] = sums.get((game, team), 0) + (outs or 0)
    known, keyed, quoted = {g[0] for g in games} - {None}, Counter(pitches), {}
    for *key, opener in ticks:
        quoted[tuple(key)] = quoted.get(tuple(key), 0) + bool(opener)
    per_game = Counter(p[0] for p in pitches if p[0] is not None)
    want = {
        ("duplicate_game_pk", "games"): sum(n - 1 for n in Counter(g[0] for g in games).values()),
        ("wrong_row_count", "team_games"): sum(n != 2 for n in Counter(t[0] for t in teams).values()),
        ("outs_inconsistent_with_innings", "team_games"): sum(None not in (t[6], g[5]) and not 3 * (g[5] - 1) <= t[6] <= 3 * g[5] for t, g in pairs),
        ("runs_not_reciprocal", "team_games"): sum(same(a[0], b[0]) and same(a[1], b[2]) and not same(a[4], b[5]) for a in teams for b in teams),
        ("runs_disagree_with_games", "team_games"): sum(g[2] is not None and not same(t[4], g[2] if t[3] else g[3]) for t, g in pairs),
        ("orphan_game_pk", "team_games"): sum(t[0] not in known for t in teams),
        ("wrong_starter_count", "pitcher_appearances"): sum(n != 1 for n in Counter(a[:2] for a in arms if a[2]).values()),
        ("outs_disagree_with_team_game", "pitcher_appearances"): sum(t[0] is not None and t[:2] in sums and t[6] != sums[t[:2]] for t in teams),
        ("multiple_openers", "odds_ticks"): sum(n > 1 for n in quoted.values()),
        ("missing_opener", "odds_ticks"): sum(n == 0 for n in quoted.values()),
        ("duplicate_pitch_key", "statcast_pitches"): sum(n for n in keyed.values() if n > 1),
        ("orphan_game_pk", "statcast_pitches"): sum(p[0] not in known for p in pitches),
        ("pitch_row_count_mismatch", "statcast_games"): sum(m[1] == "complete" and m[2] is not None and m[2] != per_game[m[0]] for m in marks),
        ("missing_home_plate_umpire", "umpires"): sum(g[0] != "1" for g in games),
    }
    given = tables(spark, games=games, team_games=teams, pitcher_appearances=arms, statcast_games=marks, statcast_pitches=pitches, odds_ticks=ticks)
    found = {(r["check"], r["table"]): r["rows"] for r in validate(given).collect()}
    assert {k: found.get(k, 0) for k in want} == want and sum(map(bool, want.values())) >= 13


def test_checks_are_named_and_counts_compare(spark):
    assert len(checks()) == 26
    a, b = (spark.createDataFrame(rows, "table string, rows long") for rows in ([("x", 1), ("y", 2)], [("x", 1), ("z", 3)]))
    assert {r["table"]: r["matches"] for r in compare_counts(a, b).collect()} == {"x": True, "y": False, "z": False}


def test_mirror(spark):
    old = spark.createDataFrame([(1, "b", "Bee"), (5, "z", "Zed")], "book_id int, slug string, name string")
    ticks = spark.createDataFrame([("1", 2025, "totals", s) for s in ("b", "new_one", "a", "a")], "game_pk string, season_year int, market string, book_slug string").withColumns({"line_ts": F.lit("2025-06-01").cast("timestamp"), "game_date": F.lit(DAY)})
    books = mirror.books(old, ticks)
    assert sorted(tuple(r) for r in books.collect()) == [(1, "b", "Bee"), (5, "z", "Zed"), (6, "a", "A"), (7, "new_one", "New One")]
    lines = mirror.lines(ticks, books)
    assert sorted(r["book_id"] for r in lines.collect()) == [1, 6, 6, 7] and {r["market_id"] for r in lines.collect()} == {1}
    assert mirror.new_lines(lines.where("book_id = 1"), lines).count() == 3
    with pytest.raises(Exception, match="unmapped book_slug"):
        mirror.lines(ticks, old).collect()


def test_archive(spark, tmp_path):
    for year in (2023, 2024, 2025):
        spark.range(year - 2020).coalesce(1).write.parquet(f"{tmp_path}/games/season_year={year}")
    files = archive.discover(spark, str(tmp_path), 2025)
    assert sorted(r["season"] for r in files.collect()) == [2023, 2024]
    total = archive.manifest(files).first()
    assert (total["object_count"], total["row_count"]) == (2, 7) and total["byte_count"] > 0
    remote = files.where("season = 2023").unionByName(files.where("season = 2024").withColumn("sha256", F.lit("x")))
    assert sorted(r["action"] for r in archive.classify_uploads(files, remote).collect()) == ["changed", "skip"]
    assert sorted(r["action"] for r in archive.classify_uploads(files, remote.where("season = 2023")).collect()) == ["skip", "upload"]
    assert archive.mutated(files, remote).count() == 1


def test_snapshots(spark, tmp_path):
    heads, data = f"{tmp_path}/h", f"{tmp_path}/d"
    rows = spark.createDataFrame([("p1",), ("p2",)], "player_id string")
    snapshots.write_capture(heads, data, "lineups", "2025-06-01", "2025-06-01 12:00:00", rows)
    snapshots.write_capture(heads, data, "lineups", "2025-06-01", "2025-06-01 15:00:00", rows.limit(1))
    snapshots.write_capture(heads, data, "lineups", "2025-06-02", "2025-06-01 15:00:00", rows.limit(0))
    h, d = spark.read.parquet(heads), spark.read.parquet(f"{data}/lineups")
    seen = lambda when: snapshots.as_of(h, d, F.lit(when).cast("timestamp")).collect()
    assert len(seen("2025-06-01 15:00:00")) == 2 and len(seen("2025-06-01 12:00:00")) == 0
    late = {str(r["slate_date"]): (r["player_id"] is None, r["snapshot_was_empty"]) for r in seen("2025-06-01 16:00:00")}
    assert late == {"2025-06-01": (False, False), "2025-06-02": (True, True)}
    dates = snapshots.missing_snapshot_dates(h, "lineups", F.lit("2025-06-01").cast("date"), F.lit("2025-06-04").cast("date"))
    assert sorted(str(r[0]) for r in dates.collect()) == ["2025-06-03", "2025-06-04"]
    assert snapshots.coverage(h).first()["n_empty"] == 1


def test_features_never_see_the_row_itself(spark):
    rows = [("t", str(i), dt.datetime(2025, 6, i, 12), dt.date(2025, 6, i), float(i)) for i in range(1, 7)]
    df = spark.createDataFrame(rows, "team_id string, game_pk string, first_pitch_utc timestamp, game_date date, runs double")
    got = [r["runs_BEFORE"] for r in features.rolling_before(df, ["team_id"], ["first_pitch_utc"], "runs", 3).orderBy("game_pk").collect()]
    assert got == [None, 1.0, 1.5, 2.0, 3.0, 4.0]
    heavy = [r["w"] for r in features.weighted_before(df, ["team_id"], ["first_pitch_utc"], "runs", 2, "w").orderBy("game_pk").collect()]
    assert heavy == [None, 1.0, 5 / 3, 8 / 3, 11 / 3, 14 / 3]
    three = [r["s"] for r in features.days_before(df, ["team_id"], "first_pitch_utc", "runs", 3, "s").orderBy("game_pk").collect()]
    assert three == [0.0, 1.0, 3.0, 6.0, 9.0, 12.0]
    arms = df.selectExpr("team_id", "game_pk", "game_date", "game_pk = '3' as is_starter", "cast(runs as int) as pitches_thrown")
    load = [r["relief_pitches_BEFORE"] for r in features.bullpen_load(arms).orderBy("game_pk").collect()]
    assert load == [0, 1, 3, 3, 6, 9]


def test_slate_dates(spark):
    now = F.lit("2025-08-02 02:30:00").cast("timestamp")
    assert [str(r[0]) for r in snapshots.capture_dates(spark, now, 2).collect()] == ["2025-08-01", "2025-08-02", "2025-08-03"]


def test_closing_outcomes(spark):
    schema = "game_pk string, market string, book_slug string, line_ts timestamp, is_pregame boolean, left_line smallint, left_price smallint, right_line smallint, right_price smallint"
    rows = [
        ("1", "totals", "b", at(10), True, 17, -110, 17, -110), ("1", "totals", "b", at(12), True, 18, -110, 18, -110), ("1", "totals", "b", at(23), False, 30, 100, 30, 100),
        ("1", "run_line", "b", at(10), True, 3, 150, -3, -170), ("1", "money_line", "b", at(10), True, None, 120, None, -140),
    ]
    games = spark.createDataFrame([("1", True, 10, 1)], "game_pk string, is_final boolean, total_runs int, run_line_margin int")
    got = {r["market"]: r for r in outcomes.closing_outcomes(spark.createDataFrame(rows, schema), games).collect()}
    assert (got["totals"]["residual"], got["totals"]["left_won"], got["totals"]["fair_left"]) == (1.0, True, 0.5)
    assert (got["run_line"]["residual"], got["run_line"]["left_won"]) == (-0.5, True)
    assert got["money_line"]["residual"] is None and got["money_line"]["left_won"] is False and got["money_line"]["overround"] > 0
    report = {r["market"]: r for r in outcomes.orientation_report(outcomes.closing_outcomes(spark.createDataFrame(rows, schema), games)).collect()}
    assert report["totals"]["n"] == 1 and report["totals"]["realised_left"] == 1.0
