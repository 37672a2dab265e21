import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from pitlake import jobs
from pitlake.operators.matching import nearest_match, nearest_sorted
from pitlake.plans import ingest, mirror_sync, snapshots
from pitlake.plans.validation import Check, validate
from pitlake.settings import Settings
from pitlake.sources.store import Store

NYY, BOS = {"id": 147, "name": "New York Yankees"}, {"id": 111, "name": "Boston Red Sox"}


def listed(pk, date, state="Final", official=7):
    return {
        "gamePk": pk, "officialDate": date, "gameDate": f"{date}T23:10:00Z", "gameType": "R", "status": {"abstractGameState": state},
        "teams": {"home": {"team": NYY, "score": 5}, "away": {"team": BOS, "score": 3}},
        "officials": [{"official": {"id": official, "fullName": "u"}, "officialType": "Home Plate"}],
    }


def schedule(spark, *games):
    return spark.createDataFrame([(json.dumps({"dates": [{"games": list(games)}]}), 0)], "payload string, ordinal int")


def box(spark, **games):
    """game id -> the batters of the home side; None is a payload that says nothing."""
    arm = {"person": {"id": 900}, "stats": {"batting": {}, "pitching": {"outs": 27, "gamesStarted": 1}}}

    def payload(batters):
        player = lambda i: {"person": {"id": i, "fullName": f"b{i}"}, "battingOrder": "100", "stats": {"batting": {"hits": 1, "plateAppearances": 4}, "pitching": {}}}
        side = lambda team, ids: {"team": team, "teamStats": {"batting": {"runs": 5}, "pitching": {"outs": 27}, "fielding": {}}, "players": {f"p{i}": player(i) for i in ids} | {"arm": arm}, "batters": [], "pitchers": [900]}
        return {"teams": {"home": side(NYY, batters), "away": side(BOS, [])}, "officials": [{"official": {"id": 9, "fullName": "x"}, "officialType": "First Base"}]}

    rows = [(pk[1:], "no json" if ids is None else json.dumps(payload(ids))) for pk, ids in games.items()]
    return spark.createDataFrame(rows, "game_pk string, payload string")


@pytest.fixture
def store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    ingest.update_games(store, schedule(spark, listed(5, "2025-06-01"), listed(6, "2025-06-02")), 2025)
    return store


def batters(store):
    return sorted((r["game_pk"], r["player_id"]) for r in store.read("batter_games").collect())


def test_a_corrected_box_score_replaces_the_game(spark, store):
    ingest.update_boxscores(store, box(spark, g5=[1, 2], g6=[3]), 2025, batches=3)
    assert batters(store) == [("5", "1"), ("5", "2"), ("6", "3")]
    assert ingest.update_boxscores(store, box(spark, g5=[2]), 2025)["batter_games"] == 1
    assert batters(store) == [("5", "2"), ("6", "3")]


def test_payloads_that_say_nothing_are_left_for_later(spark, store):
    raw = box(spark, g5=None, g6=[3])
    assert ingest.update_boxscores(store, raw, 2025)["team_games"] == 2
    assert [tuple(r) for r in ingest.skipped_boxscores(raw).collect()] == [("5", "no_json")]
    more = raw.unionByName(box(spark, g77=[1]))
    assert sorted(tuple(r) for r in ingest.skipped_boxscores(more, store.read("games")).collect()) == [("5", "no_json"), ("77", "unknown_game")]
    assert [r["game_pk"] for r in ingest.missing_boxscores(store, 2025).collect()] == ["5"]


def test_recent_days_replace_whole_games_in_each_season(spark, store):
    ingest.update_boxscores(store, box(spark, g5=[1, 2], g6=[3]), 2025)
    today = F.lit("2025-06-03").cast("date")
    again = schedule(spark, listed(5, "2025-06-01", official=8), listed(6, "2025-06-02", state="Live"), listed(4, "2025-05-01"))
    moves = spark.createDataFrame([(json.dumps({"transactions": [{"id": 1, "date": "2025-06-01"}]}),)], "payload string")
    written = ingest.update_recent_days(store, again, box(spark, g5=[2], g6=[4]), today, 3, moves)
    assert written == {"games": 1, "umpires": 1, "lineups": 0, "boxscore_team_games": 2, "boxscore_batter_games": 1, "boxscore_pitcher_appearances": 2, "boxscore_umpires": 1, "transactions": 1}
    assert batters(store) == [("5", "2"), ("6", "3")]
    assert "7" not in {r["official_id"] for r in store.read("umpires").where("game_pk = '5'").collect()}
    assert ingest.update_recent_days(store, again, box(spark, g5=[2]), F.lit("2030-01-01").cast("date")) == {}


def test_a_single_game_without_a_start_is_a_match(spark):
    when = dt.datetime(2025, 6, 1, 17)
    events = spark.createDataFrame([(1, "a", when), (2, "b", when), (3, "c", when), (4, "d", None)], "event_id int, k string, at timestamp")
    games = spark.createDataFrame([("g1", "a", None), ("g2", "b", None), ("g3", "b", when), ("g4", "b", None), ("g5", "d", when), ("g6", "d", when)], "game_pk string, k string, start timestamp")
    got = {r["event_id"]: (r["game_pk"], r["n_candidates"], r["reason"]) for r in nearest_match(events, games, ["k"], "event_id", "at", "start", 60, ["game_pk"]).collect()}
    assert got == {1: ("g1", 1, None), 2: ("g3", 3, None), 3: (None, 0, "no_game"), 4: ("g5", 2, "not_close")}


def test_the_sorted_match_equals_the_paired_one(spark):
    rnd = random.Random(5)
    when = lambda: None if rnd.random() < 0.15 else dt.datetime(2025, 6, 1) + dt.timedelta(minutes=rnd.randrange(12))
    key = lambda: rnd.choice(["a", "b", "c", "d", None])
    events = spark.createDataFrame([(i, key(), rnd.randrange(2), when()) for i in range(150)], "event_id int, k string, l int, at timestamp")
    games = spark.createDataFrame([(f"g{i}", key(), rnd.randrange(2), when(), rnd.choice([1, 2, None])) for i in range(25)], "game_pk string, k string, l int, start timestamp, n int")
    args = (["k", "l"], "event_id", "at", "start", 60, ["n", "game_pk"])
    for some in (games, games.where("start is null"), games.limit(0)):
        paired, merged = nearest_match(events, some, *args), nearest_sorted(events, some, *args)
        assert merged.columns == paired.columns
        assert sorted(map(str, merged.collect())) == sorted(map(str, paired.collect()))
    assert nearest_sorted(events, games, *args)._jdf.queryExecution().executedPlan().toString().count("Exchange hash") == 1


def test_many_games_of_a_key_make_no_pairs(spark):
    rnd = random.Random(8)
    when = lambda: None if rnd.random() < 0.1 else dt.datetime(2025, 6, 1) + dt.timedelta(minutes=rnd.randrange(300))
    events = [(rnd.randrange(160), rnd.choice(["a", "b", None]), when()) for _ in range(200)]  # some ids twice
    games = [(f"g{i:03}", rnd.choice(["a", "a", "c"]), when()) for i in range(120)]
    df = nearest_match(spark.createDataFrame(events, "event_id int, k string, at timestamp"), spark.createDataFrame(games, "game_pk string, k string, start timestamp"), ["k"], "event_id", "at", "start", 60, ["game_pk"])
    expected = {}
    for i in {e[0] for e in events}:
        pairs = [(abs((at - start).total_seconds()) if at and start else float("inf"), pk) for e, k, at in events if e == i for pk, there, start in games if there == k]
        far, pk = min(pairs, default=(float("inf"), None))
        expected[i] = (pk, len(pairs), "no_game" if not pairs else "not_close" if len(pairs) > 1 and far > 60 else None)
    rows = df.collect()
    assert len(rows) == len(expected) and {r["event_id"]: (r["game_pk"], r["n_candidates"], r["reason"]) for r in rows} == expected
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_columns_that_a_match_adds_replace_those_of_their_names(spark):
    """Scraped events have a reason of their own; games may have one too."""
    when = dt.datetime(2025, 6, 1, 17)
    events = spark.createDataFrame([(1, "a", when, None, 7, "x"), (2, "c", when, "old", 8, "y")], "event_id int, k string, at timestamp, reason string, n_candidates int, Delta_Seconds string")
    games = spark.createDataFrame([("g1", "a", when, "r"), ("g2", "a", None, "s")], "game_pk string, k string, start timestamp, reason string")
    for match in (nearest_match, nearest_sorted):
        df = match(events, games, ["k"], "event_id", "at", "start", 60, ["game_pk"])
        assert sorted(df.columns) == ["at", "delta_seconds", "event_id", "game_pk", "k", "n_candidates", "reason", "start"]
        got = {r["event_id"]: (r["game_pk"], r["delta_seconds"], r["n_candidates"], r["reason"]) for r in df.select("event_id", "game_pk", "delta_seconds", "n_candidates", "reason").collect()}
        assert got == {1: ("g1", 0, 2, None), 2: (None, None, 0, "no_game")}


def test_checks_name_the_tables_they_use(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    found = validate({"t": df}, [Check("null", "t", "d", F.col("x").isNull()), Check("other", "t", "d", lambda t: t["u"], uses=("u",))])
    assert [tuple(r) for r in found.collect()] == [("null", "t", 1, "d")]
    with pytest.raises(KeyError):  # a table that is not named is a mistake, and shows
        validate({"t": df}, [Check("wrong", "t", "d", lambda t: t["u"])])
    with pytest.raises(ValueError, match="no check"):
        validate({})


def test_capture_all(spark, tmp_path):
    heads, data = f"{tmp_path}/h", f"{tmp_path}/d"
    rows = spark.createDataFrame([("p1",), ("p2",)], "player_id string")

    def broken(day):
        raise OSError("no route")

    taken, failed = snapshots.capture_all(spark, heads, data, "2025-06-01 12:00:00", {"lineups": lambda day: rows if day == "2025-06-01" else rows.limit(0), "weather": broken})
    assert taken == {("lineups", "2025-06-01"): 2, ("lineups", "2025-06-02"): 0}
    assert failed == [("weather", "2025-06-01", "OSError: no route"), ("weather", "2025-06-02", "OSError: no route")]
    assert snapshots.coverage(spark.read.parquet(heads)).first()["n_empty"] == 1


def test_mirror_loads_once_and_verifies(spark, store, tmp_path):
    tick = ("5", 2025, dt.date(2025, 6, 1), "totals", "bee", dt.datetime(2025, 6, 1, 12), -60, True, True, 17, -110, 17, -110)
    store.upsert("odds_ticks", spark.createDataFrame([tick, (*tick[:4], "cee", *tick[5:])], store.tables["odds_ticks"].schema))
    games = store.read("games").where("game_pk = '5'").withColumns({"event_id": F.lit(1), "is_doubleheader": F.lit(False), "ingest_status": F.lit("complete"), "source_tick_count": F.lit(2)})
    store.upsert("odds_games", games)
    target = mirror_sync.open_mirror(spark, str(tmp_path / "mirror"))
    now = F.lit("2025-06-02 00:00:00").cast("timestamp")
    assert mirror_sync.sync_odds(store, target, 2025, now) == {"books": 2, "odds_games": 1, "odds_lines": 2, "load_meta": 1}
    assert mirror_sync.sync_odds(store, target, 2025, now) == {"books": 0, "odds_games": 0, "odds_lines": 0, "load_meta": 1}
    assert {r["slug"]: r["book_id"] for r in target.read("books").collect()} == {"bee": 1, "cee": 2}
    assert {r["table"]: r["matches"] for r in mirror_sync.verify(store, target, [2025]).collect()}["games"] is False
    mirror_sync.sync_tables(store, target, 2025)
    assert all(r["matches"] for r in mirror_sync.verify(store, target, [2025]).collect())


def test_settings(tmp_path):
    path = tmp_path / "s.ini"
    path.write_text("[pitlake]\nstore = /data\ndays_back = 5\ndiscontinued_books = a, b\n")
    got = Settings.read(str(path))
    assert (got.store, got.days_back, got.discontinued_books, got.refresh_days) == ("/data", 5, ("a", "b"), 3)
    path.write_text("[pitlake]\nstroe = x\n")
    with pytest.raises(ValueError, match="stroe"):
        Settings.read(str(path))
    with pytest.raises(ValueError):
        Settings(first_season=12)


def test_jobs(spark, store, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(jobs, "local_session", lambda: spark)
    where = ["--store", store.root, "--seasons", "2025"]
    landing = tmp_path / "box"
    landing.mkdir()
    for r in box(spark, g5=[1], g6=None).collect():
        (landing / f"{r['game_pk']}.json").write_text(r["payload"])
    assert jobs.main(["boxscores", *where, "--dry-run"]) == 0
    assert capsys.readouterr().out.split() == ["5", "2025-06-01", "6", "2025-06-02"]
    assert batters(store) == []
    assert jobs.main(["boxscores", *where, "--landing", str(landing)]) == 0 and batters(store) == [("5", "1")]
    assert jobs.main(["boxscores", *where, "--landing", str(landing), "--strict"]) == 2
    assert jobs.main(["validate", *where]) == 1 and jobs.main(["validate", *where, "--strict"]) == 2
    capsys.readouterr()
    assert jobs.main(["plan", "--store", store.root, "--today", "2025-06-03", "--refresh-only"]) == 0
    assert [line.split("\t")[0] for line in capsys.readouterr().out.splitlines()] == ["2025-06-01", "2025-06-02"]
    pitches = tmp_path / "pitches"
    spark.createDataFrame([("5", "2025-06-01", "1", "1")], "game_pk string, game_date string, at_bat_number string, pitch_number string").coalesce(1).write.option("header", True).csv(str(pitches))
    assert jobs.main(["pitches", *where, "--landing", str(pitches)]) == 0 and store.read("statcast_pitches").count() == 1
    assert jobs.main(["mirror", *where, "--mirror", str(tmp_path / "m")]) == 0 and jobs.main(["mirror", *where, "--mirror", str(tmp_path / "m"), "--verify"]) == 0
    with pytest.raises(SystemExit) as stop:
        jobs.main(["games", "--store", store.root])
    assert stop.value.code == 2


def test_row_checks_of_a_table_speak_together(spark):
    """70 checks fail on each row: two tokens of 60 bits, not 70."""
    from pitlake.plans.validation import _tokens

    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    every = [Check(f"c{i}", "t", "d", F.col("x") > i % 2) for i in range(70)]
    assert _tokens({"t": df}, every).count() == 4
    assert {(r["check"], r["rows"]) for r in validate({"t": df}, every).collect()} == {(f"c{i}", 2 - i % 2) for i in range(70)}
