import json
import os
import re
import socket
import time

import pytest

from pitlake.sources import store as module
from pitlake.sources.store import Store

GAMES = "game_pk string, season_year int, game_date string, game_type string, is_final boolean, home_team_id string, away_team_id string, home_score int, seq int"
LINEUPS = "game_pk string, team_id string, player_id string, season_year int, game_date string"


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def games(spark, rows):
    return spark.createDataFrame([(pk, y, f"{y}-06-01", "R", True, "1", "2", score, i) for i, (pk, y, score) in enumerate(rows)], GAMES)


def scores(store, *seasons):
    return {(r["game_pk"], r["season_year"]): r["home_score"] for r in store.read("games", seasons or None).collect()}


def test_upsert_replaces_and_keeps_other_partitions(spark, store):
    assert store.upsert("games", games(spark, [("1", 2024, 5), ("2", 2025, 3)])) == 2
    assert store.upsert("games", games(spark, [("2", 2025, 4), ("3", 2025, 1)])) == 2
    assert scores(store) == {("1", 2024): 5, ("2", 2025): 4, ("3", 2025): 1}
    assert scores(store, 2024) == {("1", 2024): 5} and scores(store, 1999) == {}
    assert store.partitions("games") == ["2024", "2025"]


def test_upsert_is_idempotent_and_the_last_of_a_batch_wins(spark, store):
    batch = games(spark, [("1", 2024, 5), ("1", 2024, 6), ("1", 2024, 7)])
    for _ in range(2):
        assert store.upsert("games", batch, ordinal="seq") == 1
        assert scores(store) == {("1", 2024): 7}


def test_bad_batches(spark, store):
    with pytest.raises(ValueError, match="game_pk"):
        store.upsert("games", games(spark, [("1", 2024, 5)]).drop("game_pk"))
    with pytest.raises(Exception, match="season_year is NULL"):
        store.upsert("games", games(spark, [("1", 2024, 5)]).selectExpr("game_pk", "cast(null as int) season_year", "game_date", "game_type", "is_final", "home_team_id", "away_team_id"))
    assert store.upsert("games", None) == 0 and store.upsert("games", games(spark, [("1", 2024, 1)]).limit(0)) == 0
    with pytest.raises(ValueError):
        store.game_ids("venues", 2024)


def test_replace_children(spark, store):
    rows = spark.createDataFrame([("1", "a", p, 2025, "2025-06-01") for p in ("10", "11")] + [("2", "a", "20", 2025, "2025-06-01")], LINEUPS)
    store.upsert("lineups", rows)
    fresh = spark.createDataFrame([("1", "a", "12", 2025, "2025-06-01"), ("9", "a", "1", 2025, "2025-06-01")], LINEUPS)
    parents = spark.createDataFrame([("1",)], "game_pk string")
    assert store.replace_children("lineups", fresh, parents, 2025) == 1
    players = lambda: sorted(r["player_id"] for r in store.read("lineups").collect())
    assert players() == ["12", "20"]
    assert store.replace_children("lineups", fresh.limit(0), spark.createDataFrame([("1",), ("2",)], "game_pk string"), 2025) == 0
    assert players() == [] and store.partitions("lineups") == []


def test_insert_only_and_rewrite(spark, store):
    store.upsert("games", games(spark, [("1", 2024, 5)]))
    assert store.insert_only("games", games(spark, [("1", 2024, 9), ("2", 2024, 2)])) == 1
    assert scores(store) == {("1", 2024): 5, ("2", 2024): 2}
    store.rewrite("games", games(spark, [("7", 2024, 7)]), 2024)
    assert scores(store) == {("7", 2024): 7}


def test_a_lock_keeps_writers_apart(spark, store):
    with store._lock(store.tables["games"]), pytest.raises(RuntimeError, match="being written"):
        store.upsert("games", games(spark, [("1", 2024, 5)]))
    assert store.upsert("games", games(spark, [("1", 2024, 5)])) == 1


def test_summary_and_pruning(spark, store):
    store.upsert("games", games(spark, [("1", 2024, 5), ("2", 2025, 3)]))
    found = {r["table"]: r for r in store.summary().collect()}
    assert (found["games"]["n_rows"], found["games"]["n_partitions"], found["games"]["last_partition"]) == (2, 2, 2025) and found["venues"]["n_rows"] == 0
    plan = store.read("games", [2024])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*season_year#\d+ = 2024", plan)
    assert [r[0] for r in store.game_ids("games", 2025).collect()] == ["2"]


# -- crashes, locks and versions -----------------------------------------------------------


def leave_lock(store, table, **owner):
    """The lock of a writer that has been killed."""
    path = store.root + f"/_lock_{table}"
    with open(path, "w") as f:
        f.write(json.dumps({"owner": "x", "host": socket.gethostname(), "pid": 2**22 + 17, "time": time.time(), **owner}))
    return path


class Killed(BaseException):
    pass


@pytest.mark.parametrize("step", ["_add_files", "_announce"])
def test_a_writer_killed_before_it_publishes_changes_nothing(spark, store, step, monkeypatch):
    """Files are written or half written and the lock stays; readers see the old rows, the next writer goes on."""
    store.upsert("games", games(spark, [("1", 2024, 5), ("2", 2024, 6)]))
    reader, live = store.read("games"), set(store.version("games").files)
    real = getattr(Store, step)

    def killed(self, *args):
        if step == "_add_files":
            real(self, *args)
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(Store, step, killed)
        with pytest.raises(Killed):
            store.upsert("games", games(spark, [("2", 2024, 9), ("3", 2024, 1)]))
    leave_lock(store, "games")
    again = Store(spark, store.root)
    assert scores(again) == {("1", 2024): 5, ("2", 2024): 6} and set(again.version("games").files) == live
    assert len(again._on_disk(again.tables["games"])) > len(live)  # what it left is there, and in no version
    left = len(again._on_disk(again.tables["games"])) - len(live)
    assert again.recover(older_than=-60)["games"] == {"locks": 1, "files": left}
    assert not os.path.exists(store.root + "/_lock_games") and set(again._on_disk(again.tables["games"])) == live
    assert again.upsert("games", games(spark, [("2", 2024, 9), ("3", 2024, 1)])) == 2
    assert scores(again) == {("1", 2024): 5, ("2", 2024): 9, ("3", 2024): 1}
    assert {r["game_pk"] for r in reader.collect()} == {"1", "2"}  # a reader keeps the version it began with


def test_locks_of_the_dead_are_taken_away_and_those_of_the_living_are_not(spark, store):
    store.upsert("games", games(spark, [("1", 2024, 5)]))
    leave_lock(store, "games")  # no such process
    assert store.upsert("games", games(spark, [("1", 2024, 6)])) == 1
    for alive in ({"pid": os.getpid()}, {"host": "elsewhere"}):
        path = leave_lock(store, "games", **alive)
        with pytest.raises(RuntimeError, match="being written"):
            store.upsert("games", games(spark, [("1", 2024, 7)]))
        assert store.recover() == {} and os.path.exists(path)
        os.utime(path, (0, 0))  # held for years
        assert store.upsert("games", games(spark, [("1", 2024, 8)])) == 1
    assert scores(store) == {("1", 2024): 8}


def test_a_writer_whose_lock_was_taken_cannot_undo_the_other(spark, store, monkeypatch):
    store.upsert("games", games(spark, [("1", 2024, 5)]))
    slow, real = Store(spark, store.root), Store._add_files

    def overtaken(self, spec, rows):
        added = real(self, spec, rows)
        if self is slow:
            self._break(spec)  # thought dead
            store.upsert("games", games(spark, [("1", 2024, 7)]))
        return added

    monkeypatch.setattr(Store, "_add_files", overtaken)
    with pytest.raises(OSError, match="another writer"):
        slow.upsert("games", games(spark, [("1", 2024, 6)]))
    assert scores(store) == {("1", 2024): 7}


def test_superseded_files_stay_for_one_version_and_then_go(spark, store):
    for score in range(5):
        before = store.read("games") if score else None
        store.upsert("games", games(spark, [("1", 2024, score)]))
        if before is not None:
            assert [r["home_score"] for r in before.collect()] == [score - 1]
    spec = store.tables["games"]
    assert len(store._numbers(spec)) == 2 and store.version("games").number == 5
    assert len(store._on_disk(spec)) == 2 and scores(store) == {("1", 2024): 4}


def test_a_folder_of_plain_files_becomes_a_table(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = games(spark, [("1", 2024, 5), ("2", 2025, 3)])
    rows.withColumn("game_date", rows["game_date"].cast("date")).drop("seq").write.partitionBy("season_year").parquet(str(tmp_path / "games"))
    assert store.version("games").number == 0 and store.partitions("games") == ["2024", "2025"]
    store.upsert("games", games(spark, [("2", 2025, 4)]))
    assert {r["game_pk"]: r["home_score"] for r in store.read("games").select("game_pk", "home_score").collect()} == {"1": 5, "2": 4}


@pytest.fixture
def wide(spark, store):
    """A season of 100 files."""
    rows = [(f"{i:04d}", 2024, f"2024-{i // 84 + 4:02d}-{i % 84 // 3 + 1:02d}", "R", True, "1", "2", 0, 0) for i in range(500)]
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.upsert("games", spark.createDataFrame(rows, GAMES))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return store


def test_one_game_of_a_large_season_rewrites_one_file(spark, wide, monkeypatch):
    monkeypatch.setattr(module, "SMALL_FILES", 1000)
    before = wide.version("games").files
    assert len(before) > 90
    assert wide.upsert("games", games(spark, [("0123", 2024, 9)])) == 1
    after = wide.version("games").files
    assert len(set(before) - set(after)) == 1 and len(set(after) - set(before)) == 1
    assert wide.read("games").count() == 500 and scores(wide)[("0123", 2024)] == 9
    # a new game and rows inserted touch no file at all; another date is no other key
    moved = games(spark, [("0124", 2024, 3)]).selectExpr("game_pk", "season_year", "'2024-12-01' game_date", "game_type", "is_final", "home_team_id", "away_team_id", "home_score")
    for batch, gone, write in ((games(spark, [("9999", 2024, 1)]), 0, wide.upsert), (games(spark, [("0007", 2024, 7), ("8888", 2024, 1)]), 0, wide.insert_only), (moved, 1, wide.upsert)):
        live = set(wide.version("games").files)
        assert write("games", batch) == 1
        assert len(live - set(wide.version("games").files)) == gone
    assert wide.read("games").count() == 502 and scores(wide)[("0007", 2024)] == 0 and scores(wide)[("0124", 2024)] == 3
    assert wide.read("games").where("game_pk = '0124'").count() == 1
    many = spark.createDataFrame([(f"{i:04d}", 2024, "2024-06-01", "R", True, "1", "2", 5, 0) for i in range(100, 700)], GAMES)  # more keys than are pushed one by one
    assert wide.upsert("games", many) == 600 and sum(v == 5 for v in scores(wide).values()) == 600


def test_many_small_files_are_written_as_one(spark, wide):
    assert wide.upsert("games", games(spark, [("9999", 2024, 1)])) == 1
    assert len(wide.version("games").files) <= 4 and wide.read("games").count() == 501
    assert sum(rows for rows, _ in wide.version("games").files.values()) == 501


def test_files_of_rows_are_told_without_work_on_each_row(spark):
    """Rows are counted by the path that Spark has; it is cut once a file."""
    assert "regexp" not in str(module._file())
    assert module._within("file:/tmp/x%20y/transactions/season_year=1997/part-0.parquet") == "season_year=1997/part-0.parquet"
