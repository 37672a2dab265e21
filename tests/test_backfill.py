"""Backfill in batches, jobs over landing folders, captures and the mirror's end."""

import json

import pytest
from pyspark.sql import functions as F

from pitlake import jobs
from pitlake.plans import backfill, ingest, mirror_sync
from pitlake.settings import Settings
from pitlake.sources.store import Store

from test_operations import batters, box, listed, schedule


@pytest.fixture
def season(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    days = {5: "2025-05-01", 6: "2025-05-02", 7: "2025-05-20", 8: "2025-06-10"}
    ingest.update_games(store, schedule(spark, *(listed(pk, day) for pk, day in days.items())), 2025)
    return store


def test_a_restart_goes_on_where_it_died(spark, season, monkeypatch):
    raw = box(spark, g5=[1], g6=[2], g7=[3], g8=None)
    write, calls = Store.replace_children, []

    def dying(self, table, df, *rest, **more):
        calls.append(table)
        if len(calls) == 7:  # the second batch, its third table
            raise OSError("lost")
        return write(self, table, df, *rest, **more)

    monkeypatch.setattr(Store, "replace_children", dying)
    with pytest.raises(OSError):
        backfill.fill_boxscores(season, raw, 2025)
    assert batters(season) == [("5", "1"), ("6", "2"), ("7", "3")] and season.read("pitcher_appearances").where("game_pk = '7'").isEmpty()
    calls[:] = ["none"] * 20
    got = backfill.fill_boxscores(season, raw, 2025)
    assert calls[20:] == ["pitcher_appearances", "umpires"] and (got.batches, got.skipped) == (1, 0)
    assert got.written["pitcher_appearances"] == 2 and got.written["team_games"] == 0
    assert [r["game_pk"] for r in ingest.missing_boxscores(season, 2025).collect()] == ["8"]
    noted = backfill.open_ledger(season).read("batches")
    assert noted.count() == 8 and noted.agg(F.sum("games")).first()[0] == 12


def test_the_oldest_come_first_and_a_done_batch_is_left(spark, season):
    raw = box(spark, g8=[4], g7=[3], g6=[2], g5=[1])
    assert backfill.fill_boxscores(season, raw, 2025, limit=0).batches == 0
    assert backfill.fill_boxscores(season, raw, 2025, limit=1).written["team_games"] == 2 and batters(season) == [("5", "1")]
    assert backfill.fill_boxscores(season, raw, 2025, limit=2, days=30).batches == 1  # the 20th of May is in the block of the 2nd
    assert batters(season) == [("5", "1"), ("6", "2"), ("7", "3")]
    bare = {"teams": json.loads(box(spark, g8=[]).first()["payload"])["teams"]}  # no officials: the game stays in the gap
    empty = spark.createDataFrame([("8", json.dumps(bare))], raw.schema)
    first, again = backfill.fill_boxscores(season, empty, 2025), backfill.fill_boxscores(season, empty, 2025)
    again_gap = [r["game_pk"] for r in ingest.missing_boxscores(season, 2025).collect()]
    assert (first.batches, again.batches, again.skipped) == (1, 0, 1) and again_gap == ["8"]
    assert backfill.fill_boxscores(season, raw, 2025).written["batter_games"] == 1  # another payload, another batch
    with pytest.raises(ValueError):
        backfill.fill_boxscores(season, raw, 2025, days=0)


def _land(folder, **files):
    for name, text in files.items():
        (folder / name).mkdir(parents=True)
        for file, payload in text.items():
            (folder / name / file).write_text(payload)


def test_backfill_and_snapshots_from_landing(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(jobs, "local_session", lambda: spark)
    land = tmp_path / "land"
    games = schedule(spark, listed(5, "2025-06-01"), listed(6, "2025-06-02"), listed(7, "2025-06-03")).first()["payload"]
    moves = json.dumps({"transactions": [{"id": 1, "date": "2025-06-02", "person": {"id": 4}}]})
    _land(land, schedule={"a.json": games}, transactions={"t.json": moves}, boxscores={f"{r['game_pk']}.json": r["payload"] for r in box(spark, g5=[1], g6=[2]).collect()})
    (land / "venues" / "2025").mkdir(parents=True)
    (land / "venues" / "2025" / "v.json").write_text(json.dumps({"venues": [{"id": 3, "name": "Park"}]}))
    (tmp_path / "s.ini").write_text(f"[pitlake]\nstore = {tmp_path}/store\nlanding = {land}\nfirst_season = 2025\n")
    use = ["--settings", str(tmp_path / "s.ini"), "--today", "2025-06-03"]
    store = Store(spark, f"{tmp_path}/store")
    assert jobs.main(["backfill", *use, "--games-only"]) == 0 and store.read("games").count() == 2 and batters(store) == []
    assert store.read("venues").count() == 1 and store.read("transactions").count() == 1
    assert jobs.main(["backfill", *use, "--limit", "1"]) == 0 and batters(store) == [("5", "1")]
    assert jobs.main(["boxscores", *use, "--seasons", "2025", "--landing", str(land / "boxscores")]) == 0 and batters(store) == [("5", "1"), ("6", "2")]
    capsys.readouterr()
    assert jobs.main(["snapshots", *use, "--coverage"]) == 0 and capsys.readouterr().out == "no captures\n"
    assert jobs.main(["snapshots", *use, "--date", "2025-06-02", "--no-rosters"]) == 0
    assert sorted(capsys.readouterr().out.splitlines()) == ["2025-06-02\tlineups\t0", "2025-06-02\tprobables\t1", "2025-06-02\ttransactions\t1"]
    assert jobs.main(["snapshots", *use, "--date", "2025-06-02"]) == 1  # no rosters have landed
    assert "rosters\tAnalysisException" in capsys.readouterr().out
    assert jobs.main(["snapshots", *use, "--coverage"]) == 0
    out = capsys.readouterr().out.splitlines()
    assert "missing\t2025-06-03" in out and "missing\t2025-06-02" not in out and len(out) == 3 + 30
    with pytest.raises(SystemExit):
        jobs.main(["snapshots", "--settings", "/nowhere", "--coverage"])


def test_the_mirror_goes_only_when_confirmed(spark, season, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(jobs, "local_session", lambda: spark)
    root = str(tmp_path / "mirror")
    mirror_sync.sync_tables(season, mirror_sync.open_mirror(spark, root), 2025)
    (tmp_path / "mirror" / "note.txt").write_text("stays")
    args = ["mirror", "--store", season.root, "--mirror", root, "--seasons", "2025", "--drop"]
    assert jobs.main([*args, "--confirm", "mirror"]) == 2 and mirror_sync.open_mirror(spark, root).read("games").count() == 4
    assert mirror_sync.drop_mirror(spark, root) == ["games", "umpires"] and mirror_sync.open_mirror(spark, root).read("games").count() == 0
    assert mirror_sync.drop_mirror(spark, root) == [] and (tmp_path / "mirror" / "note.txt").exists()
    assert Settings().discontinued_books == ()
