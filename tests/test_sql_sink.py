import dataclasses
import sqlite3

import pytest
from pyspark.sql.types import IntegerType, StructField, StructType

from pitlake.plans.mirror_sync import sync_sql
from pitlake.settings import Settings, database_url
from pitlake.sources import sql_sink
from pitlake.sources.catalog import TABLES
from pitlake.sources.store import Store
from pitlake.sources.sql_sink import SqlTarget, SqlWriter, collided, create_statement, create_tables, drop_tables, quoted, upsert_sql


def opened(path):
    """A function that tasks can take along, whatever they can import."""
    return lambda: sqlite3.connect(path, timeout=0.05)


@pytest.fixture
def path(tmp_path):
    path = str(tmp_path / "db.sqlite")
    db = sqlite3.connect(path)
    db.execute("CREATE TABLE games (game_pk TEXT NOT NULL, season INT NOT NULL, runs INT, note TEXT, PRIMARY KEY (game_pk, season))")
    db.execute("INSERT INTO games VALUES ('1', 2024, 5, 'old'), ('2', 2024, 6, 'old')")
    db.commit()
    db.close()
    return path


def target(path, **how):
    return SqlTarget(opened(path), "games", ("game_pk", "season"), mark="?", retryable=lambda error: "locked" in str(error), tries=12, backoff=0.02, **how)


def rows(path):
    db = sqlite3.connect(path)
    try:
        return db.execute("SELECT * FROM games ORDER BY season, CAST(game_pk AS INT)").fetchall()
    finally:
        db.close()


def tables(path):
    db = sqlite3.connect(path)
    try:
        return [r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table'")]
    finally:
        db.close()


@pytest.mark.parametrize("whole", [False, True])
@pytest.mark.parametrize("policy", ["update", "nothing"])
def test_upsert(spark, path, policy, whole):
    """Columns that the table lacks are left out, those that the frame lacks stay; again changes nothing."""
    df = spark.createDataFrame([("1", 2024, float("nan"), 1), ("3", 2024, 7.0, 1)], "game_pk string, season int, runs double, extra int")
    for _ in range(2):
        assert upsert_sql(df, target(path, policy=policy), 3, whole) == ["game_pk", "season", "runs"]
        assert rows(path) == [("1", 2024, None if policy == "update" else 5, "old"), ("2", 2024, 6, "old"), ("3", 2024, 7, None)]
    upsert_sql(df.where("false"), target(path), 3, whole)
    assert len(rows(path)) == 3 and tables(path) == ["games"]


def test_many_rows_and_collisions(spark, path):
    """Four writers of one file collide; each batch is tried again and none is lost."""
    df = spark.range(20_000).selectExpr("cast(id as string) as game_pk", "2025 as season", "cast(id % 9 as int) as runs")
    upsert_sql(df, target(path), 4)
    assert [r[:3] for r in rows(path)[2:]] == [(str(i), 2025, i % 9) for i in range(20_000)]


@pytest.mark.parametrize("bad", [("3", None), (None, 2025), ("1", 2025)])
def test_whole_or_not_at_all(spark, path, bad):
    """NULL in a key, or a key that comes twice, fails; with ``whole`` no row is seen and no stage is left."""
    df = spark.createDataFrame([*((str(i), 2025, 1) for i in range(2000)), (*bad, 2)], "game_pk string, season int, runs int")
    with pytest.raises(Exception, match="NULL in the key|more than once"):
        upsert_sql(df, target(path), 2, whole=True)
    assert len(rows(path)) == 2 and tables(path) == ["games"]


def test_what_is_not_there(spark, path):
    df = spark.createDataFrame([("1", 1)], "game_pk string, runs int")
    with pytest.raises(ValueError, match="season"):
        upsert_sql(df, target(path))
    with pytest.raises(sqlite3.OperationalError, match="no such table"):
        upsert_sql(df, SqlTarget(opened(path), "none", ("game_pk",), mark="?"))
    for wrong in ({"policy": "replace"}, {"tries": 0}):
        with pytest.raises(ValueError):
            SqlTarget(opened, "games", ("game_pk",), **wrong)


class Database:
    """Remembers what it is asked, and fails as often as it is told."""

    def __init__(self, failures, state="40001"):
        self.failures, self.state, self.asked, self.rolled = failures, state, [], 0

    def cursor(self):
        return self

    def execute(self, statement, values):
        self.asked.append((statement, values))
        if self.failures:
            self.failures -= 1
            error = RuntimeError("failed")
            error.sqlstate = self.state
            raise error

    def commit(self):
        pass

    def rollback(self):
        self.rolled += 1

    def close(self):
        pass


def test_statements_and_tries(monkeypatch):
    waits = []
    monkeypatch.setattr(sql_sink.time, "sleep", waits.append)
    db = Database(4)
    one = SqlTarget(lambda: db, "odds.line", ("a",))
    done = SqlWriter(one, ["a", 'b"'], None).write(iter([(i, i) for i in range(1001)]))
    assert (done.rows, done.batches, done.collisions) == (1001, 3, 4)
    assert waits == [0.1, 0.2, 0.4, 0.8] and db.rolled == 4
    assert db.asked[-1] == ('INSERT INTO "odds"."line" ("a", "b""") VALUES (%s, %s) ON CONFLICT ("a") DO UPDATE SET "b""" = EXCLUDED."b"""', (1000, 1000))
    assert SqlWriter(one, [f"c{i}" for i in range(90)] + ["a"], None).size == 219  # 20,000 values a statement
    assert one.insert(["a"], 1).endswith("DO NOTHING")  # there is nothing but the key
    for failing in (Database(5), Database(1, "23505")):
        with pytest.raises(RuntimeError):
            one.run(failing, "x")
    assert collided(type("E", (Exception,), {"pgcode": "40001"})()) and not collided(ValueError()) and quoted("a.b") == '"a"."b"'


def test_tables_of_the_catalogue(tmp_path):
    """Each table can be created, again changes nothing; nullable columns are added, others refused."""
    path = str(tmp_path / "db.sqlite")
    assert create_tables(TABLES, opened(path), mark="?") == create_tables(TABLES, opened(path), mark="?") == {}
    assert set(tables(path)) == set(TABLES)
    assert 'PRIMARY KEY ("game_pk", "market", "book_slug", "line_ts")' in create_statement(TABLES["odds_ticks"])
    assert '"odds"."odds_ticks"' in create_statement(TABLES["odds_ticks"], "odds.odds_ticks")

    class Grown:
        name, key = "games", TABLES["games"].key

        def __init__(self, nullable):
            self.schema = StructType([*TABLES["games"].schema.fields, StructField("wind", IntegerType(), nullable)])

    with pytest.raises(ValueError, match="games.wind"):
        create_tables({"games": Grown(False)}, opened(path), mark="?")
    assert create_tables({"games": Grown(True)}, opened(path), mark="?") == {"games": ["wind"]}
    drop_tables({"games": TABLES["games"]}, opened(path))
    assert set(tables(path)) == set(TABLES) - {"games"}


def test_store_to_database(spark, tmp_path):
    path, store = str(tmp_path / "db.sqlite"), Store(spark, str(tmp_path / "store"))
    some = {"integer": "2025", "date": "date'2025-06-01'", "timestamp": "timestamp'2025-06-01 12:00:00'"}
    rest = [f"cast({some.get(f.dataType.typeName(), 1)} as {f.dataType.simpleString()}) as {f.name}" for f in TABLES["odds_fetches"].schema if f.name != "game_pk"]
    given = spark.range(300).selectExpr("cast(id as string) as game_pk", *rest)
    store.upsert("odds_fetches", given)
    create_tables({"odds_fetches": TABLES["odds_fetches"]}, opened(path), mark="?")
    how = {"mark": "?", "adapt": lambda v: v.isoformat() if hasattr(v, "isoformat") else v, "retryable": lambda e: "locked" in str(e), "tries": 12, "backoff": 0.02}
    for _ in range(2):
        assert sync_sql(store, opened(path), [2025], ["odds_fetches"], 2, True, **how) == {"odds_fetches": 300}
    db = sqlite3.connect(path)
    assert db.execute("SELECT count(*), count(DISTINCT game_pk), min(season_year) FROM odds_fetches").fetchone() == (300, 300, 2025)
    db.close()
    assert sync_sql(store, opened(path), [2024], ["odds_fetches"], **how) == {"odds_fetches": 0}


def test_database_url():
    here = dataclasses.replace(Settings(), database="postgresql://me:old@host:5432/db?sslmode=require")
    assert database_url(here, {}) == here.database
    assert database_url(here, {"PITLAKE_DATABASE_PASSWORD": "p@/"}) == "postgresql://me:p%40%2F@host:5432/db?sslmode=require"
    assert database_url(here, {"PITLAKE_DATABASE_URL": "sqlite:///x"}) == "sqlite:///x"
    for wrong in (Settings(), dataclasses.replace(here, database="host/db")):
        with pytest.raises(ValueError):
            database_url(wrong, {})
