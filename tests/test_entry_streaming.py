import datetime as dt

import pytest

import __spark_entry__
from pitlake.plans import registry
from pitlake.sources.catalog import TABLES
from pitlake.sources.store import Store
from pitlake.streaming.ticks import distinct_ticks, read_ticks, write_ticks

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = plain(df.select(*columns).collect())
    assert got == plain(duck.execute(f'SELECT {", ".join(chr(34) + c + chr(34) for c in columns)} FROM ({registry.SQL[name]})').fetchall())
    assert got


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_no_python_in_the_queries(spark):
    for name, query in registry.QUERIES.items():
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan, name


def test_tick_stream(spark, tmp_path):
    store, source = Store(spark, str(tmp_path / "store")), str(tmp_path / "in")
    schema = TABLES["odds_ticks"].schema

    def land(*minutes):
        rows = [("1", 2025, dt.date(2025, 6, 1), "totals", "b", dt.datetime(2025, 6, 1, 12, m), -60, True, False, 17, -110, 17, -110) for m in minutes]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        q = write_ticks(distinct_ticks(read_ticks(spark, source)), store, str(tmp_path / "cp"))
        q.awaitTermination(120)
        return {r["line_ts"].minute: r["is_opener"] for r in store.read("odds_ticks").collect()}

    land(5, 9)
    assert run() == {5: True, 9: False}
    land(3, 9)  # a late tick becomes the opener, a repeat changes nothing
    assert run() == {3: True, 5: False, 9: False}
