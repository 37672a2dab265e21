import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pitlake.plans.pages import Folder, Manners, PageError, days_between, fetch_pages, landed_folder, reasons, scrape_dates, scrape_events


def page(body):
    return f'<html><script id="__NEXT_DATA__" type="application/json">{json.dumps(body)}</script></html>'


def view(event, start="2025-06-01T23:05:00Z"):
    return {"gameId": event, "startDate": start, "awayTeam": {"fullName": "A"}, "homeTeam": {"fullName": "B"}}


def day_page(*events):
    return page({"props": {"pageProps": {"oddsTables": [{"oddsTableModel": {"gameRows": [{"gameView": view(e)} for e in events]}}]}}})


def history(event):
    return page({"props": {"pageProps": {"lineHistoryModel": {"sportsbooks": [], "lineHistory": {"gameView": view(event), "oddsViews": []}}}}})


def test_folder_and_reasons(spark, tmp_path):
    (tmp_path / "1.html").write_text("é one")
    (tmp_path / "2.html").write_bytes(b"\xff\xfe")
    keys = spark.createDataFrame([("1", 0), ("1", 1), ("2", 0), ("3", 0), (None, 0), ("../1", 0), ("", 0)], "id string, other int")
    got = fetch_pages(keys, "id", landed_folder(spark, str(tmp_path)), tasks=2)
    found = {r["key"]: (r["payload"], r["reason"]) for r in got.collect()}
    assert found == {"1": ("é one", None), "2": (None, "not_utf8"), "3": (None, "not_found"), None: (None, "no_key"), "../1": (None, "bad_key"), "": (None, "bad_key")}
    assert [tuple(r) for r in reasons(got).collect()] == [("bad_key", 2), ("no_key", 1), ("not_found", 1), ("not_utf8", 1)]
    assert fetch_pages(keys.where("false"), "id", Folder("x")).count() == 0
    with pytest.raises(Exception, match="page 3: not_found"):
        fetch_pages(keys.where("id = '3'"), "id", landed_folder(spark, str(tmp_path)), "raise").collect()
    with pytest.raises(ValueError):
        fetch_pages(keys, "id", Folder("x"), "ignore")
    with pytest.raises(ValueError):
        Manners(tries=0)


def test_tries(spark):
    """A page that fails for now is tried again, one that is gone is not."""

    def flaky(log):
        def fetch(key):
            log[key] = log.get(key, 0) + 1
            if key == "gone":
                raise PageError("gone")
            if log[key] < int(key):
                raise PageError("busy", transient=True)
            return key

        return fetch

    keys = spark.createDataFrame([("1",), ("3",), ("4",), ("gone",)], "id string")
    got = fetch_pages(keys, "id", flaky({}), tasks=1, manners=Manners(tries=3, backoff=0.01)).collect()
    assert {r["key"]: (r["reason"], r["tries"]) for r in got} == {"1": (None, 1), "3": (None, 3), "4": ("busy", 3), "gone": ("gone", 1)}


def test_events_and_days(spark, tmp_path):
    slates, histories = tmp_path / "days", tmp_path / "events"
    slates.mkdir()
    histories.mkdir()
    (slates / "2025-06-01.html").write_text(day_page(7, 8))
    (slates / "2025-06-02.html").write_text(day_page())
    (slates / "2025-06-04.html").write_text(day_page(9, 7))
    (histories / "7.html").write_text(history(7))
    (histories / "8.html").write_text("<html>no data</html>")
    days = days_between(spark, F.lit("2025-06-01").cast("date"), F.lit("2025-06-04").cast("date"))
    assert [r[0] for r in days.orderBy("day").collect()] == [dt.date(2025, 6, d) for d in range(1, 5)]
    assert days_between(spark, F.lit("2025-06-02").cast("date"), F.lit("2025-06-01").cast("date")).count() == 0
    back = (landed_folder(spark, str(slates)), landed_folder(spark, str(histories)))
    got = {r["key"]: (r["event_id"], r["reason"]) for r in scrape_dates(days, *back).collect()}
    assert got == {"7": (7, None), "8": (None, "no_json"), "9": (None, "not_found"), "2025-06-03": (None, "not_found")}
    assert [(r["event_id"], r["season_year"]) for r in scrape_events(spark.range(7, 8), back[1], "id", "raise").collect()] == [(7, 2025)]
    with pytest.raises(Exception, match="not_found"):
        scrape_dates(days, *back, on_error="raise").collect()


def test_pages_are_dealt_out_though_their_keys_are_small(spark):
    """Adaptive execution would put all keys, and so all pages, into one task and one file."""
    got = fetch_pages(spark.range(200), "id", lambda key: "x" * 10)
    tasks = got.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(tasks) == 4 and sum(r["count"] for r in tasks) == 200
