import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitlake.functions import scalars as s
from pitlake.functions.teams import TEAMS, alias_table, team_table


def apply(spark, f, values, kind):
    """f over a column of values, in their order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").coalesce(1)
    return [r[0] for r in df.orderBy("i").select(f("x").alias("y")).collect()]


@pytest.mark.parametrize(
    "f,kind,pairs",
    [
        (s.as_id, "string", [(" 147 ", "147"), ("", None), (None, None)]),
        (s.as_id_number, "double", [(147.0, "147"), (float("nan"), None), (None, None)]),
        (s.to_int, "string", [("4.7", 4), ("12", 12), ("", None), ("x", None), ("nan", None), ("1e99", None), (None, None)]),
        (lambda c: s.to_int(c, 0), "string", [("7", 7), ("", 0), (None, 0)]),
        (s.strict_int, "string", [("4.7", None), (" 4 ", 4)]),
        (s.innings_to_outs, "string", [("7.0", 21), ("7.1", 22), ("7.2", 23), ("0.1", 1), ("0.0", 0), ("7", 21), ("7.3", None), ("", None), (None, None), ("x", None)]),
        (s.lineup_slot, "string", [("100", 1), ("101", 1), ("900", 9), ("", None), (None, None)]),
        (s.substitution_index, "string", [("100", 0), ("101", 1), ("", None)]),
        (s.slug, "string", [("Fanatics Sportsbook", "fanatics_sportsbook"), ("bet365", "bet365"), (" BetRivers!", "betrivers")]),
        (s.game_type_name, "string", [("R", "Regular Season"), ("Z", "Unknown"), (None, "Unknown")]),
        (s.is_postseason, "string", [("W", True), ("R", False), (None, False)]),
        (s.encode_line, "double", [(8.5, 17), (-1.5, -3), (0.0, 0), (9.0, 18), (None, None)]),
        (s.encode_price, "int", [(-110, -110), (100, 100), (99, None), (-50, None), (0, None), (-100000, None), (-1500, -1500), (40000, None)]),
        (s.american_probability, "int", [(100, 0.5), (150, 0.4), (-110, 110 / 210), (0, None), (None, None)]),
        (lambda c: s.within(c, 3, 25), "double", [(3.0, True), (25.5, False), (None, True)]),
    ],
)
def test_scalars(spark, f, kind, pairs):
    got = apply(spark, f, [p[0] for p in pairs], kind)
    assert got == [pytest.approx(p[1]) if isinstance(p[1], float) else p[1] for p in pairs]


def test_times(spark):
    text = ["2025-06-01T14:48:23+00:00", "2025-06-01T10:48:00-04:00", "2025-06-01T14:48:59Z", "2025-06-01T14:48:23", "2025-06-01", "x", None]
    noon = dt.datetime(2025, 6, 1, 14, 48)
    got = apply(spark, lambda c: s.parse_utc(c).cast("string"), text, "string")
    assert got == [str(noon)] * 3 + [None] * 4
    days = apply(spark, lambda c: s.eastern_date(c).cast("string"), ["2025-03-28 02:10:00", "2025-08-02 03:59:00", "2025-08-02 04:01:00"], "string")
    assert days == ["2025-03-27", "2025-08-01", "2025-08-02"]


def test_rates_round_half_to_even_and_twice(spark):
    r = spark.range(1).select(s.rate(F.lit(1), F.lit(128)).alias("a"), s.rate(F.lit(1), F.lit(0)).alias("b"), s.rate(F.lit(None), F.lit(2)).alias("c"), s.whip(F.lit(2), F.lit(5), F.lit(19)).alias("w")).first()
    assert (r.a, r.b, r.c) == (0.007812, None, None)
    assert r.w == round(7 / round(19 / 3, 6), 6)


def test_quarter_line_stops_the_job(spark):
    for line in (8.25, 1.1, -1.25):
        with pytest.raises(Exception, match="not a multiple of a half"):
            apply(spark, s.encode_line, [line], "double")


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(-32768, 32767), min_size=1, max_size=20))
def test_lines_round_trip(spark, codes):
    lines = [c / 2 for c in codes]
    assert apply(spark, lambda c: s.decode_line(s.encode_line(c)), lines, "double") == lines


def test_devig(spark):
    df = spark.createDataFrame([(-110, -110), (-110, None)], "a int, b int").select(s.devig("a", "b").alias("d")).select("d.*")
    rows = df.collect()
    assert rows[0][:2] == (0.5, 0.5) and abs(rows[0][2] - 0.047619) < 1e-6 and rows[1] == (None, None, None)


def test_injuries_and_backdating(spark):
    df = spark.createDataFrame([("placed on the 10-day Injured List", None), ("signed", "Paternity List"), ("traded", None), (None, None)], "a string, b string")
    assert [r[0] for r in df.coalesce(1).select(s.is_injury("a", "b")).collect()] == [True, True, False, False]
    df = spark.createDataFrame([("2025-05-25", "2025-05-22"), ("2025-05-25", "2025-05-25"), ("2025-05-25", None)], "k string, e string").selectExpr("cast(k as date) k", "cast(e as date) e")
    assert [tuple(r) for r in df.coalesce(1).select(s.backdated_days("k", "e"), s.is_backdated("k", "e")).collect()] == [(3, True), (0, False), (None, False)]


def test_teams(spark):
    assert team_table(spark).select("team_id").distinct().count() == len(TEAMS) == 30
    aliases = {r["alias"]: r["team_id"] for r in alias_table(spark).collect()}
    assert len(aliases) == alias_table(spark).count() == 163
    assert aliases["L.A. Dodgers"] == aliases["LAD"] == "119" and aliases["Cleveland Indians"] == "114" and aliases["Athletics Athletics"] == "133"


def test_helpers():
    assert s.before("runs") == "runs_BEFORE" and s.seasons_between(2019, 2021) == [2019, 2020, 2021]
    with pytest.raises(ValueError):
        s.seasons_between(2021, 2019)
