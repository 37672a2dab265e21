"""Line-history pages to ticks, day pages to game lists, pitch files to pitches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import as_id, as_id_number, eastern_date, full_name, minutes_to_start, parse_utc, season_of, slug, strict_int, team_name, to_int
from ..operators.ordered import flag_first, keep_first, keep_last
from .catalog import TABLES, conform

_PAGE_JSON = r'(?s)<script id="__NEXT_DATA__" type="application/json"[^>]*>(.*?)</script>'
_SIDE = "struct<fullName: string, name: string>"
_STARTER = "struct<firstName: string, lastName: string>"
_VIEW = f"struct<gameId: string, startDate: string, awayTeam: {_SIDE}, homeTeam: {_SIDE}, awayStarter: {_STARTER}, homeStarter: {_STARTER}, awayTeamScore: string, homeTeamScore: string, gameStatusText: string>"
_SPREAD = "array<struct<oddsDate: string, homeOdds: string, awayOdds: string, homeSpread: double, awaySpread: double>>"
_TOTAL = "array<struct<oddsDate: string, overOdds: string, underOdds: string, total: double>>"
LINE_HISTORY = (
    "props struct<pageProps: struct<lineHistoryModel: struct<sportsbooks: array<struct<machineName: string, name: string>>, "
    f"lineHistory: struct<gameView: {_VIEW}, oddsViews: array<struct<sportsbook: string, totalHistory: {_TOTAL}, spreadHistory: {_SPREAD}, moneyLineHistory: {_SPREAD}>>>>>>"
)
SLATE = f"props struct<pageProps: struct<oddsTables: array<struct<oddsTableModel: struct<gameRows: array<struct<gameView: {_VIEW}>>>>>>>"


def page_json(html: Column | str) -> Column:
    """The JSON that a page embeds; '' where there is none."""
    return F.regexp_extract(F.col(html) if isinstance(html, str) else html, _PAGE_JSON, 1)


def _event(view: str) -> dict[str, Column]:
    start = parse_utc(f"{view}.startDate")
    return {
        "event_id": strict_int(f"{view}.gameId"), "first_pitch_utc": start, "game_date": eastern_date(start), "season_year": season_of(eastern_date(start)),
        "team_away": team_name(f"{view}.awayTeam.fullName", f"{view}.awayTeam.name"), "team_home": team_name(f"{view}.homeTeam.fullName", f"{view}.homeTeam.name"),
        "starter_away": full_name(f"{view}.awayStarter.firstName", f"{view}.awayStarter.lastName"),
        "starter_home": full_name(f"{view}.homeStarter.firstName", f"{view}.homeStarter.lastName"),
        "status_text": F.coalesce(F.col(f"{view}.gameStatusText"), F.lit("")), "away_score": strict_int(f"{view}.awayTeamScore"), "home_score": strict_int(f"{view}.homeTeamScore"),
    }


def slate(raw: DataFrame) -> DataFrame:
    """The games of day pages (payload, ordinal): the first listing of each event with a start."""
    tables = raw.select("ordinal", F.posexplode(F.from_json("payload", SLATE)["props"]["pageProps"]["oddsTables"]).alias("i", "t"))
    rows = tables.select("ordinal", "i", F.posexplode("t.oddsTableModel.gameRows").alias("j", "r")).select(F.struct("ordinal", "i", "j").alias("place"), F.col("r.gameView").alias("v"))
    rows = rows.select("place", *(c.alias(n) for n, c in _event("v").items() if not n.endswith("_score"))).where("event_id is not null and first_pitch_utc is not null")
    return keep_first(rows, ["event_id"], [F.col("place")]).drop("place")


def scraped_games(raw: DataFrame) -> DataFrame:
    """One row per line-history payload: the event's columns and views, or reason: no_json, no_game_id, no_start."""
    model = F.from_json("payload", LINE_HISTORY)["props"]["pageProps"]["lineHistoryModel"]
    df = raw.select("*", model.alias("m")).withColumn("v", F.col("m.lineHistory.gameView")).withColumns(_event("v"))
    reason = F.when(F.col("m").isNull(), "no_json").when(F.col("event_id").isNull(), "no_game_id").when(F.col("first_pitch_utc").isNull(), "no_start")
    return df.withColumns({"reason": reason, "books": F.col("m.sportsbooks"), "views": F.col("m.lineHistory.oddsViews")}).drop("m", "v", "payload")


def _quote(market: str, history: str, left_line: str, left_price: str, right_line: str, right_price: str) -> Column:
    return F.transform(
        F.coalesce(F.col(f"view.{history}"), F.array()),
        lambda q, i: F.struct(
            F.lit(market).alias("market"), i.alias("at"), parse_utc(q["oddsDate"]).alias("line_ts"), q[left_line].alias("left_line"),
            to_int(q[left_price]).alias("left_price"), q[right_line].alias("right_line"), to_int(q[right_price]).alias("right_price"),
        ),
    )


def ticks(games: DataFrame) -> DataFrame:
    """Ticks of ``scraped_games`` without a reason: the last quote of a minute in each view, then one opener per market and book.

    Left and right are over and under for totals, away and home else.  A last quote
    that is all NULL takes its minute with it.
    """
    view = games.where("reason is null").select("event_id", "season_year", "game_date", "first_pitch_utc", "books", F.posexplode("views").alias("nth", "view"))
    machine = F.trim("view.sportsbook")
    named = F.try_element_at(F.filter("books", lambda b: F.trim(b["machineName"]) == machine), F.lit(1))["name"]
    view = view.withColumn("book_name", F.coalesce(as_id(named), machine)).where(F.coalesce(machine, F.lit("")) != "")
    quotes = F.concat(
        _quote("totals", "totalHistory", "total", "overOdds", "total", "underOdds"),
        _quote("run_line", "spreadHistory", "awaySpread", "awayOdds", "homeSpread", "homeOdds"),
        _quote("money_line", "moneyLineHistory", "awaySpread", "awayOdds", "homeSpread", "homeOdds"),
    )
    df = view.select("event_id", "season_year", "game_date", "first_pitch_utc", "book_name", "nth", F.explode(quotes).alias("q")).select("*", "q.*").drop("q")
    df = df.withColumn("book_slug", slug("book_name")).where("line_ts is not null")
    df = keep_last(df, ["event_id", "nth", "market", "line_ts"], "at")
    df = df.where(F.coalesce(F.col("left_line"), F.col("left_price"), F.col("right_line"), F.col("right_price")).isNotNull())
    df = df.withColumn("minutes_to_tip", minutes_to_start("line_ts", "first_pitch_utc"))
    return flag_first(df, ["event_id", "market", "book_slug"], [F.col("line_ts"), F.col("nth"), F.col("at")], "is_opener").drop("at", "nth")


_FLOAT_IDS = ("on_1b", "on_2b", "on_3b")


def read_pitches(spark: SparkSession, path: str) -> DataFrame:
    """Pitch CSV files with header, all text; columns are found by name.

    ``__ordinal`` orders the rows by file, then by place in it, however Spark splits
    or packs the files: a block of a file is read by one task, in order.
    """
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row"))
    return spark.read.option("header", True).csv(path).withColumn("__ordinal", place)


def pitches(raw: DataFrame, season: int) -> DataFrame:
    """The pitch contract from raw pitch rows: renamed, typed, without rows that lack a number, the last of equal keys.

    The last is that of the greatest ``__ordinal`` (``read_pitches`` sets it); without that column rows count as they come.
    An ``error`` column holds a provider's message instead of rows: ValueError.
    """
    if "error" in raw.columns:
        message = raw.select("error").where("error is not null").first()
        if message:
            raise ValueError(f"pitch feed: {message[0]}")
    schema = TABLES["statcast_pitches"].schema
    df = raw.withColumnsRenamed({"batter": "batter_id", "pitcher": "pitcher_id"})
    if "__ordinal" not in df.columns:
        df = df.withColumn("__ordinal", F.monotonically_increasing_id())
    have = set(df.columns)
    columns = []
    for f in schema:
        c, kind = F.col(f.name) if f.name in have else F.lit(None).cast("string"), f.dataType.typeName()
        if f.name == "season_year":
            c = F.lit(season)
        elif f.name in ("game_pk", "batter_id", "pitcher_id", *_FLOAT_IDS):
            c = F.coalesce(as_id_number(c.cast("string").try_cast("double")), as_id(c))
        elif kind == "integer":
            c = to_int(c)
        elif kind == "double":
            c = c.cast("string").try_cast("double")
        elif kind == "date":
            c = F.to_date(F.try_to_timestamp(F.substring(c.cast("string"), 1, 10), F.lit("yyyy-MM-dd")))
        columns.append(c.cast(f.dataType).alias(f.name))
    df = df.select(*columns, "__ordinal").where("at_bat_number is not null and pitch_number is not null")
    return conform(keep_last(df, TABLES["statcast_pitches"].key, "__ordinal"), schema)
