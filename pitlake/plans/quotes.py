"""Cleaning and encoding of ticks, and identity of events; every drop and repair has a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import encode_line, encode_price, within
from ..functions.teams import alias_table
from ..operators.matching import nearest_match
from ..operators.ordered import flag_first
from ..sources.catalog import TABLES, conform

# Plausible lines before the start, tolerance of equality, and times in seconds.
TOTALS_BAND, RUN_LINE_BAND, EQUAL = (3.0, 25.0), (-10.0, 10.0), 1e-9
CLOSE_SECONDS, DISAGREE_SECONDS = 3 * 3600, 15 * 60


def tag_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks with drop_reason and repair_reason, lines repaired, codes beside them.

    In this order: sides that contradict each other drop the tick; a money line has
    no line; a line outside its band before the start is cleared on both sides;
    lines and prices are encoded; a tick without any of the four drops as empty.
    """
    c = F.col
    both = c("left_line").isNotNull() & c("right_line").isNotNull()
    contradiction = (
        F.when((c("market") == "totals") & both & (F.abs(c("left_line") - c("right_line")) > EQUAL), "totals_sides_disagree")
        .when((c("market") == "run_line") & both & (F.abs(c("left_line") + c("right_line")) > EQUAL), "run_line_not_mirrored")
    )
    df = ticks.withColumns({"drop_reason": contradiction, "is_pregame": c("minutes_to_tip") < 0})
    money = (c("market") == "money_line") & (c("left_line").isNotNull() | c("right_line").isNotNull())

    def inside(line: str) -> Column:
        return F.when(c("market") == "totals", within(line, *TOTALS_BAND)).when(c("market") == "run_line", within(line, *RUN_LINE_BAND)).otherwise(F.lit(True))

    outside = c("is_pregame") & ~(inside("left_line") & inside("right_line"))
    repair = F.when(c("drop_reason").isNull(), F.when(money, "moneyline_line_cleared").when(outside, "line_out_of_bounds_cleared"))
    df = df.withColumn("repair_reason", repair)
    clear = (c("market") == "money_line") | (c("repair_reason") == "line_out_of_bounds_cleared")
    keep_line = c("drop_reason").isNull() & ~F.coalesce(clear, F.lit(False))
    df = df.withColumns({f"{side}_line": F.when(keep_line, c(f"{side}_line")) for side in ("left", "right")})
    df = df.withColumns(
        {f"{side}_line_code": encode_line(f"{side}_line") for side in ("left", "right")} | {f"{side}_price_code": encode_price(f"{side}_price") for side in ("left", "right")}
    )
    nothing = F.coalesce("left_line_code", "left_price_code", "right_line_code", "right_price_code").isNull()
    return df.withColumn("drop_reason", F.coalesce("drop_reason", F.when(nothing, "empty_quote")))


def reason_counts(df: DataFrame, *reasons: str) -> DataFrame:
    """(reason, n) over some reason columns, most frequent first where it is collected."""
    kinds = F.explode(F.array_compact(F.array(*reasons))).alias("reason")
    return df.select(kinds).groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "reason")


def resolve_events(events: DataFrame, games: DataFrame) -> DataFrame:
    """Events with their game_pk, or reason: unknown_team_name, no_game_on_date, doubleheader_no_close_start.

    ``disagrees`` marks a start more than 15 minutes off the listed one.  The
    provider's own start is kept.
    """
    names = F.broadcast(alias_table(events.sparkSession).select("alias", F.col("team_id").alias("tid")))
    df = events
    for side in ("home", "away"):
        df = df.withColumn("__name", F.trim(f"team_{side}")).join(names, F.col("__name") == F.col("alias"), "left")
        df = df.withColumnRenamed("tid", f"{side}_team_id").drop("alias", "__name")
    listed = games.select("game_pk", "game_date", "home_team_id", "away_team_id", F.col("first_pitch_utc").alias("listed_start"), F.col("game_number"))
    df = nearest_match(df, listed, ["game_date", "home_team_id", "away_team_id"], "event_id", "first_pitch_utc", "listed_start", CLOSE_SECONDS, ["game_number", "game_pk"])
    unknown = F.col("home_team_id").isNull() | F.col("away_team_id").isNull()
    reason = F.when(unknown, "unknown_team_name").when(F.col("reason") == "no_game", "no_game_on_date").when(F.col("reason") == "not_close", "doubleheader_no_close_start")
    df = df.withColumn("reason", reason)
    found = F.col("reason").isNull()
    return df.withColumns(
        {
            "game_pk": F.when(found, F.col("game_pk")), "is_doubleheader": F.col("n_candidates") > 1, "game_number": F.coalesce("game_number", F.lit(1)),
            "disagrees": found & F.coalesce(F.abs("delta_seconds") > DISAGREE_SECONDS, F.lit(False)), "delta_minutes": F.floor(F.abs("delta_seconds") / 60).cast("int"),
        }
    )


def match_rate(resolved: DataFrame) -> DataFrame:
    """One row: n_events, n_matched, rate (NULL for no events)."""
    n, hit = F.count("*"), F.count(F.when(F.col("reason").isNull(), 1))
    return resolved.agg(n.alias("n_events"), hit.alias("n_matched"), F.try_divide(hit, n).alias("rate"))


def odds_tables(events: DataFrame, ticks: DataFrame, games: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ticks to load, game dimension, tagged ticks) of scraped events and their ticks.

    ingest_status is no_quotes for an event without ticks, rejected if none is
    usable, else complete.  The tagged ticks are the account of all drops and repairs.
    """
    resolved = resolve_events(events.drop("books", "views"), games)  # the quotes of a page would be sorted with its event
    matched = resolved.where("reason is null")
    tagged = tag_ticks(ticks.join(matched.select("event_id", "game_pk"), "event_id"))
    usable = tagged.where("drop_reason is null").withColumns({f"{s}_{w}": F.col(f"{s}_{w}_code") for s in ("left", "right") for w in ("line", "price")})
    usable = usable.withColumn("mins_to_tip", F.col("minutes_to_tip"))
    load = conform(flag_first(usable, ["game_pk", "market", "book_slug"], [F.col("line_ts"), F.col("event_id")], "is_opener"), TABLES["odds_ticks"].schema)
    counts = tagged.groupBy("event_id").agg(F.count("*").cast("int").alias("source_tick_count"), F.count(F.when(F.col("drop_reason").isNull(), 1)).cast("int").alias("usable_tick_count"))
    dim = matched.join(counts, "event_id", "left").na.fill(0, ["source_tick_count", "usable_tick_count"])
    status = F.when(F.col("source_tick_count") == 0, "no_quotes").when(F.col("usable_tick_count") == 0, "rejected").otherwise("complete")
    dim = dim.withColumns(
        {
            "ingest_status": status, "dropped_tick_count": F.col("source_tick_count") - F.col("usable_tick_count"),
            "team_home_id": F.col("home_team_id"), "team_away_id": F.col("away_team_id"),
        }
    )
    return load, conform(dim, TABLES["odds_games"].schema), tagged


def repair_openers(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """The ticks of all games that ``incoming`` touches, stored and incoming together, with their openers anew."""
    touched = incoming.select("game_pk").distinct()
    key = list(TABLES["odds_ticks"].key)
    old = stored.join(touched, "game_pk", "left_semi").join(incoming.select(*key), key, "left_anti")
    together = old.unionByName(incoming, allowMissingColumns=True)
    return flag_first(together, ["game_pk", "market", "book_slug"], [F.col("line_ts")], "is_opener")


def changed_openers(stored: DataFrame) -> DataFrame:
    """Stored ticks whose opener flag is not what the whole history says."""
    anew = flag_first(stored, ["game_pk", "market", "book_slug"], [F.col("line_ts")], "__opener")
    return anew.where("is_opener is distinct from __opener").withColumn("is_opener", F.col("__opener")).drop("__opener")
