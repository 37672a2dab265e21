"""Closing quotes against outcomes: residuals, fair probabilities, overround."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import decode_line, devig
from ..operators.ordered import keep_last


def closing_quotes(ticks: DataFrame) -> DataFrame:
    """The last tick before the start of each game, market and book."""
    return keep_last(ticks.where("is_pregame"), ["game_pk", "market", "book_slug"], "line_ts")


def closing_outcomes(ticks: DataFrame, games: DataFrame) -> DataFrame:
    """Closing quotes with the game's result: residual of the line, fair probabilities, whether the left side won.

    Totals: total runs minus the line, left is over.  Run line: home margin plus the
    home (right) line, left is away.  Money line: no line, left is away.
    """
    df = closing_quotes(ticks).join(games.where("is_final").select("game_pk", "total_runs", "run_line_margin"), "game_pk")
    c = F.col
    residual = F.when(c("market") == "totals", c("total_runs") - decode_line("left_line")).when(c("market") == "run_line", c("run_line_margin") + decode_line("right_line"))
    left_won = F.when(c("market") == "totals", residual > 0).when(c("market") == "run_line", residual < 0).otherwise(c("run_line_margin") < 0)
    return df.withColumns({"residual": residual, "left_won": left_won, "fair": devig("left_price", "right_price")}).select(
        "game_pk", "market", "book_slug", "residual", "left_won", "fair.fair_left", "fair.fair_right", "fair.overround"
    )


def orientation_report(outcomes: DataFrame) -> DataFrame:
    """Per market: n, mean and standard deviation of residuals, mean fair and realised left probability, mean overround."""
    return outcomes.groupBy("market").agg(
        F.count("*").alias("n"), F.avg("residual").alias("mean_residual"), F.stddev_samp("residual").alias("std_residual"),
        F.avg("fair_left").alias("mean_fair_left"), F.avg(F.col("left_won").cast("double")).alias("realised_left"), F.avg("overround").alias("mean_overround"),
        F.corr("fair_left", F.col("left_won").cast("double")).alias("fair_corr"),
    )
