"""Joins that name the reason where they find nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest_match(
    events: DataFrame,
    games: DataFrame,
    keys: Sequence[str],
    event_id: str,
    event_time: str,
    game_time: str,
    tolerance_seconds: int,
    game_order: Sequence[str],
) -> DataFrame:
    """Each event with its game of equal keys, the nearest in time if several.

    Adds n_candidates, delta_seconds (event minus game) and reason: 'no_game' where
    the keys match nothing, 'not_close' where several match and the nearest is
    further than the tolerance; a single candidate is taken however far, and if its
    start is not known.  Of several the ones with a start come first, and a pair
    without two times is never close.  Equal distances go by ``game_order``.  Rows of one
    event id are one event, with the candidates of all of them; otherwise this is ``nearest_sorted``, and no pairs are made.
    """
    near = nearest_sorted(events, games, keys, event_id, event_time, game_time, tolerance_seconds, game_order)
    every = Window.partitionBy(event_id)
    best = every.orderBy(F.abs("delta_seconds").asc_nulls_last(), *(F.col(c).asc_nulls_last() for c in game_order))
    one = near.withColumns({"__rank": F.row_number().over(best), "n_candidates": F.sum("n_candidates").over(every)}).where("__rank = 1")
    return one.withColumn("reason", _reason(tolerance_seconds)).drop("__rank")


def _reason(tolerance_seconds: int) -> Column:
    close = F.coalesce(F.abs("delta_seconds") <= tolerance_seconds, F.lit(False))
    return F.when(F.col("n_candidates") == 0, "no_game").when((F.col("n_candidates") > 1) & ~close, "not_close")


def nearest_sorted(
    events: DataFrame,
    games: DataFrame,
    keys: Sequence[str],
    event_id: str,
    event_time: str,
    game_time: str,
    tolerance_seconds: int,
    game_order: Sequence[str],
) -> DataFrame:
    """``nearest_match`` for different event ids, however many games a key has: no pairs are made, each event meets the last game before it and the next one after.

    Events and games are shuffled once, by the keys, and passed in the order of time both
    ways; the cost is that of sorting, however many games a key has.  ``game_order`` tells
    all games of a key apart.  An event with a NULL key meets none and is spread by its id.
    The rows of one key are sorted in one task, which spills.  Columns of the names that are
    added give way to them.
    """
    added = ("delta_seconds", "n_candidates", "reason")
    events, games = events.drop(*added), games.drop(*added)
    own = [c for c in games.columns if c not in keys]
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    event = events.select(
        *keys, F.when(~complete, F.col(event_id).cast("string")).alias("__alone"), F.unix_timestamp(event_time).alias("__at"),
        F.struct(*(c for c in events.columns if c not in keys)).alias("__event"),
    )
    game = games.where(complete).select(*keys, F.lit(None).cast("string").alias("__alone"), F.unix_timestamp(game_time).alias("__at"), F.struct(*own).alias("__game"))
    both = event.unionByName(game, allowMissingColumns=True).withColumn("__second", F.col("__game").isNull())
    group = Window.partitionBy(*keys, "__alone")
    by_place = group.orderBy("__second", *(F.col(f"__game.{c}").asc_nulls_last() for c in game_order))
    both = both.withColumn("__place", F.row_number().over(by_place))
    timed = ~F.col("__second") & F.col("__at").isNotNull()
    seen = F.when(~F.col("__second"), F.struct(F.col("__at").alias("at"), F.col("__place").alias("place"), F.col("__game").alias("game")))
    rank = lambda sign: F.when(timed, F.struct(F.col("__at"), sign * F.col("__place")))
    both = both.withColumns(
        {
            "__before": F.max_by(seen, rank(-1)).over(group.orderBy(F.col("__at").asc_nulls_last(), "__second").rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "__after": F.min_by(seen, rank(1)).over(group.orderBy(F.col("__at").desc_nulls_last(), "__second").rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "__first": F.min_by(seen, F.when(~F.col("__second"), F.col("__place"))).over(group), "n_candidates": F.count("__game").over(group),
        }
    ).where("__second")
    back, ahead = F.col("__at") - F.col("__before.at"), F.col("__after.at") - F.col("__at")
    earlier = ahead.isNull() | (back < ahead) | ((back == ahead) & (F.col("__before.place") < F.col("__after.place")))
    nearest = F.when(F.col("__at").isNull(), F.col("__first")).when(back.isNotNull() & earlier, F.col("__before")).otherwise(F.coalesce("__after", "__first"))
    both = both.withColumn("__best", nearest).withColumn("delta_seconds", F.col("__at") - F.col("__best.at"))
    return both.select(*keys, "__event.*", *(F.col(f"__best.game.{c}").alias(c) for c in own), "delta_seconds", "n_candidates", _reason(tolerance_seconds).alias("reason"))


def lookup(df: DataFrame, table: DataFrame, key: str, table_key: str, reason: str) -> DataFrame:
    """A left join with a small fixed table; ``reason`` names the rows whose key it lacks."""
    known = table.withColumn("__known", F.lit(True))
    joined = df.join(known, F.col(key) == F.col(table_key), "left")
    return joined.withColumn(reason, F.when(F.col("__known").isNull(), F.when(F.col(key).isNull(), "missing").otherwise("unknown"))).drop("__known")


def required(value: Column, message: str) -> Column:
    """``value``, or the end of the job where it is NULL.  Keep it in the output: a pruned column never raises."""
    return F.coalesce(value, F.raise_error(F.lit(message)))
