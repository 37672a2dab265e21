"""Features that only know what came before: rolling means, weighted means, look-back sums."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import before
from ..functions.teams import BULLPEN_DAYS, ROLLING_GAMES, STARTER_GAMES, WEIGHTED_GAMES

_DAY = 86_400


def rolling_before(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, n: int, out: str | None = None, count: str | None = None) -> DataFrame:
    """The mean of ``value`` over the ``n`` rows before each row of its key; NULL for the first."""
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-n, -1)
    df = df.withColumn(out or before(value), F.avg(value).over(frame))
    return df if count is None else df.withColumn(count, F.count(F.lit(1)).over(frame))


def weighted_before(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, n: int, out: str | None = None) -> DataFrame:
    """A mean with weights n, n-1, ... 1 from the last row back; rows that are not there weigh nothing."""
    by = Window.partitionBy(*keys).orderBy(*order)
    past = [(F.lag(value, i).over(by), n + 1 - i) for i in range(1, n + 1)]
    total = sum((F.coalesce(v * w, F.lit(0)) for v, w in past), F.lit(0))
    weight = sum((F.when(v.isNotNull(), w).otherwise(0) for v, w in past), F.lit(0))
    return df.withColumn(out or before(value), F.try_divide(total.cast("double"), weight))


def days_before(df: DataFrame, keys: Sequence[str], time: str, value: str, days: int, out: str, count: str | None = None) -> DataFrame:
    """The sum of ``value`` over the ``days`` days before each row, up to the second before it."""
    frame = Window.partitionBy(*keys).orderBy(F.unix_timestamp(time)).rangeBetween(-days * _DAY, -1)
    df = df.withColumn(out, F.coalesce(F.sum(value).over(frame), F.lit(0)))
    return df if count is None else df.withColumn(count, F.count(F.lit(1)).over(frame))


def team_features(team_games: DataFrame, values: Sequence[str]) -> DataFrame:
    """Rolling and weighted means of team values before each game."""
    df, order = team_games, ["first_pitch_utc", "game_pk"]
    for v in values:
        df = rolling_before(df, ["team_id"], order, v, ROLLING_GAMES)
        df = weighted_before(df, ["team_id"], order, v, WEIGHTED_GAMES, before(f"{v}_weighted"))
    return df


def starter_features(appearances: DataFrame, values: Sequence[str]) -> DataFrame:
    """Rolling means over a starter's own starts."""
    df = appearances.where("is_starter")
    for v in values:
        df = rolling_before(df, ["player_id"], ["first_pitch_utc", "game_pk"], v, STARTER_GAMES)
    return df


def bullpen_load(appearances: DataFrame, days: int = BULLPEN_DAYS) -> DataFrame:
    """Relief pitches of a team in the days before each of its games, by the calendar.

    The days are summed first, so that the window passes a row a team and day, however many games there are.
    """
    relief = appearances.withColumn("__load", F.when(F.col("is_starter"), 0).otherwise(F.col("pitches_thrown")))
    per_game = relief.groupBy("team_id", "game_pk", "game_date").agg(F.sum("__load").alias("relief_pitches"))
    by_day = per_game.groupBy("team_id", "game_date").agg(F.sum("relief_pitches").alias("__sum"))
    frame = Window.partitionBy("team_id").orderBy(F.datediff("game_date", F.lit("1970-01-01").cast("date"))).rangeBetween(-days, -1)
    by_day = by_day.select("team_id", "game_date", F.coalesce(F.sum("__sum").over(frame), F.lit(0)).alias(before("relief_pitches")))
    return _on_days(per_game, by_day, ["team_id", "game_date"])


def _on_days(rows: DataFrame, by_day: DataFrame, place: Sequence[str]) -> DataFrame:
    """``rows`` with what is known of their key and day; NULLs meet NULLs.  A row a key and day is small enough to go to every task."""
    known = by_day.withColumnsRenamed({c: f"__{c}" for c in place})
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in place]
    return rows.join(F.broadcast(known), same).drop(*(f"__{c}" for c in place))


# -- after a change: only the windows that it can reach -----------------------------------


def stale_rows(rows: DataFrame, touched: DataFrame, keys: Sequence[str], order: Sequence[str], reach: int, day: str | None = None) -> DataFrame:
    """The rows that a change can reach, and those that their windows need, told apart by ``__stale``.

    ``touched`` (keys, order) are the places at which rows came, went or changed; a row that moved was at two.
    A window of ``reach`` rows before a row is stale from the place on, for ``reach`` rows; with
    ``day``, a date, it is of that many days instead.  Only keys that were touched are read further; one
    exchange by key deals for both windows, which pass a row a key and day where there is a ``day``.
    """
    if day is not None:
        return _on_days(rows.join(touched.select(*keys).distinct(), list(keys), "left_semi"), stale_days(rows, touched, keys, day, reach), [*keys, day])
    places = touched.select(*keys, *order).distinct().withColumn("__place", F.lit(True))
    own = rows.join(places.select(*keys).distinct(), list(keys), "left_semi").withColumn("__place", F.lit(False))
    both = own.unionByName(places, allowMissingColumns=True)
    # rows counted up to here: a place has the number of the row at it, or of the last before
    by = Window.partitionBy(*keys).orderBy(*order)
    return _needed(both.withColumn("__at", F.sum(F.when(F.col("__place"), 0).otherwise(1)).over(by)), keys, reach)


def stale_days(rows: DataFrame, touched: DataFrame, keys: Sequence[str], day: str, reach: int) -> DataFrame:
    """The days of touched keys that a change can reach or whose rows its windows need: keys, day, ``__stale``."""
    place = [*keys, day]
    places = touched.select(*place).distinct().withColumn("__place", F.lit(True))
    own = rows.select(*place).distinct().join(places.select(*keys).distinct(), list(keys), "left_semi").withColumn("__place", F.lit(False))
    return _needed(own.unionByName(places).withColumn("__at", F.unix_date(day).cast("long")), keys, reach)


def _needed(both: DataFrame, keys: Sequence[str], reach: int) -> DataFrame:
    back, ahead = (Window.partitionBy(*keys).orderBy("__at").rangeBetween(*r) for r in ((-reach, 0), (0, reach)))
    seen = both.withColumn("__stale", F.max("__place").over(back)).withColumn("__needed", F.max("__stale").over(ahead))
    return seen.where("__needed and not __place").drop("__needed", "__place", "__at")


def refreshed(rows: DataFrame, touched: DataFrame, keys: Sequence[str], order: Sequence[str], reach: int, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``compute`` says of the stale rows, from the slice that their windows of ``reach`` rows need; it keeps ``__stale``."""
    return compute(stale_rows(rows, touched, keys, order, reach)).where("__stale").drop("__stale")


def patched(features: DataFrame, fresh: DataFrame, touched: DataFrame, place: Sequence[str]) -> DataFrame:
    """Features after a change: the fresh rows, and the old ones at no touched and no fresh place."""
    gone = touched.select(*place).unionByName(fresh.select(*place)).distinct()
    return features.join(gone, list(place), "left_anti").unionByName(fresh)


def refresh_team_features(features: DataFrame, team_games: DataFrame, touched: DataFrame, values: Sequence[str]) -> DataFrame:
    """``team_features`` of the changed ``team_games``, from those before the change and the touched (team_id, first_pitch_utc, game_pk)."""
    place = ["team_id", "first_pitch_utc", "game_pk"]
    fresh = refreshed(team_games, touched, place[:1], place[1:], max(ROLLING_GAMES, WEIGHTED_GAMES), lambda df: team_features(df, values))
    return patched(features, fresh, touched, place)


def refresh_starter_features(features: DataFrame, appearances: DataFrame, touched: DataFrame, values: Sequence[str]) -> DataFrame:
    """``starter_features`` likewise, by (player_id, first_pitch_utc, game_pk); relief appearances that are touched change nothing."""
    place = ["player_id", "first_pitch_utc", "game_pk"]
    fresh = refreshed(appearances.where("is_starter"), touched, place[:1], place[1:], STARTER_GAMES, lambda df: starter_features(df, values))
    return patched(features, fresh, touched, place)


def refresh_bullpen_load(loads: DataFrame, appearances: DataFrame, touched: DataFrame, days: int = BULLPEN_DAYS) -> DataFrame:
    """``bullpen_load`` likewise, by touched (team_id, game_date): the days after each are summed anew, from as many days before."""
    place = ["team_id", "game_date"]
    reached = stale_days(appearances, touched, place[:1], "game_date", days)
    dates = reached.where("__stale").select(*place)
    fresh = bullpen_load(_on_days(appearances, reached.drop("__stale"), place), days).join(F.broadcast(dates), place, "left_semi")
    gone = touched.select(*place).unionByName(dates).distinct()
    return loads.join(F.broadcast(gone), place, "left_anti").unionByName(fresh)
