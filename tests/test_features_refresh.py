import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pitlake.plans import features

TEAM = "team_id int, game_pk string, first_pitch_utc timestamp, runs int"
ARMS = "team_id int, game_pk string, game_date date, first_pitch_utc timestamp, player_id int, is_starter boolean, pitches_thrown int"


def plain(df):
    names = sorted(df.columns)
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*names).collect()), key=str)


def at(hour):
    return dt.datetime(2025, 4, 1) + dt.timedelta(hours=hour)


@pytest.mark.parametrize("seed", range(3))
def test_team_features(spark, seed):
    """Rows that come, go, change and move, at ends and next to each other."""
    rng = random.Random(seed)
    old = {str(i): (rng.randrange(3), str(i), at(rng.randrange(400)), rng.choice([None, 1, 5, 9])) for i in range(200)}
    new = dict(old)
    for g in rng.sample(sorted(old), 12):
        team, pk, when, runs = old[g]
        how = rng.randrange(4)
        if how == 0:
            del new[g]
        else:
            new[g] = (team if how > 1 else (team + 1) % 3, pk, when if how != 2 else at(rng.randrange(400)), 7 if how == 3 else runs)
    for i in range(200, 204):
        new[str(i)] = (rng.randrange(4), str(i), at(rng.randrange(400)), 3)  # team 3 is new
    changed = {x for x in {*old.values()} ^ {*new.values()}}
    frame = lambda rows: spark.createDataFrame(list(rows), TEAM)
    before, after = features.team_features(frame(old.values()), ["runs"]), features.team_features(frame(new.values()), ["runs"])
    assert plain(features.refresh_team_features(before, frame(new.values()), frame(changed), ["runs"])) == plain(after)


def test_slice_is_bounded(spark):
    """One change among 2,000 games of 20 teams: 10 rows after it are stale, and 10 before are read."""
    rows = spark.range(2000).selectExpr("cast(id % 20 as int) as team_id", "cast(id as string) as game_pk", "timestamp_seconds(id * 3600) as first_pitch_utc", "1 as runs")
    touched = rows.where("game_pk = '1003'")
    got = features.stale_rows(rows, touched, ["team_id"], ["first_pitch_utc", "game_pk"], 10)
    assert [tuple(r) for r in got.groupBy("team_id").agg(F.count("*"), F.count_if("__stale")).collect()] == [(3, 21, 11)]
    gone = features.stale_rows(rows.where("game_pk != '1003'"), touched, ["team_id"], ["first_pitch_utc", "game_pk"], 10)
    assert sorted(int(r[0]) for r in gone.where("__stale").select("game_pk").collect()) == [1003 + 20 * i for i in range(-1, 11) if i]
    for none in (touched.where("false"), touched.withColumn("team_id", F.lit(99))):
        assert features.stale_rows(rows, none, ["team_id"], ["first_pitch_utc", "game_pk"], 10).count() == 0


def test_starters_and_bullpen(spark):
    rng = random.Random(5)
    arm = lambda i: (rng.randrange(2), str(i // 3), dt.date(2025, 4, 1) + dt.timedelta(days=i // 9), at(i // 3), rng.randrange(6), rng.random() < 0.6, rng.choice([None, 10, 25]))
    old = list(dict.fromkeys(arm(i) for i in range(240)))
    place = lambda r: (r[4], r[3], r[1])
    old = list({place(r): r for r in old}.values())  # a player pitches once a game
    gone, came = old[20:23], [(1, "500", dt.date(2025, 4, 9), at(90), 2, True, 40), (0, "501", dt.date(2025, 4, 20), at(95), 9, False, 8)]
    new = [r for r in old if r not in gone] + came
    frame = lambda rows: spark.createDataFrame(rows, ARMS)
    touched = frame(gone + came)
    starts = features.refresh_starter_features(features.starter_features(frame(old), ["pitches_thrown"]), frame(new), touched, ["pitches_thrown"])
    assert plain(starts) == plain(features.starter_features(frame(new), ["pitches_thrown"]))
    loads = features.refresh_bullpen_load(features.bullpen_load(frame(old)), frame(new), touched)
    assert plain(loads) == plain(features.bullpen_load(frame(new)))


def test_windows_of_days_pass_a_row_a_team_and_day(spark):
    """A team's games of a day reach no window one by one, so that what one task holds does not grow with them."""
    arms = spark.range(3000).selectExpr(
        "cast(id % 2 as int) team_id", "cast(id as string) game_pk", "date_add(date'2025-04-01', cast(id % 10 as int)) game_date", "timestamp_seconds(id) first_pitch_utc", "1 player_id", "id % 3 = 0 is_starter", "7 pitches_thrown"
    )
    touched = arms.where("game_pk = '4'")
    loads = features.bullpen_load(arms)
    again = features.refresh_bullpen_load(loads, arms, touched)
    assert plain(again) == plain(loads)
    for df in (loads, again):
        lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        under = [lines[i + 1] for i, line in enumerate(lines) if "- Window [" in line]
        assert under and not any("game_pk" in line for line in under)
