import datetime as dt
import random

from pyspark.sql import functions as F

from pitlake.operators.ordered import flag_first
from pitlake.streaming.openers import MARKET, current_openers, flagged_by_log, opener_changes, read_log, write_changes

TICKS = "game_pk string, market string, book_slug string, line_ts timestamp"


def test_shuffled_replays_equal_the_batch(spark, tmp_path):
    """Ticks in any order, repeats, a replayed file and restarts: the log says what a batch over all ticks says."""
    rng = random.Random(3)
    source, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "cp"))
    start = dt.datetime(2025, 6, 1)
    rows = [(str(rng.randrange(6)), rng.choice(["totals", "run_line"]), rng.choice("ab"), start + dt.timedelta(microseconds=rng.randrange(10**9))) for _ in range(300)]
    rows += [(None, "totals", "a", start), ("1", "totals", "a", None)]
    rng.shuffle(rows)

    def land(part):
        spark.createDataFrame(part, TICKS).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(source)
        q = write_changes(opener_changes(stream), log, checkpoint)
        q.awaitTermination(180)
        assert q.exception() is None

    def openers(df):
        return sorted(map(tuple, df.select(*MARKET, "line_ts").collect()))

    def batch():
        return flag_first(spark.read.parquet(source).dropna().distinct(), MARKET, [F.col("line_ts")], "is_opener")

    land(rows[:80])
    land(rows[80:120])
    run()
    assert openers(current_openers(read_log(spark, log))) == openers(batch().where("is_opener"))
    land(rows[120:])
    land(rows[:80])  # the first file once more
    run()
    changes = read_log(spark, log)
    assert openers(current_openers(changes)) == openers(batch().where("is_opener"))
    assert changes.where("change < 0").count() == changes.where("change > 0").count() - current_openers(changes).count() > 0
    flags = lambda df: sorted(map(tuple, df.select(*MARKET, "line_ts", "is_opener").collect()))
    assert flags(flagged_by_log(batch(), changes)) == flags(batch())
    run()  # nothing new
    assert read_log(spark, log).count() == changes.count()
