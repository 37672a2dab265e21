"""Command-line jobs: python -m pitlake.jobs <job> --store PATH ...

validate   findings of all checks; exit 1 if there are any (2 with --strict)
plan       dates to fetch next, with reasons; --refresh-only leaves out gaps and partial books
games      schedule payloads of a landing folder into the store
boxscores  box-score payloads (named <game>.json) of a landing folder into the store: those of games that lack one, at most --limit, oldest first, --batch-days days at a time; with --all every payload once more; with --dry-run the games that lack one
pitches    pitch CSV files of a landing folder, with a marker for every game of them
recent     the last days once more, from LANDING/schedule, LANDING/boxscores and, where there is one, LANDING/transactions
backfill   whole seasons from LANDING/schedule and, where they are, venues/SEASON, transactions and boxscores; --games-only leaves out box scores
snapshots  what is known of a slate (--date, or today and --days-ahead) from LANDING/schedule, transactions and rosters/DATE; --no-rosters; with --coverage what was captured, and the last 30 days that were not
odds       line-history pages of a landing folder into the store
coverage   ticks and games per season
archive    manifest of partitions before a season; with --target PATH what would be uploaded, with --execute the copy, verified; exit 1 if an object conflicts, changed meanwhile or came out wrong
summary    rows and partitions of every table
mirror     a season into the mirror (--mirror PATH), or with --verify its row counts; exit 1 if they differ; with --drop its tables go first, if --confirm repeats the path

--dry-run says what would be done and writes nothing.  Exit 2: the arguments or the payloads are wrong.
--settings FILE gives what the arguments leave out.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import archive, backfill, ingest, mirror_sync, planner, snapshots
from .plans.validation import validate
from .session import local_session
from .settings import Settings
from .sources import quotes
from .sources.catalog import TABLES
from .sources.store import Store


def show(df: DataFrame, rows: int = 1000) -> int:
    got = df.take(rows)
    for r in got:
        print("\t".join("" if v is None else str(v) for v in r))
    return len(got)


def landed_boxscores(spark: SparkSession, path: str) -> DataFrame:
    """(game_pk, payload) of files named after their game."""
    return ingest.landed(spark, path).select(F.regexp_extract("ordinal", r"([^/]+)\.json$", 1).alias("game_pk"), "payload").where("game_pk != ''")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="pitlake", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job", choices=["validate", "plan", "games", "boxscores", "pitches", "recent", "odds", "coverage", "archive", "summary", "mirror", "backfill", "snapshots"])
    p.add_argument("--settings")
    p.add_argument("--store")
    p.add_argument("--landing")
    p.add_argument("--mirror")
    p.add_argument("--target", help="where archive copies to")
    p.add_argument("--prefix", default="archive")
    p.add_argument("--seasons", type=int, nargs="*", default=[])
    p.add_argument("--refresh-days", type=int, default=3)
    p.add_argument("--days-back", type=int, default=3)
    p.add_argument("--batches", type=int, default=1)
    p.add_argument("--batch-days", type=int, default=7)
    p.add_argument("--limit", type=int)
    p.add_argument("--limit-dates", type=int)
    p.add_argument("--first-season", type=int, default=Settings.first_season)
    p.add_argument("--date")
    p.add_argument("--days-ahead", type=int, default=1)
    p.add_argument("--confirm")
    p.add_argument("--before-season", type=int, default=2025)
    p.add_argument("--today", help="a date; the current one if left out")
    for flag in ("--dry-run", "--strict", "--refresh-only", "--verify", "--execute", "--all", "--games-only", "--no-rosters", "--coverage", "--drop"):
        p.add_argument(flag, action="store_true")
    p.set_defaults(discontinued_books=())
    return p


def _arguments(p: argparse.ArgumentParser, args: list[str] | None) -> argparse.Namespace:
    """The arguments; what they leave out comes from the settings file, if one is named."""
    where = p.parse_known_args(args)[0].settings
    if where is not None:
        try:
            p.set_defaults(**vars(Settings.read(where)))
        except (OSError, ValueError) as error:
            p.error(str(error))
    a = p.parse_args(args)
    if not a.store:
        p.error("--store is needed")
    return a


def _there(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def _landed_if(spark: SparkSession, path: str) -> DataFrame | None:
    return ingest.landed(spark, path) if _there(spark, path) else None


def _boxscores(store: Store, a: argparse.Namespace) -> int:
    skipped = 0
    for season in a.seasons:
        if a.dry_run:
            show(ingest.missing_boxscores(store, season).select("game_pk", "game_date"))
            continue
        raw = landed_boxscores(store.spark, a.landing)
        if a.all:
            print(season, ingest.update_boxscores(store, raw, season, a.batches))
        else:
            print(season, backfill.fill_boxscores(store, raw, season, a.limit, a.batch_days))
        skipped += show(ingest.skipped_boxscores(raw, store.read("games")))
    return 2 if skipped and a.strict else 0


def _mirror(store: Store, a: argparse.Namespace) -> int:
    if a.drop:
        if a.confirm != a.mirror:
            print(f"--drop deletes every table of {a.mirror}: repeat the path after --confirm")
            return 2
        print("dropped", ", ".join(mirror_sync.drop_mirror(store.spark, a.mirror)))
    target = mirror_sync.open_mirror(store.spark, a.mirror)
    if a.verify:
        found = mirror_sync.verify(store, target, a.seasons)
        show(found)
        return int(not found.where("not matches").isEmpty())
    for season in a.seasons:
        print(season, mirror_sync.sync_tables(store, target, season) | mirror_sync.sync_odds(store, target, season, F.current_timestamp()))
    return 0


def _archive(store: Store, a: argparse.Namespace) -> int:
    live = lambda: [f"{t}/{f}" for t in store.tables for f in store.version(t).files]
    found = lambda: archive.discover(store.spark, a.store, a.before_season, a.prefix, live())
    files = found().persist()
    try:
        show(archive.manifest(files))
        if not a.target:
            show(archive.manifest_objects(files))
            return 0
        if not a.execute or a.dry_run:
            there = archive.existing(store.spark, a.target, a.prefix)
            show(archive.classify_uploads(files.select("key", "size", "sha256"), there))
            return 0
        done = archive.upload(files, a.target).persist()
        show(done.groupBy("result").count())
        wrong = done.where(~F.col("result").isin("copied", "present"))
        later = archive.mutated(files, found())  # the store went on while files were copied
        code = int(show(wrong.select("key", "result")) + show(later.select("key", F.lit("changed since"))) > 0)
        done.unpersist()
        return code
    finally:
        files.unpersist()


def _backfill(store: Store, a: argparse.Namespace, today: str) -> int:
    spark, landing = store.spark, a.landing
    for season in a.seasons or range(a.first_season, int(today[:4]) + 1):
        box = landed_boxscores(spark, f"{landing}/boxscores") if not a.games_only and _there(spark, f"{landing}/boxscores") else None
        venues, moves = _landed_if(spark, f"{landing}/venues/{season}"), _landed_if(spark, f"{landing}/transactions")
        print(season, backfill.backfill_season(store, season, ingest.landed(spark, f"{landing}/schedule"), today, venues, moves, box, a.limit, a.batch_days))
    show(store.summary())
    return 0


def _snapshots(store: Store, a: argparse.Namespace, today: str) -> int:
    """Captures lie beside the tables; exit 1 if one failed."""
    spark, heads, data = store.spark, f"{store.root}/_snapshots/headers", f"{store.root}/_snapshots/data"
    if a.coverage:
        if not _there(spark, heads):
            print("no captures")
            return 0
        taken, end = spark.read.parquet(heads), F.lit(today).cast("date")
        show(snapshots.coverage(taken))
        for r in snapshots.missing_snapshot_dates(taken, "probables", F.date_sub(end, 30), end).orderBy("slate_date").collect():  # 31 at most
            print("missing", r["slate_date"], sep="\t")
        return 0
    now = str(spark.range(1).select(F.current_timestamp().cast("string")).first()[0]) if a.today is None else f"{a.today} 16:00:00"
    sources = backfill.slate_captures(spark, a.landing, not a.no_rosters)
    taken, failed = snapshots.capture_all(spark, heads, data, now, sources, a.days_ahead, [a.date] if a.date else None)
    for (kind, day), n in taken.items():
        print(day, kind, n, sep="\t")
    for kind, day, what in failed:
        print(day, kind, what, sep="\t")
    return int(bool(failed))


def main(args: list[str] | None = None) -> int:
    p = _parser()
    a = _arguments(p, args)
    if any(not 1876 <= s <= 2100 for s in a.seasons):
        p.error("seasons lie between 1876 and 2100")
    if a.job in ("games", "boxscores", "pitches", "odds", "mirror") and not a.seasons:
        p.error(f"{a.job} needs --seasons")
    if a.job in ("games", "pitches", "odds", "recent", "backfill") and not a.landing or a.job == "snapshots" and not a.landing and not a.coverage or a.job == "boxscores" and not a.landing and not a.dry_run:
        p.error(f"{a.job} needs --landing")
    if a.job == "mirror" and not a.mirror:
        p.error("mirror needs --mirror")
    spark = local_session()
    store = Store(spark, a.store)
    seasons = a.seasons or None
    today = F.current_date() if a.today is None else F.lit(a.today).cast("date")
    if a.job == "validate":
        found = show(validate({t: store.read(t, seasons) for t in TABLES}))
        return (2 if a.strict else 1) if found else 0
    if a.job == "plan":
        plan = planner.plan_update(*(store.read(t, seasons) for t in ("games", "odds_games", "odds_ticks", "odds_fetches")), today, a.refresh_days, list(a.discontinued_books))
        if a.refresh_only:
            plan = plan.where(F.array_contains("reasons", "refresh"))
        show(plan if a.limit_dates is None else plan.limit(a.limit_dates))
    elif a.job == "games":
        for season in a.seasons:
            raw = ingest.landed(spark, a.landing)
            if a.dry_run:
                print(season, ingest.schedules.games(raw).where(F.col("season_year") == season).count())
            else:
                print(season, ingest.update_games(store, raw, season))
    elif a.job == "boxscores":
        return _boxscores(store, a)
    elif a.job == "pitches":
        for season in a.seasons:
            raw = quotes.read_pitches(spark, a.landing)
            fetched = raw.groupBy("game_pk").agg(F.to_date(F.min("game_date")).alias("game_date")).withColumn("fetched_at_utc", F.current_timestamp())
            if a.dry_run:
                print(season, fetched.count())
            else:
                print(season, ingest.update_pitches(store, raw, fetched, season))
    elif a.job == "recent":
        schedule, box = ingest.landed(spark, f"{a.landing}/schedule"), landed_boxscores(spark, f"{a.landing}/boxscores")
        if a.dry_run:
            show(ingest.schedules.games(schedule).where(F.col("game_date").between(F.date_sub(today, a.days_back), F.date_sub(today, 1))).select("game_pk", "game_date", "is_final"))
        else:
            print(ingest.update_recent_days(store, schedule, box, today, a.days_back, _landed_if(spark, f"{a.landing}/transactions")))
    elif a.job == "odds":
        for season in a.seasons:
            written, account = ingest.ingest_odds(store, ingest.landed_pages(spark, a.landing), season, F.current_timestamp())
            print(season, written)
            show(account)
    elif a.job == "coverage":
        show(planner.odds_coverage(store.read("odds_games", seasons), store.read("odds_ticks", seasons)))
    elif a.job in ("backfill", "snapshots"):
        day = a.today or str(spark.range(1).select(snapshots.league_today(F.current_timestamp())).first()[0])
        return (_backfill if a.job == "backfill" else _snapshots)(store, a, day)
    elif a.job == "archive":
        return _archive(store, a)
    elif a.job == "mirror":
        return _mirror(store, a)
    else:
        show(store.summary())
    return 0


if __name__ == "__main__":
    sys.exit(main())
