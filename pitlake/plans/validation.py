"""Invariant checks: a finding is a row (check, table, rows, detail).

NULLs follow the rule stated with each check: a comparison marked ``differs`` takes
a NULL on either side for a difference.

All checks are counted together.  Each row of each table says a few things (``Said``): that a
condition on it fails, or what it knows of its game.  What is said is summed by game,
and a verdict is an expression over the sums, so a table is scanned once however many
checks it has, and nothing is joined.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.teams import MAX_OUTS, MAX_RUNS, MIN_INNINGS, MIN_OUTS

Tables = dict[str, DataFrame]
FINDING = "check string, table string, rows long, detail string"


def differs(a: Column, b: Column) -> Column:
    return ~F.coalesce(a == b, F.lit(False))


@dataclass(frozen=True)
class Said:
    """What a row says of its game where ``when`` holds.

    It is told apart by ``side`` (a team, say), by the ``parts`` of a finer key, and by
    a ``value`` to be compared; ``left``, ``whole``, ``right`` and ``total`` are summed.
    """

    when: Column | None = None
    side: Column | None = None
    parts: tuple[Column, ...] = ()
    value: Column | None = None
    left: Column | int = 0
    whole: Column | int = 0
    right: Column | int = 0
    total: Column | int = 0

    def token(self, fact: int, game: Column) -> Column:
        """What is said, or NULL where it does not hold."""
        text = lambda x: (F.lit(None) if x is None else x).cast("string")
        number = lambda x: F.lit(x).cast("long")
        part, finer = (*self.parts, None, None)[:2]
        said = F.struct(
            F.lit(fact).cast("short").alias("fact"), game.cast("string").alias("game"), text(self.side).alias("side"), text(part).alias("part"), text(finer).alias("finer"),
            (F.lit(None) if self.value is None else self.value).cast("long").alias("value"),
            number(self.left).alias("left"), number(self.whole).alias("whole"), number(self.right).alias("right"), number(self.total).alias("total"),
        )
        return said if self.when is None else F.when(self.when, said)


#: What the rows of each table say, by fact.
Fact = dict[str, tuple[Said, ...]]


def _facts() -> dict[str, Fact]:
    c = F.col
    outs, one = c("outs_recorded"), {"left": 1, "whole": 1}
    thirds = F.floor(outs / 3)  # of n outs the game has n/3 to n/3 + 1 innings: one number, or two where 3 divides n
    return {
        "game": {"games": (Said(right=1),), "team_games": (Said(left=1),)},
        "plate": {"games": (Said(left=1),), "umpires": (Said(c("is_home_plate"), right=1),)},
        "innings": {
            "games": (Said(c("innings_played").isNotNull(), value=c("innings_played"), right=1),),
            "team_games": (Said(outs.isNotNull(), value=thirds + 1, **one), Said(F.pmod(outs, F.lit(3)) == 0, value=thirds, left=1)),
        },
        "reciprocal": {"team_games": (Said(side=c("team_id"), value=c("runs_scored"), **one), Said(side=c("opponent_team_id"), value=c("runs_allowed"), right=1))},
        "listed": {
            "games": tuple(Said(c("home_score").isNotNull(), F.lit(side), value=c(f"{side}_score"), right=1) for side in ("home", "away")),
            "team_games": (Said(side=F.when(c("home"), "home").otherwise("away"), value=c("runs_scored"), **one),),
        },
        "outs": {"team_games": (Said(side=c("team_id"), value=outs, **one),), "pitcher_appearances": (Said(side=c("team_id"), right=1, total=F.coalesce(outs, F.lit(0))),)},
        "starters": {"pitcher_appearances": (Said(c("is_starter"), c("team_id"), whole=1),)},
        "lineup": {"batter_games": (Said(c("is_starter"), c("team_id"), whole=1),)},
        "openers": {"odds_ticks": (Said(parts=(c("market"), c("book_slug")), right=F.coalesce(c("is_opener").cast("int"), F.lit(0))),)},
        "pitches": {
            "games": (Said(right=1),),
            "statcast_games": (Said(c("fetch_status") == "complete", value=c("pitch_rows"), left=1),),
            "statcast_pitches": (Said(parts=(c("at_bat_number"), c("pitch_number")), whole=1, total=1),),
        },
    }


@dataclass(frozen=True)
class Verdict:
    """How many rows are wrong, from the sums of a ``fact``.

    Where ``early`` the sums are those of the finest key, and each key gives its own number;
    otherwise those of a game, side and value, with ``all_right`` and ``all_total``
    of the game and side.  ``known`` says that the game is not NULL.
    """

    fact: str
    rows: Column
    early: bool = False


@dataclass(frozen=True)
class Check:
    """``bad`` is a condition on single rows, a verdict over what is said of games, or gives the offending rows from the tables.

    Rows given that stand for several say how many in a column ``extra``.  ``needs``
    are further tables that must not be empty, ``uses`` further ones that may be.
    """

    name: str
    table: str
    detail: str
    bad: Column | Verdict | Callable[[Tables], DataFrame]
    needs: tuple[str, ...] = ()
    uses: tuple[str, ...] = ()


def _where(condition: Column, rows: Column | int = 1) -> Column:
    return F.when(condition, rows).otherwise(0)


def _unequal_pairs(fact: str, sided: bool = False) -> Verdict:
    """Pairs of a left and a right row of equal game and side whose values are not the same."""
    joined = F.col("known") & F.col("side").isNotNull() if sided else F.col("known")
    return Verdict(fact, _where(joined, F.col("whole") * F.col("all_right") - _where(F.col("value").isNotNull(), F.col("left") * F.col("right"))))


_runs = lambda *names: reduce(lambda a, b: a | b, ((F.col(n) > MAX_RUNS) for n in names))


def checks() -> list[Check]:
    c = F.col
    alone = ~c("known") | (c("right") == 0)
    other_sum = c("known") & c("side").isNotNull() & (c("all_right") > 0) & differs(c("value"), c("all_total"))
    other_count = c("value") != _where(c("known"), c("all_total"))
    return [
        Check("duplicate_game_pk", "games", "rows beyond the first", Verdict("game", F.greatest(c("right") - 1, F.lit(0)), True)),
        Check("implausible_runs", "games", f"a score under 0 or over {MAX_RUNS}", _runs("home_score", "away_score") | (c("home_score") < 0) | (c("away_score") < 0)),
        Check("final_without_score", "games", "final, no total", c("is_final") & c("total_runs").isNull()),
        Check("total_runs_mismatch", "games", "total is not the sum of the scores", c("total_runs").isNotNull() & differs(c("total_runs"), c("home_score") + c("away_score"))),
        Check("short_game", "games", f"under {MIN_INNINGS} innings", c("innings_played") < MIN_INNINGS),
        Check("same_team_both_sides", "games", "home is away", c("home_team_id") == c("away_team_id")),
        Check("wrong_row_count", "team_games", "games without two rows", Verdict("game", _where(~c("left").isin(0, 2)), True)),
        Check("implausible_runs", "team_games", f"over {MAX_RUNS}", _runs("runs_scored", "runs_allowed")),
        Check("implausible_outs", "team_games", f"outside {MIN_OUTS} to {MAX_OUTS}", (c("outs_recorded") < MIN_OUTS) | (c("outs_recorded") > MAX_OUTS)),
        Check("self_opponent", "team_games", "team is its opponent", c("team_id") == c("opponent_team_id")),
        Check("outs_inconsistent_with_innings", "team_games", "not within an inning of the game's length", _unequal_pairs("innings"), ("games",)),
        Check("runs_not_reciprocal", "team_games", "scored differs from what the opponent allowed", _unequal_pairs("reciprocal", True)),
        Check("runs_disagree_with_games", "team_games", "scored differs from the listed score", _unequal_pairs("listed"), ("games",)),
        Check("orphan_game_pk", "team_games", "no such game", Verdict("game", _where(alone, c("left")), True), ("games",)),
        Check("wrong_starter_count", "pitcher_appearances", "sides with several starters", Verdict("starters", _where(c("whole") != 1), True)),
        Check("implausible_outs", "pitcher_appearances", f"over {MAX_OUTS}", c("outs_recorded") > MAX_OUTS),
        Check("outs_disagree_with_team_game", "pitcher_appearances", "sum of outs differs from the team's", Verdict("outs", _where(other_sum, c("left"))), ("team_games",)),
        Check("wrong_starting_lineup_size", "batter_games", "sides without 9 or 10 starters", Verdict("lineup", _where(~c("whole").isin(9, 10)), True)),
        Check("hits_exceed_at_bats", "batter_games", "hits over at-bats", c("hits") > c("at_bats")),
        Check("extra_base_hits_exceed_hits", "batter_games", "extra-base hits over hits", c("doubles") + c("triples") + c("home_runs") > c("hits")),
        Check("missing_home_plate_umpire", "umpires", "games without", Verdict("plate", _where(alone, c("left")), True), ("umpires", "games")),
        Check("multiple_openers", "odds_ticks", "groups with several", Verdict("openers", _where(c("right") > 1), True)),
        Check("missing_opener", "odds_ticks", "groups without", Verdict("openers", _where(c("right") == 0), True)),
        Check("duplicate_pitch_key", "statcast_pitches", "rows of repeated keys", Verdict("pitches", _where(c("whole") > 1, c("whole")), True)),
        Check("orphan_game_pk", "statcast_pitches", "no such game", Verdict("pitches", _where(~c("known") | (c("all_right") == 0), c("whole"))), ("games",)),
        Check("pitch_row_count_mismatch", "statcast_games", "complete, but another number of pitches", Verdict("pitches", _where(other_count, c("left"))), uses=("statcast_pitches",)),
    ]


def _finding(check: Check, rows: Column) -> Column:
    return F.struct(F.lit(check.name).alias("check"), F.lit(check.table).alias("table"), rows.cast("long").alias("rows"), F.lit(check.detail).alias("detail"))


#: Row checks that one token has bits for.
BITS = 60


def _row_places(together: list[Check]) -> dict[int, tuple[str, int]]:
    """Where the row checks of each table have their bit: check -> (side, bit)."""
    places, many = {}, dict.fromkeys((k.table for k in together), 0)
    for i, k in enumerate(together):
        if isinstance(k.bad, Column):
            places[i] = f"{many[k.table] // BITS}:{k.table}", many[k.table] % BITS
            many[k.table] += 1
    return places


def _numbers() -> dict[str, int]:
    return {fact: n for n, fact in enumerate(("row", *_facts()))}


def _tokens(tables: Tables, together: list[Check]) -> DataFrame:
    """All that the rows say for these checks.

    The row checks of a table speak together: a bit each, where one is wrong.  A row of a needed table says that it is there.
    """
    facts, number = _facts(), _numbers()
    said: dict[str, list[Column]] = {}
    for fact in dict.fromkeys(k.bad.fact for k in together if isinstance(k.bad, Verdict)):
        speakers = {t for k in together if isinstance(k.bad, Verdict) and k.bad.fact == fact for t in (k.table, *k.needs, *k.uses)}
        for table in speakers & set(facts[fact]):
            said.setdefault(table, []).extend(s.token(number[fact], F.col("game_pk")) for s in facts[fact][table])
    bits: dict[tuple[str, str], Column] = {(t, f"0:{t}"): F.lit(0) for k in together for t in k.needs}
    needed = set(bits)
    for i, (side, bit) in _row_places(together).items():
        at = together[i].table, side
        bits[at] = bits.get(at, F.lit(0)) + F.when(together[i].bad, 1 << bit).otherwise(0).cast("long")
    for (table, side), wrong in bits.items():
        row = Said(None if (table, side) in needed else wrong != 0, F.lit(side), value=wrong, whole=1)
        said.setdefault(table, []).append(row.token(number["row"], F.lit(None).cast("string")))
    spoken = (tables[t].select(every[0].alias("s")).select("s.*") if len(every) == 1 else tables[t].select(F.inline(F.array(*every))) for t, every in said.items())
    return reduce(lambda a, b: a.unionByName(b), (s.where("fact is not null") for s in spoken))


def _together(tables: Tables, together: list[Check]) -> DataFrame:
    """Findings of row checks and verdicts.

    Sums by the finest key come first, combined before they are shuffled.  Facts whose
    verdicts are all early go on as one sum a task; of others, keys that are
    finer than a game are then summed up, so what a game's rows are compared by is
    small, and a game with very many rows is spread until then.
    """
    number, places_of = _numbers(), _row_places(together)
    sums = ("left", "whole", "right", "total")
    verdicts = [(i, k.bad) for i, k in enumerate(together) if isinstance(k.bad, Verdict)]
    early: dict[str, list[int]] = {}
    late: dict[str, list[int]] = {}
    for i, v in verdicts:
        (early if v.early else late).setdefault(v.fact, []).append(i)

    def settled(of: dict[str, list[int]], name: str) -> list[Column]:
        """The verdicts of each row's fact, in as many columns as a fact has verdicts."""
        def at(place: int) -> Column:
            own = [(number[fact], together[i[place]].bad.rows) for fact, i in of.items() if len(i) > place]
            return F.coalesce(*(F.when(F.col("fact") == fact, rows.cast("long")) for fact, rows in own), F.lit(0)).alias(f"{name}{place}")

        return [at(place) for place in range(max(map(len, of.values()), default=0))]

    finest = _tokens(tables, together).groupBy("fact", "game", "side", "part", "finer", "value").agg(*(F.sum(s).alias(s) for s in sums))
    finest = finest.withColumn("known", F.col("game").isNotNull()).select("*", *(settled_early := settled(early, "e")))
    kept = [*sums, *(f"e{p}" for p in range(len(settled_early)))]
    later = F.col("fact").isin(number["row"], *(number[fact] for fact in late))
    finest = finest.select("fact", *(F.when(later, F.col(x)).alias(x) for x in ("game", "side", "value")), *kept)
    games = finest.groupBy("fact", "game", "side", "value").agg(*(F.sum(s).alias(s) for s in kept))
    every = Window.partitionBy("fact", "game", "side")
    games = games.withColumns({"known": F.col("game").isNotNull(), "all_right": F.sum("right").over(every), "all_total": F.sum("total").over(every)})
    # a few rows: each fact's verdicts, and which row checks fail together how often
    games = games.select("*", *(settled_late := settled(late, "l")))
    row = F.col("fact") == number["row"]
    found = [f"e{p}" for p in range(len(settled_early))] + [f"l{p}" for p in range(len(settled_late))]
    facts = games.groupBy("fact", F.when(row, F.col("side")).alias("side"), F.when(row, F.col("value")).alias("value")).agg(*(F.sum(x).alias(x) for x in ("whole", *found)))

    def rows(i: int, k: Check) -> Column:
        if isinstance(k.bad, Column):
            side, bit = places_of[i]
            return F.sum(F.when((F.col("fact") == number["row"]) & (F.col("side") == side) & (F.col("value").bitwiseAND(1 << bit) != 0), F.col("whole")))
        of, name = (early, "e") if k.bad.early else (late, "l")
        return F.sum(F.when(F.col("fact") == number[k.bad.fact], F.col(f"{name}{of[k.bad.fact].index(i)}")))

    needed = dict.fromkeys(t for k in together for t in k.needs)
    filled = {t: F.max((F.col("fact") == number["row"]) & (F.col("side") == f"0:{t}")) for t in needed}  # a check against an empty table says nothing
    counts = facts.agg(*(rows(i, k).alias(f"n{i}") for i, k in enumerate(together)), *(has.alias(f"has_{t}") for t, has in filled.items()))
    found = (_finding(k, reduce(lambda n, t: F.when(F.col(f"has_{t}"), n), k.needs, F.col(f"n{i}"))) for i, k in enumerate(together))
    return counts.select(F.inline(F.array(*found)))


def _counted(check: Check, tables: Tables) -> DataFrame:
    bad = check.bad(tables)
    rows = F.coalesce(F.sum("extra"), F.lit(0)) if "extra" in bad.columns else F.count("*")
    one = bad.agg(rows.alias("rows")).select(F.inline(F.array(_finding(check, F.col("rows")))))
    for name in check.needs:
        one = one.where(tables[name].limit(1).agg(F.count("*")).scalar() > 0)
    return one


def validate(tables: Tables, names: list[Check] | None = None) -> DataFrame:
    """All findings with rows > 0, in one query; checks of tables not given are left out."""
    given = [k for k in names or checks() if {k.table, *k.needs, *k.uses} <= set(tables)]
    together = [k for k in given if not callable(k.bad)]
    parts = [_together(tables, together)] if together else []
    parts += [_counted(k, tables) for k in given if callable(k.bad)]
    if not parts:
        raise ValueError("no check has its tables")
    return reduce(lambda a, b: a.unionByName(b), parts).where("rows > 0")


def compare_counts(local: DataFrame, remote: DataFrame) -> DataFrame:
    """(table, local_rows, remote_rows, matches) over all tables of either side."""
    both = local.select("table", F.col("rows").alias("local_rows")).join(remote.select("table", F.col("rows").alias("remote_rows")), "table", "full")
    return both.withColumn("matches", F.coalesce(F.col("local_rows") == F.col("remote_rows"), F.lit(False)))
