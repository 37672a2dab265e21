"""Scalar functions one by one, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions.teams import GAME_TYPES, INGESTED, INJURY_MARKERS, POSTSEASON, alias_table, team_table
from ..operators.ordered import with_position
from .registry import query

c = F.col


def key() -> Column:
    return c("o_orderkey")



def _text(*pieces: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in pieces))


@query(
    """SELECT o_orderkey, nullif(trim(CASE WHEN o_orderkey % 5 = 0 THEN '  ' WHEN o_orderkey % 7 = 0 THEN NULL ELSE ' ' || o_orderkey || ' ' END), '') AS id FROM orders""",
    "orders",
)
def id_text(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", s.as_id(F.when(key() % 5 == 0, "  ").when(key() % 7 == 0, None).otherwise(_text(" ", key(), " "))).alias("id"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN o_orderkey || '.5' ELSE CAST(o_orderkey AS VARCHAR) END AS id FROM orders""",
    "orders",
)
def id_number(orders: DataFrame) -> DataFrame:
    number = F.when(key() % 11 == 0, F.lit(float("nan"))).when(key() % 3 == 0, None).when(key() % 4 == 0, key() + 0.5).otherwise(key().cast("double"))
    return orders.select("o_orderkey", s.as_id_number(number).alias("id"))


_NUMBER_SQL = "CASE o_orderkey % 6 WHEN 0 THEN o_orderkey || '.7' WHEN 1 THEN ' ' || o_orderkey WHEN 2 THEN '-.--' WHEN 3 THEN NULL WHEN 4 THEN '-' || o_orderkey ELSE '' END"


def _number() -> Column:
    kind = key() % 6
    said = F.when(kind == 0, _text(key(), ".7")).when(kind == 1, _text(" ", key())).when(kind == 2, "-.--").when(kind == 3, None)
    return said.when(kind == 4, _text("-", key())).otherwise("")


@query(
    f"""SELECT o_orderkey, CAST(trunc(try_cast(trim({_NUMBER_SQL}) AS DOUBLE)) AS INTEGER) AS number, CAST(coalesce(trunc(try_cast(trim({_NUMBER_SQL}) AS DOUBLE)), -1) AS INTEGER) AS or_default FROM orders""",
    "orders",
)
def int_from_text(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", s.to_int(_number()).alias("number"), s.to_int(_number(), -1).alias("or_default"))


@query(
    f"""SELECT o_orderkey, CASE WHEN regexp_full_match(trim(x), '-?[0-9]+') THEN CAST(trim(x) AS INTEGER) END AS whole, try_cast(trim(x) AS DOUBLE) AS number FROM (SELECT o_orderkey, {_NUMBER_SQL} AS x FROM orders)""",
    "orders",
)
def strict_numbers(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", s.strict_int(_number()).alias("whole"), s.strict_float(_number()).alias("number"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS known, CASE WHEN o_orderkey % 4 = 0 THEN 9 ELSE CAST(o_orderkey % 4 AS INTEGER) END AS first_of FROM orders""",
    "orders",
)
def nan_and_fallback(orders: DataFrame) -> DataFrame:
    price = F.when(key() % 3 == 0, F.lit(float("nan"))).otherwise(c("o_totalprice"))
    return orders.select("o_orderkey", s.nan_to_null(price).alias("known"), s.or_else((key() % 4).cast("int"), F.lit(9)).alias("first_of"))


@query(
    """SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate, CAST(l_linenumber AS INTEGER) AS lineup_slot, CAST(l_suppkey % 3 AS INTEGER) AS substitution_index FROM lineitem""",
    "lineitem",
)
def batting_order(lineitem: DataFrame) -> DataFrame:
    """An order of '402' is the second substitute of slot 4."""
    order = (c("l_linenumber") * 100 + c("l_suppkey") % 3).cast("string")
    return lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", s.lineup_slot(order).alias("lineup_slot"), s.substitution_index(order).alias("substitution_index"))


@query(
    """SELECT o_orderkey, CASE WHEN ab + bb + hbp + sf > 0 THEN round_even(CAST(h + bb + hbp AS DOUBLE) / (ab + bb + hbp + sf), 6) END AS obp
       FROM (SELECT o_orderkey, o_orderkey % 5 AS h, o_orderkey % 3 AS bb, o_orderkey % 2 AS hbp, o_orderkey % 7 AS ab, o_orderkey % 4 // 3 AS sf FROM orders)""",
    "orders",
)
def on_base(orders: DataFrame) -> DataFrame:
    flies = F.floor(key() % 4 / 3)
    return orders.select("o_orderkey", s.obp(key() % 5, key() % 3, key() % 2, key() % 7, flies).alias("obp"))


@query(
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(epoch(date_trunc('minute', ts)) // 60 AS BIGINT) WHEN 1 THEN CAST(epoch(date_trunc('minute', ts)) // 60 - 120 AS BIGINT) END AS minute FROM events""",
    "events",
)
def instant_from_text(events: DataFrame) -> DataFrame:
    """Instants that name their offset, as minutes since 1970; others are NULL."""
    stamp, kind = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), c("event_id") % 3
    text = F.concat(stamp, F.when(kind == 0, "Z").when(kind == 1, "+02:00").otherwise(""))
    return events.select("event_id", F.floor(F.unix_timestamp(s.parse_utc(text)) / 60).alias("minute"))


@query(
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS season, make_date(year(o_orderdate), 2, 1) AS first_day, make_date(year(o_orderdate), 12, 15) AS last_day FROM orders""",
    "orders",
)
def season_bounds(orders: DataFrame) -> DataFrame:
    season = s.season_of("o_orderdate")
    return orders.select("o_orderkey", season.alias("season"), s.season_start(season).alias("first_day"), s.season_end(season).alias("last_day"))


@query(
    """SELECT l_orderkey, l_partkey, l_linenumber, CAST(date_diff('day', o_orderdate, l_shipdate) * 1440 AS INTEGER) AS minutes FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "lineitem", "orders",
)
def minutes_before_start(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    df = lineitem.join(orders.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")
    return df.select("l_orderkey", "l_partkey", "l_linenumber", s.minutes_to_start("l_shipdate", "o_orderdate").alias("minutes"))


@query(
    """SELECT p_partkey, upper(left(w[1], 1)) || lower(substr(w[1], 2)) || ' ' || upper(left(w[2], 1)) || lower(substr(w[2], 2)) AS shown,
              nullif(trim(CASE WHEN p_size % 2 = 0 THEN trim(p_brand) || ' ' ELSE '' END || CASE WHEN p_size % 3 = 0 THEN trim(p_name) ELSE '' END), '') AS full_name,
              CASE WHEN p_size % 4 = 0 THEN nullif(trim(p_type), '') ELSE nullif(trim(p_brand), '') END AS team
       FROM (SELECT *, ['part', CAST(p_partkey AS VARCHAR)] AS w FROM part)""",
    "part",
)
def names(part: DataFrame) -> DataFrame:
    full = s.full_name(F.when(c("p_size") % 2 == 0, c("p_brand")), F.when(c("p_size") % 3 == 0, c("p_name")))
    team = s.team_name(F.when(c("p_size") % 4 == 0, c("p_type")).otherwise("  "), "p_brand")
    return part.select("p_partkey", s.display_name(_text("part_", c("p_partkey"))).alias("shown"), full.alias("full_name"), team.alias("team"))


_CODES = [*GAME_TYPES, "X"]
_CODE_SQL = "list_extract([" + ", ".join(f"'{x}'" for x in _CODES) + f"], CAST(o_orderkey % {len(_CODES)} AS INTEGER) + 1)"


@query(
    f"""SELECT o_orderkey, CASE code {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in GAME_TYPES.items())} ELSE 'Unknown' END AS name,
               code IN {POSTSEASON} AS is_postseason, code IN {INGESTED} AS is_ingested FROM (SELECT o_orderkey, {_CODE_SQL} AS code FROM orders)""",
    "orders",
)
def game_types(orders: DataFrame) -> DataFrame:
    code = F.get(F.array(*(F.lit(x) for x in _CODES)), (key() % len(_CODES)).cast("int"))
    return orders.select("o_orderkey", s.game_type_name(code).alias("name"), s.is_postseason(code).alias("is_postseason"), s.is_ingested(code).alias("is_ingested"))


_MOVE_SQL = "CASE p_size % 4 WHEN 0 THEN 'Placed on the 10-day Injured List. ' WHEN 1 THEN 'optioned ' WHEN 2 THEN 'on the RESTRICTED list' END"


@query(
    f"""SELECT p_partkey, {" OR ".join(f"contains(lower(concat_ws(' ', {_MOVE_SQL}, p_name)), '{m}')" for m in INJURY_MARKERS)} AS injury FROM part""",
    "part",
)
def injury_moves(part: DataFrame) -> DataFrame:
    kind = c("p_size") % 4
    move = F.when(kind == 0, "Placed on the 10-day Injured List. ").when(kind == 1, "optioned ").when(kind == 2, "on the RESTRICTED list")
    return part.select("p_partkey", s.is_injury(move, "p_name").alias("injury"))


@query("SELECT l_orderkey, l_partkey, l_linenumber, coalesce(CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_quantity END BETWEEN 3 AND 25, true) AS plausible FROM lineitem", "lineitem")
def plausible_lines(lineitem: DataFrame) -> DataFrame:
    line = F.when(c("l_suppkey") % 5 != 0, c("l_quantity"))
    return lineitem.select("l_orderkey", "l_partkey", "l_linenumber", s.within(line, 3, 25).alias("plausible"))


@query(
    """SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'Boston Red Sox' WHEN 1 THEN 'New York Yankees' WHEN 2 THEN 'Los Angeles Dodgers' END AS team,
              CASE n_nationkey % 4 WHEN 0 THEN '111' WHEN 1 THEN '147' WHEN 2 THEN '119' END AS team_id, CASE n_nationkey % 4 WHEN 0 THEN 'AL' WHEN 1 THEN 'AL' WHEN 2 THEN 'NL' END AS league FROM nation""",
    "nation",
)
def team_spellings(nation: DataFrame) -> DataFrame:
    """Spellings of sources to the team dimension; strangers stay unknown."""
    kind = c("n_nationkey") % 4
    said = nation.select("n_nationkey", F.when(kind == 0, "Red Sox").when(kind == 1, "NYA").when(kind == 2, "L.A. Dodgers").otherwise("Mars").alias("alias"))
    known = alias_table(nation.sparkSession).select("alias", "team_id").join(team_table(nation.sparkSession), "team_id")
    return said.join(F.broadcast(known), "alias", "left").select("n_nationkey", c("team_name").alias("team"), "team_id", "league")


@query(
    """SELECT p_partkey, w[i] AS word, CAST(i AS INTEGER) AS slot FROM (SELECT p_partkey, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT p_partkey, string_split(p_type || ' ' || p_name, ' ') AS w FROM part))""",
    "part",
)
def positions(part: DataFrame) -> DataFrame:
    words = part.select("p_partkey", F.split(F.concat_ws(" ", "p_type", "p_name"), " ").alias("words"))
    return with_position(words, "words", "word", "slot").select("p_partkey", "word", "slot")
