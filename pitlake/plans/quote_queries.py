"""Matching, coverage, quotes, scalars and validation, over the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (
    american_probability, backdated_days, decode_line, devig as devig_prices, eastern_date as to_eastern, encode_line as line_code,
    encode_price as price_code, innings_to_outs as outs_of, is_backdated, rate, slug as slug_of, whip,
)
from ..operators.matching import lookup, nearest_match as nearest, nearest_sorted as nearest_of_many
from ..operators.ordered import duplicates
from .features import days_before, rolling_before as rolling
from .planner import book_coverage
from .quotes import tag_ticks
from .registry import query
from .validation import Check, differs, validate

c = F.col


@query(r"SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title, CAST(regexp_extract(html, 'track\(([0-9]+)\)', 1) AS INTEGER) AS track FROM pages", "pages")
def html_extract(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"), F.regexp_extract("html", r"track\(([0-9]+)\)", 1).cast("int").alias("track"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events", "events")
def json_props(events: DataFrame) -> DataFrame:
    return events.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query(
    """SELECT event_id, user_id, CAST(count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS BIGINT) AS n_before,
              round_even(avg(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 6) AS mean_before FROM events""",
    "events",
)
def rolling_before(events: DataFrame) -> DataFrame:
    """Means over the ten events before, in cents so that no order of sums matters."""
    cents = events.withColumn("cents", F.round(c("value") * 100).cast("bigint"))
    df = rolling(cents, ["user_id"], ["ts", "event_id"], "cents", 10, "mean_before", "n_before")
    return df.select("event_id", "user_id", "n_before", F.bround("mean_before", 6).alias("mean_before"))


@query(
    """SELECT event_id, user_id, CAST(count(*) OVER w AS BIGINT) AS n_lookback, CAST(coalesce(sum(CAST(round(value * 100) AS BIGINT)) OVER w, 0) AS BIGINT) AS sum_lookback
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY CAST(floor(epoch(ts)) AS BIGINT) RANGE BETWEEN 259200 PRECEDING AND 1 PRECEDING)""",
    "events",
)
def bullpen_lookback(events: DataFrame) -> DataFrame:
    cents = events.withColumn("cents", F.round(c("value") * 100).cast("bigint"))
    return days_before(cents, ["user_id"], "ts", "cents", 3, "sum_lookback", "n_lookback").select("event_id", "user_id", "n_lookback", "sum_lookback")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
       WHERE date_diff('day', o_orderdate, l_shipdate) < 0 OR date_diff('day', o_orderdate, l_shipdate) > 1000""",
    "lineitem", "orders",
)
def inner_len_check(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    df = lineitem.join(orders.select(c("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    days = F.datediff("l_shipdate", "o_orderdate")
    return df.where((days < 0) | (days > 1000)).select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    """WITH s AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events WHERE event_type IN ('view', 'click') GROUP BY 1, 2)
       SELECT a.day, a.event_type, a.n AS own, b.n AS other FROM s a JOIN s b ON a.day = b.day AND a.event_type <> b.event_type WHERE a.n IS DISTINCT FROM b.n""",
    "events",
)
def self_pair(events: DataFrame) -> DataFrame:
    """Two rows a day that should mirror each other."""
    sums = events.where(c("event_type").isin("view", "click")).groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("own"))
    other = sums.select("day", F.when(c("event_type") == "view", "click").otherwise("view").alias("event_type"), c("own").alias("other"))
    return sums.join(other, ["day", "event_type"]).where(differs(c("own"), c("other")))


@query(
    """SELECT o_orderkey, o_custkey FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_mktsegment <> 'BUILDING'
       WHERE o_orderstatus <> 'P' AND (CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE c_nationkey END) IS DISTINCT FROM (CASE WHEN o_orderkey % 5 = 0 THEN c_nationkey + 1 ELSE coalesce(c_nationkey, -1) END)""",
    "orders", "customer",
)
def left_expected(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """A NULL on one side counts as a difference."""
    side = customer.where("c_mktsegment != 'BUILDING'").select(c("c_custkey").alias("o_custkey"), "c_nationkey")
    df = orders.where("o_orderstatus != 'P'").join(side, "o_custkey", "left")
    a = F.when(c("o_orderkey") % 7 == 0, None).otherwise(c("c_nationkey"))
    b = F.when(c("o_orderkey") % 5 == 0, c("c_nationkey") + 1).otherwise(F.coalesce("c_nationkey", F.lit(-1)))
    return df.where(~a.eqNullSafe(b)).select("o_orderkey", "o_custkey")


@query(
    """WITH s AS (SELECT l_orderkey, sum(CAST(round(l_quantity) AS BIGINT)) AS q FROM lineitem GROUP BY 1),
            h AS (SELECT o_orderkey, coalesce(q, 0) + CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS header FROM orders LEFT JOIN s ON l_orderkey = o_orderkey)
       SELECT o_orderkey, CAST(header AS BIGINT) AS header, CAST(q AS BIGINT) AS lines FROM h JOIN s ON l_orderkey = o_orderkey WHERE header <> q""",
    "lineitem", "orders",
)
def sum_reconcile(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Sums of lines against a header derived from them, off by one on every eleventh order."""
    sums = lineitem.groupBy(c("l_orderkey").alias("o_orderkey")).agg(F.coalesce(F.sum(F.round("l_quantity").cast("bigint")), F.lit(0)).alias("lines"))
    header = orders.select("o_orderkey").join(sums, "o_orderkey", "left").select("o_orderkey", (F.coalesce("lines", F.lit(0)) + F.when(c("o_orderkey") % 11 == 0, 1).otherwise(0)).alias("header"))
    return header.join(sums, "o_orderkey").where(differs(c("header"), c("lines"))).select("o_orderkey", "header", "lines")


@query(
    """WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'), v AS (SELECT * FROM events WHERE event_type = 'view'),
            m AS (SELECT p.event_id, v.event_id AS view_id, CAST(floor(epoch(p.ts)) AS BIGINT) - CAST(floor(epoch(v.ts)) AS BIGINT) AS delta_seconds,
                         count(v.event_id) OVER (PARTITION BY p.event_id) AS n_candidates,
                         row_number() OVER (PARTITION BY p.event_id ORDER BY abs(CAST(floor(epoch(p.ts)) AS BIGINT) - CAST(floor(epoch(v.ts)) AS BIGINT)) NULLS LAST, v.event_id NULLS LAST) AS r
                  FROM p LEFT JOIN v ON p.user_id = v.user_id AND CAST(p.ts AS DATE) = CAST(v.ts AS DATE))
       SELECT event_id, view_id, delta_seconds, n_candidates, CASE WHEN n_candidates = 0 THEN 'no_game' WHEN n_candidates > 1 AND abs(delta_seconds) > 10800 THEN 'not_close' END AS reason FROM m WHERE r = 1""",
    "events",
)
def nearest_match(events: DataFrame) -> DataFrame:
    day = F.to_date("ts").alias("day")
    buys = events.where("event_type = 'purchase'").select("event_id", "user_id", day, "ts")
    views = events.where("event_type = 'view'").select(c("event_id").alias("view_id"), "user_id", day, c("ts").alias("view_ts"))
    return nearest(buys, views, ["user_id", "day"], "event_id", "ts", "view_ts", 3 * 3600, ["view_id"]).select("event_id", "view_id", "delta_seconds", "n_candidates", "reason")


@query(
    """WITH v AS (SELECT user_id, event_id AS view_id, CASE WHEN event_id % 9 > 0 THEN CAST(floor(epoch(ts)) AS BIGINT) END AS s FROM events WHERE event_type = 'view'),
            e AS (SELECT event_id, user_id, CASE WHEN event_id % 13 > 0 THEN CAST(floor(epoch(ts)) AS BIGINT) END AS s FROM events),
            m AS (SELECT event_id, view_id, e.s - v.s AS delta_seconds, count(view_id) OVER (PARTITION BY event_id) AS n_candidates,
                         row_number() OVER (PARTITION BY event_id ORDER BY abs(e.s - v.s) NULLS LAST, view_id NULLS LAST) AS r FROM e LEFT JOIN v USING (user_id))
       SELECT event_id, view_id, delta_seconds, n_candidates, CASE WHEN n_candidates = 0 THEN 'no_game' WHEN n_candidates > 1 AND coalesce(abs(delta_seconds) > 86400, true) THEN 'not_close' END AS reason FROM m WHERE r = 1""",
    "events",
)
def nearest_sorted(events: DataFrame) -> DataFrame:
    """The view nearest to each event of a user, however many there are; some have no time."""
    every = events.select("event_id", "user_id", F.when(c("event_id") % 13 > 0, c("ts")).alias("at"))
    views = events.where("event_type = 'view'").select("user_id", c("event_id").alias("view_id"), F.when(c("event_id") % 9 > 0, c("ts")).alias("seen"))
    return nearest_of_many(every, views, ["user_id"], "event_id", "at", "seen", 86400, ["view_id"]).select("event_id", "view_id", "delta_seconds", "n_candidates", "reason")


@query(
    """SELECT c_custkey, n_name, r_name, CASE WHEN n_nationkey IS NULL THEN 'unknown' END AS nation_reason FROM customer
       LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""",
    "customer", "nation", "region",
)
def lookup_map(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    df = lookup(customer, nation.where("n_regionkey != 2"), "c_nationkey", "n_nationkey", "nation_reason")
    return df.join(region, c("r_regionkey") == c("n_regionkey"), "left").select("c_custkey", "n_name", "r_name", "nation_reason")


@query(
    """WITH g AS (SELECT CAST(ts AS DATE) AS day, event_type, count(DISTINCT user_id) AS games_with_book FROM events GROUP BY 1, 2),
            n AS (SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS games_on_date FROM events GROUP BY 1)
       SELECT day, event_type, games_with_book, games_on_date, games_with_book >= 0.5 * games_on_date AS expected,
              games_with_book >= 0.5 * games_on_date AND games_with_book < games_on_date AS partial FROM g JOIN n USING (day)""",
    "events",
)
def partial_coverage(events: DataFrame) -> DataFrame:
    """Which kinds of event should be complete on a day and are not."""
    return book_coverage(events.withColumn("day", F.to_date("ts")), "day", "event_type", "user_id")


@query(
    """WITH f AS (SELECT event_type, count(*) AS n_ticks, count(DISTINCT user_id) AS n_games, count(*) FILTER (value < 50) AS n_pregame FROM events GROUP BY 1),
            d AS (SELECT event_type, CAST(count(*) FILTER (event_id % 2 = 0) AS BIGINT) AS n_listed FROM events WHERE event_type <> 'error' GROUP BY 1)
       SELECT event_type, n_ticks, n_games, round_even(n_pregame / n_ticks, 4) AS pregame_share, n_listed FROM f LEFT JOIN d USING (event_type)""",
    "events",
)
def coverage_report(events: DataFrame) -> DataFrame:
    facts = events.groupBy("event_type").agg(F.count("*").alias("n_ticks"), F.countDistinct("user_id").alias("n_games"), F.sum((c("value") < 50).cast("int")).alias("n_pregame"))
    listed = events.where("event_type != 'error'").groupBy("event_type").agg(F.sum((c("event_id") % 2 == 0).cast("bigint")).alias("n_listed"))
    return facts.join(listed, "event_type", "left").select("event_type", "n_ticks", "n_games", F.bround(F.try_divide("n_pregame", "n_ticks"), 4).alias("pregame_share"), "n_listed")


@query(
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS season, count(DISTINCT o_custkey) FILTER (o_orderstatus = 'F') AS F, count(DISTINCT o_custkey) FILTER (o_orderstatus = 'O') AS O,
              count(DISTINCT o_custkey) FILTER (o_orderstatus = 'X') AS X FROM orders GROUP BY 1""",
    "orders",
)
def status_pivot(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.year("o_orderdate").alias("season")).pivot("o_orderstatus", ["F", "O", "X"]).agg(F.countDistinct("o_custkey")).na.fill(0)


_TICKS = """t AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'totals' WHEN 1 THEN 'run_line' ELSE 'money_line' END AS market,
    CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 3 = 0 THEN floor(value) % 30 ELSE floor(value) % 24 - 12 + 0.5 END AS l0,
    CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 3 = 0 THEN floor(value) % 30 ELSE -(floor(value) % 24 - 12 + 0.5) END + CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END AS r0,
    CAST(floor(value * 3) AS BIGINT) - 400 AS lp, CAST(floor(value) AS BIGINT) - 200 AS rp, CAST(event_id % 50 AS INTEGER) - 40 AS mins FROM events)"""
_TAGGED = (
    "WITH "
    + _TICKS
    + """, a AS (SELECT *, CASE WHEN market = 'totals' AND abs(l0 - r0) > 1e-9 THEN 'totals_sides_disagree' WHEN market = 'run_line' AND abs(l0 + r0) > 1e-9 THEN 'run_line_not_mirrored' END AS d0 FROM t),
     b AS (SELECT *, CASE WHEN d0 IS NOT NULL THEN NULL WHEN market = 'money_line' AND (l0 IS NOT NULL OR r0 IS NOT NULL) THEN 'moneyline_line_cleared'
            WHEN mins < 0 AND ((market = 'totals' AND (coalesce(l0 NOT BETWEEN 3 AND 25, false) OR coalesce(r0 NOT BETWEEN 3 AND 25, false)))
              OR (market = 'run_line' AND (coalesce(l0 NOT BETWEEN -10 AND 10, false) OR coalesce(r0 NOT BETWEEN -10 AND 10, false)))) THEN 'line_out_of_bounds_cleared' END AS repair_reason FROM a),
     k AS (SELECT *, d0 IS NULL AND market <> 'money_line' AND coalesce(repair_reason <> 'line_out_of_bounds_cleared', true) AS keep FROM b),
     e AS (SELECT event_id, market, d0, repair_reason, CASE WHEN keep THEN CAST(round_even(l0 * 2, 0) AS SMALLINT) END AS left_line, CASE WHEN keep THEN CAST(round_even(r0 * 2, 0) AS SMALLINT) END AS right_line,
            CASE WHEN abs(lp) >= 100 THEN CAST(lp AS SMALLINT) END AS left_price, CASE WHEN abs(rp) >= 100 THEN CAST(rp AS SMALLINT) END AS right_price FROM k),
     f AS (SELECT *, coalesce(d0, CASE WHEN coalesce(left_line, left_price, right_line, right_price) IS NULL THEN 'empty_quote' END) AS drop_reason FROM e)
    """
)


def _ticks(events: DataFrame) -> DataFrame:
    kind = c("event_id") % 3
    line = F.when(kind == 0, F.floor("value") % 30).otherwise(F.floor("value") % 24 - 12 + 0.5)
    left = F.when(c("event_id") % 13 != 0, line)
    right = F.when(c("event_id") % 13 != 0, F.when(kind == 0, line).otherwise(-line)) + F.when(c("event_id") % 17 == 0, 1).otherwise(0)
    return events.select(
        "event_id", F.when(kind == 0, "totals").when(kind == 1, "run_line").otherwise("money_line").alias("market"), left.alias("left_line"), right.alias("right_line"),
        (F.floor(c("value") * 3) - 400).alias("left_price"), (F.floor("value") - 200).alias("right_price"), ((c("event_id") % 50).cast("int") - 40).alias("minutes_to_tip"),
    )


@query(_TAGGED + "SELECT event_id, market, left_line, right_line, left_price, right_price, drop_reason, repair_reason FROM f", "events")
def tick_clean(events: DataFrame) -> DataFrame:
    df = tag_ticks(_ticks(events))
    codes = [c(f"{s}_{w}_code").alias(f"{s}_{w}") for w in ("line", "price") for s in ("left", "right")]
    return df.select("event_id", "market", *codes, "drop_reason", "repair_reason")


@query(_TAGGED + "SELECT reason, count(*) AS n FROM (SELECT drop_reason AS reason FROM f UNION ALL SELECT repair_reason FROM f) WHERE reason IS NOT NULL GROUP BY 1", "events")
def reason_counts(events: DataFrame) -> DataFrame:
    from .quotes import reason_counts as counted

    return counted(tag_ticks(_ticks(events)), "drop_reason", "repair_reason")


@query(
    """WITH n AS (SELECT o_orderkey, count(l_orderkey) AS source_ticks, count(*) FILTER (l_returnflag = 'R') AS usable FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
       SELECT o_orderkey, source_ticks, usable, CASE WHEN source_ticks = 0 THEN 'no_quotes' WHEN usable = 0 THEN 'rejected' ELSE 'complete' END AS ingest_status FROM n""",
    "orders", "lineitem",
)
def ingest_status(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    n = lineitem.groupBy(c("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("source_ticks"), F.count(F.when(c("l_returnflag") == "R", 1)).alias("usable"))
    df = orders.select("o_orderkey").join(n, "o_orderkey", "left").na.fill(0, ["source_ticks", "usable"])
    return df.withColumn("ingest_status", F.when(c("source_ticks") == 0, "no_quotes").when(c("usable") == 0, "rejected").otherwise("complete"))


_PRICE = "CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(floor(value) AS BIGINT) - 250 END"


@query(
    f"""WITH p AS (SELECT event_id, {_PRICE} AS a, 300 - CAST(floor(value) AS BIGINT) AS b FROM events),
        q AS (SELECT event_id, CASE WHEN a > 0 THEN 100.0::DOUBLE / (a + 100) WHEN a < 0 THEN -a::DOUBLE / (-a + 100) END AS x, CASE WHEN b > 0 THEN 100.0::DOUBLE / (b + 100) WHEN b < 0 THEN -b::DOUBLE / (-b + 100) END AS y FROM p)
        SELECT event_id, round_even(x, 6) AS left_p, round_even(x / (x + y), 6) AS fair_left, round_even(y / (x + y), 6) AS fair_right, round_even(x + y - 1, 6) AS overround FROM q""",
    "events",
)
def devig(events: DataFrame) -> DataFrame:
    a, b = F.when(c("event_id") % 9 != 0, F.floor("value") - 250), 300 - F.floor("value")
    df = events.select("event_id", american_probability(a).alias("p"), devig_prices(a, b).alias("d"))
    return df.select("event_id", F.bround("p", 6).alias("left_p"), *(F.bround(f"d.{x}", 6).alias(x) for x in ("fair_left", "fair_right", "overround")))


@query("SELECT event_id, CAST(round_even(round(value) / 2 * 2, 0) AS SMALLINT) AS code, CAST(round_even(round(value) / 2 * 2, 0) AS SMALLINT) / 2.0::DOUBLE AS line FROM events", "events")
def encode_line(events: DataFrame) -> DataFrame:
    return events.select("event_id", line_code(F.round("value") / 2).alias("code")).withColumn("line", decode_line("code"))


@query("SELECT event_id, CASE WHEN abs(p) >= 100 AND abs(p) < 100000 AND p BETWEEN -32768 AND 32767 THEN CAST(p AS SMALLINT) END AS code FROM (SELECT event_id, CAST(floor(value * 100) AS BIGINT) - 25000 AS p FROM events)", "events")
def encode_price(events: DataFrame) -> DataFrame:
    return events.select("event_id", price_code(F.floor(c("value") * 100) - 25000).alias("code"))


@query("SELECT p_partkey, trim(regexp_replace(lower(trim(p_name || ' #' || p_brand || '! ')), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM part", "part")
def slug(part: DataFrame) -> DataFrame:
    return part.select("p_partkey", slug_of(F.concat("p_name", F.lit(" #"), "p_brand", F.lit("! "))).alias("slug"))


@query(
    """SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate, CASE WHEN l_linenumber % 5 <= 2 THEN CAST(CAST(floor(l_quantity) AS INTEGER) * 3 + l_linenumber % 5 AS INTEGER) END AS outs FROM lineitem""",
    "lineitem",
)
def innings_to_outs(lineitem: DataFrame) -> DataFrame:
    text = F.concat(F.floor("l_quantity").cast("string"), F.lit("."), (c("l_linenumber") % 5).cast("string"))
    return lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", outs_of(text).alias("outs"))


@query("SELECT event_id, CAST(ts - INTERVAL 5 HOUR AS DATE) AS slate FROM events", "events")
def eastern_date(events: DataFrame) -> DataFrame:
    """All events are of January: five hours behind."""
    return events.select("event_id", to_eastern("ts").alias("slate"))


@query(
    """WITH s AS (SELECT l_orderkey, CAST(sum(l_linenumber) AS BIGINT) AS walks, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS outs, count(*) AS hits FROM lineitem GROUP BY 1)
       SELECT l_orderkey, round_even(hits / walks, 6) AS hit_rate, round_even(outs / 3, 6) AS innings, round_even((walks + hits) / round_even(outs / 3, 6), 6) AS whip FROM s""",
    "lineitem",
)
def rate_stats(lineitem: DataFrame) -> DataFrame:
    s = lineitem.groupBy("l_orderkey").agg(F.sum("l_linenumber").alias("walks"), F.sum(c("l_quantity").cast("bigint")).alias("outs"), F.count("*").alias("hits"))
    return s.select("l_orderkey", rate("hits", "walks").alias("hit_rate"), rate("outs", F.lit(3)).alias("innings"), whip(c("walks"), c("hits"), c("outs")).alias("whip"))


@query("SELECT doc_id, contains(lower(text), 'license') OR contains(lower(text), 'rights reserved') OR contains(lower(text), 'token') AS marked FROM documents", "documents")
def text_markers(documents: DataFrame) -> DataFrame:
    low = F.lower("text")
    return documents.select("doc_id", reduce(lambda a, b: a | b, (F.contains(low, F.lit(m)) for m in ("license", "rights reserved", "token"))).alias("marked"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(date_diff('day', l_shipdate, o_orderdate) AS INTEGER) AS backdated_days, coalesce(date_diff('day', l_shipdate, o_orderdate) > 0, false) AS is_backdated
       FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus <> 'P'""",
    "lineitem", "orders",
)
def backdating(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    df = lineitem.join(orders.where("o_orderstatus != 'P'").select(c("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey", "left")
    return df.select("l_orderkey", "l_linenumber", "l_partkey", backdated_days("o_orderdate", "l_shipdate").alias("backdated_days"), is_backdated("o_orderdate", "l_shipdate").alias("is_backdated"))


@query(
    """WITH f AS (
         SELECT 'duplicate_line' AS "check", 'lineitem' AS "table", coalesce(sum(n - 1), 0) AS "rows" FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
         UNION ALL SELECT 'implausible_quantity', 'lineitem', count(*) FROM lineitem WHERE l_quantity > 45 OR l_quantity < 1
         UNION ALL SELECT 'orphan_line', 'lineitem', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
         UNION ALL SELECT 'order_without_lines', 'orders', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
         UNION ALL SELECT 'shipped_before_order', 'lineitem', count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_shipdate < o_orderdate
         UNION ALL SELECT 'negative_price', 'orders', count(*) FROM orders WHERE o_totalprice < 0)
       SELECT "check", "table", CAST("rows" AS BIGINT) AS "rows", 'see the check' AS detail FROM f WHERE "rows" > 0""",
    "orders", "lineitem",
)
def validate_all(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    keyed = orders.withColumnRenamed("o_orderkey", "l_orderkey")
    extra = lambda t: duplicates(t["lineitem"], ["l_orderkey", "l_linenumber"])
    found = [
        Check("duplicate_line", "lineitem", "see the check", extra),
        Check("implausible_quantity", "lineitem", "see the check", (c("l_quantity") > 45) | (c("l_quantity") < 1)),
        Check("orphan_line", "lineitem", "see the check", lambda t: t["lineitem"].join(keyed.select("l_orderkey"), "l_orderkey", "left_anti"), ("orders",)),
        Check("order_without_lines", "orders", "see the check", lambda t: keyed.join(t["lineitem"].select("l_orderkey"), "l_orderkey", "left_anti"), ("lineitem",)),
        Check("shipped_before_order", "lineitem", "see the check", lambda t: t["lineitem"].join(keyed.select("l_orderkey", "o_orderdate"), "l_orderkey").where("l_shipdate < o_orderdate"), ("orders",)),
        Check("negative_price", "orders", "see the check", c("o_totalprice") < 0),
    ]
    return validate({"orders": orders, "lineitem": lineitem}, found)


@query(
    """SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS mean_q, round(stddev_samp(l_quantity), 6) AS std_q, round(avg(CASE WHEN l_discount > 0.05 THEN 1.0 ELSE 0.0 END), 6) AS share, round(corr(l_quantity, l_tax), 4) AS r
       FROM lineitem GROUP BY 1""",
    "lineitem",
)
def outcome_stats(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.round(F.avg("l_quantity"), 6).alias("mean_q"), F.round(F.stddev_samp("l_quantity"), 6).alias("std_q"),
        F.round(F.avg((c("l_discount") > 0.05).cast("double")), 6).alias("share"), F.round(F.corr("l_quantity", "l_tax"), 4).alias("r"),
    )


@query(
    """SELECT event_id, user_id, round_even(CAST(2 * coalesce(lag(cents, 1) OVER w, 0) + coalesce(lag(cents, 2) OVER w, 0) AS DOUBLE) / (CASE WHEN lag(cents, 1) OVER w IS NULL THEN NULL ELSE 2 END + CASE WHEN lag(cents, 2) OVER w IS NULL THEN 0 ELSE 1 END), 6) AS weighted_before
       FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "events",
)
def weighted_before(events: DataFrame) -> DataFrame:
    """The last two values, the later one twice as heavy."""
    from .features import weighted_before as weighted

    cents = events.withColumn("cents", F.round(c("value") * 100).cast("bigint"))
    return weighted(cents, ["user_id"], ["ts", "event_id"], "cents", 2, "weighted_before").select("event_id", "user_id", F.bround("weighted_before", 6).alias("weighted_before"))


