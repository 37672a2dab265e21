"""Scans, writes, manifests and set operations, over the driver's tables."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.gaps import distinct_keys, incomplete, missing, missing_dates, missing_since_first, refresh_dates, union_dates
from ..operators.ordered import duplicates, flag_first, keep_best_game, keep_first, keep_last, last_before
from ..session import scratch_dir
from ..sources.store import Store
from .archive import discover, manifest, row_counts, upload
from .mirror_sync import open_mirror, sync_odds
from .registry import query

c = F.col
_LINE = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS season, o_totalprice FROM orders WHERE year(o_orderdate) IN (1996, 1997)", "orders")
def partition_scan(orders: DataFrame) -> DataFrame:
    """A range of the stored column, which reaches the scan; a function of it would not."""
    first, end = (F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1998-01-01"))
    return orders.where((c("o_orderdate") >= first) & (c("o_orderdate") < end)).select("o_orderkey", F.year("o_orderdate").alias("season"), "o_totalprice")


@query("SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL", "lineitem")
def distinct_key_scan(lineitem: DataFrame) -> DataFrame:
    return distinct_keys(lineitem, "l_orderkey")


@query(
    """SELECT 'orders' AS table_name, count(*) AS n_rows, count(DISTINCT year(o_orderdate)) AS n_partitions,
              CAST(min(year(o_orderdate)) AS INTEGER) AS first_partition, CAST(max(year(o_orderdate)) AS INTEGER) AS last_partition FROM orders
       UNION ALL SELECT 'lineitem', count(*), count(DISTINCT year(l_shipdate)), CAST(min(year(l_shipdate)) AS INTEGER), CAST(max(year(l_shipdate)) AS INTEGER) FROM lineitem
       UNION ALL SELECT 'events', count(*), count(DISTINCT year(ts)), CAST(min(year(ts)) AS INTEGER), CAST(max(year(ts)) AS INTEGER) FROM events""",
    "orders", "lineitem", "events",
)
def table_summary(orders: DataFrame, lineitem: DataFrame, events: DataFrame) -> DataFrame:
    def one(df: DataFrame, name: str, date: str) -> DataFrame:
        p = F.year(date)
        return df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"), F.countDistinct(p).alias("n_partitions"), F.min(p).alias("first_partition"), F.max(p).alias("last_partition"))

    return one(orders, "orders", "o_orderdate").unionByName(one(lineitem, "lineitem", "l_shipdate")).unionByName(one(events, "events", "ts"))


@query(
    """WITH k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_shipdate >= TIMESTAMP '1999-01-01'
                  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS r FROM lineitem),
            d AS (SELECT * FROM k WHERE r = 1),
            incoming AS (SELECT * FROM d WHERE l_shipdate >= TIMESTAMP '1999-01-01'),
            stored AS (SELECT * FROM d WHERE l_shipdate < TIMESTAMP '1999-01-01')
       SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, 'kept' AS origin FROM stored s
       WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.l_orderkey = s.l_orderkey AND i.l_linenumber = s.l_linenumber)
       UNION ALL SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, 'incoming' FROM incoming""",
    "lineitem",
)
def upsert_keep_last(lineitem: DataFrame) -> DataFrame:
    cut, key = F.lit("1999-01-01").cast("timestamp_ntz"), ["l_orderkey", "l_linenumber"]
    incoming = keep_last(lineitem.where(c("l_shipdate") >= cut), key, "l_shipdate", *_LINE)
    stored = keep_last(lineitem.where(c("l_shipdate") < cut), key, "l_shipdate", *_LINE)
    out = [*key, "l_shipdate", "l_quantity"]
    return missing(stored, incoming, key).select(*out, F.lit("kept").alias("origin")).unionByName(incoming.select(*out, F.lit("incoming").alias("origin")))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') OR l_returnflag = 'R'""",
    "orders", "lineitem",
)
def replace_children(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The children of open orders are replaced by those that came back."""
    parents = orders.where("o_orderstatus = 'P'").select(c("o_orderkey").alias("l_orderkey"))
    rest = missing(lineitem, parents, ["l_orderkey"])
    fresh = lineitem.where("l_returnflag = 'R'").join(parents, "l_orderkey", "left_semi")
    return rest.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag").unionByName(fresh.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"))


@query(
    """SELECT c_custkey, CAST(CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN round(c_acctbal * 100) ELSE round(c_acctbal * 100) + 1 END AS BIGINT) AS cents FROM customer""",
    "customer",
)
def insert_only_merge(customer: DataFrame) -> DataFrame:
    """Stored segments win; the batch offers every customer with another balance."""
    cents = F.round(c("c_acctbal") * 100).cast("bigint")
    stored = customer.where(c("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", cents.alias("cents"))
    return stored.unionByName(missing(customer.select("c_custkey", (cents + 1).alias("cents")), stored, ["c_custkey"]))


@query(
    """WITH b AS (SELECT DISTINCT p_brand AS slug FROM part), old AS (SELECT slug, row_number() OVER (ORDER BY slug DESC) AS id FROM b WHERE slug < 'Brand#2'),
            new AS (SELECT slug, (SELECT max(id) FROM old) + row_number() OVER (ORDER BY slug) AS id FROM b WHERE slug NOT IN (SELECT slug FROM old))
       SELECT slug, CAST(id AS BIGINT) AS id FROM old UNION ALL SELECT slug, CAST(id AS BIGINT) FROM new""",
    "part",
)
def surrogate_keys(part: DataFrame) -> DataFrame:
    """Known brands keep their ids, new ones go on from the largest in order of their names."""
    brands = part.select(c("p_brand").alias("slug")).distinct()
    old = brands.where(c("slug") < "Brand#2").withColumn("id", F.row_number().over(Window.orderBy(c("slug").desc())).cast("bigint"))
    from .mirror import assign_ids

    return assign_ids(old, brands, "slug", "id")


@query(
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS season, count(*) AS n_seen, count(*) FILTER (o_orderstatus IN ('F', 'O')) AS n_loaded,
              count(*) FILTER (o_orderstatus = 'P') AS n_dropped, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM orders GROUP BY 1""",
    "orders",
)
def load_meta(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.year("o_orderdate").alias("season")).agg(
        F.count("*").alias("n_seen"), F.count(F.when(c("o_orderstatus").isin("F", "O"), 1)).alias("n_loaded"),
        F.count(F.when(c("o_orderstatus") == "P", 1)).alias("n_dropped"), F.sum(c("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total"),
    )


@query(
    """WITH f AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS season, count(*) AS n, sum(length(o_orderpriority)) AS bytes FROM orders GROUP BY 1)
       SELECT count(*) AS object_count, CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(bytes) AS BIGINT) AS byte_count FROM f WHERE season < 2000""",
    "orders",
)
def manifest_totals(orders: DataFrame) -> DataFrame:
    files = orders.groupBy(F.year("o_orderdate").alias("season")).agg(F.count("*").alias("n"), F.sum(F.length("o_orderpriority")).alias("bytes"))
    return files.where("season < 2000").agg(F.count("*").alias("object_count"), F.sum("n").alias("row_count"), F.sum("bytes").alias("byte_count"))


@query(
    """SELECT action, count(*) AS n FROM (SELECT CASE WHEN p_size > 40 THEN 'upload' WHEN p_size % 5 = 0 THEN 'changed' ELSE 'skip' END AS action FROM part) GROUP BY 1""",
    "part",
)
def upload_classify(part: DataFrame) -> DataFrame:
    """A remote store that lacks large parts and has other sizes of every fifth."""
    from .archive import classify_uploads

    local = part.select(c("p_partkey").cast("string").alias("key"), c("p_size").cast("long").alias("size"), c("p_name").alias("sha256"))
    remote = part.where("p_size <= 40").select(c("p_partkey").cast("string").alias("key"), F.when(c("p_size") % 5 == 0, c("p_size") + 1).otherwise(c("p_size")).cast("long").alias("size"), c("p_name").alias("sha256"))
    return classify_uploads(local, remote).groupBy("action").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '5-LOW') AND CAST(o_orderdate AS DATE) NOT IN (DATE '1998-10-03', DATE '1997-05-28')", "orders")
def final_filter(orders: DataFrame) -> DataFrame:
    days = F.to_date(c("o_orderdate"))
    dates = [F.lit(d).cast("date") for d in ("1998-10-03", "1997-05-28")]
    return orders.where((c("o_orderstatus") == "F") & c("o_orderpriority").isin("1-URGENT", "5-LOW") & ~days.isin(*dates)).select("o_orderkey", "o_orderstatus")


@query(
    """SELECT count(*) FILTER (o_orderdate <= TIMESTAMP '1998-10-03') AS known, count(*) FILTER (o_orderdate < TIMESTAMP '1998-10-03') AS known_before FROM orders""",
    "orders",
)
def asof_known(orders: DataFrame) -> DataFrame:
    from .snapshots import known_before, known_by

    cut = F.lit("1998-10-03").cast("timestamp_ntz")
    before = known_before(orders, "o_orderdate", cut).agg(F.count("*")).scalar()
    return known_by(orders, "o_orderdate", cut).agg(F.count("*").alias("known")).withColumn("known_before", before)


@query("SELECT DISTINCT CAST(o_orderdate AS DATE) AS o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1999-03-01' - 30 AND DATE '1999-03-01' - 1", "orders")
def refresh_window(orders: DataFrame) -> DataFrame:
    return refresh_dates(orders, "o_orderdate", F.lit("1999-03-01").cast("date"), 30)


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 25", "orders")
def limit_oldest(orders: DataFrame) -> DataFrame:
    from .planner import oldest

    return oldest(orders, 25, "o_orderdate", "o_orderkey").select("o_orderkey", "o_orderdate")


_ALL = "l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag"


@query(
    f"""SELECT l_orderkey, l_partkey, l_shipdate FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
        ORDER BY (l_linestatus = 'F') DESC, CASE WHEN l_quantity > 45 THEN NULL ELSE l_shipdate END ASC NULLS LAST, {_ALL}, l_shipdate) AS r FROM lineitem) WHERE r = 1""",
    "lineitem",
)
def keep_best(lineitem: DataFrame) -> DataFrame:
    by = F.struct(*_ALL.split(", "), "l_shipdate")
    games = lineitem.select(
        c("l_orderkey").alias("game_pk"), (c("l_linestatus") == "F").alias("is_final"), F.when(~(c("l_quantity") > 45), c("l_shipdate")).alias("first_pitch_utc"),
        by.alias("ordinal"), "l_partkey", "l_shipdate",
    )
    return keep_best_game(games, "ordinal").select(c("game_pk").alias("l_orderkey"), "l_partkey", "l_shipdate")


@query(
    f"""SELECT l_orderkey, l_linenumber, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, {_ALL}, l_linestatus) AS r FROM lineitem) WHERE r = 1""",
    "lineitem",
)
def keep_first_children(lineitem: DataFrame) -> DataFrame:
    order = [c(x) for x in ("l_shipdate", *_ALL.split(", "), "l_linestatus")]
    return keep_first(lineitem, ["l_orderkey", "l_linenumber"], order).select("l_orderkey", "l_linenumber", "l_suppkey")


@query("SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1 AS is_opener FROM events", "events")
def opener_flag(events: DataFrame) -> DataFrame:
    return flag_first(events, ["user_id", "event_type"], [c("ts"), c("event_id")], "is_opener").select("event_id", "user_id", "event_type", "is_opener")


@query(
    """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r
       FROM events WHERE ts < TIMESTAMP '2024-01-20') WHERE r = 1""",
    "events",
)
def closing_quote(events: DataFrame) -> DataFrame:
    return last_before(events, ["user_id", "event_type"], "ts", F.lit("2024-01-20").cast("timestamp_ntz"), "event_id").select("user_id", "event_type", "event_id", "value")


@query(
    """SELECT user_id, hour, event_id, value FROM (SELECT *, date_trunc('hour', ts) AS hour, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
    "events",
)
def minute_collapse(events: DataFrame) -> DataFrame:
    """The last quote of an hour (few events share a minute)."""
    df = events.withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return keep_last(df, ["user_id", "hour"], "ts", "event_id").select("user_id", "hour", "event_id", "value")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n, count(*) - 1 AS extra FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1", "lineitem")
def dup_counts(lineitem: DataFrame) -> DataFrame:
    return duplicates(lineitem, ["l_orderkey", "l_linenumber"])


@query(f"SELECT l_orderkey, l_partkey, l_shipdate, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, {_ALL}, l_linestatus) AS INTEGER) AS position FROM lineitem", "lineitem")
def ordinal_position(lineitem: DataFrame) -> DataFrame:
    by = Window.partitionBy("l_orderkey").orderBy("l_shipdate", *_ALL.split(", "), "l_linestatus")
    return lineitem.select("l_orderkey", "l_partkey", "l_shipdate", F.row_number().over(by).alias("position"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')", "orders", "lineitem")
def gap_intersect(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Finished orders that lack returned or accepted lines."""
    keyed = lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    parents = orders.where("o_orderstatus = 'F'").select("o_orderkey")
    return incomplete(parents, [keyed.where("l_returnflag = 'R'"), keyed.where("l_returnflag = 'A'")], "o_orderkey")


@query(
    """WITH stored AS (SELECT * FROM orders WHERE o_orderstatus = 'P' AND o_orderdate >= TIMESTAMP '1997-01-01')
       SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= (SELECT min(o_orderdate) FROM stored)
       AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'N')""",
    "orders", "lineitem",
)
def gap_bounded(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    stored = orders.where((c("o_orderstatus") == "P") & (c("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")))
    done = lineitem.where("l_returnflag = 'N'").select(c("l_orderkey").alias("o_orderkey")).distinct()
    return missing_since_first(orders.where("o_orderstatus = 'F'"), done, "o_orderkey", "o_orderdate", stored).select("o_orderkey", "o_orderdate")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'P')", "lineitem", "orders")
def orphan_anti(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    kept = orders.where("o_orderstatus != 'P'").select(c("o_orderkey").alias("l_orderkey"))
    return missing(lineitem, kept, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT CAST(ts AS DATE) AS day FROM events UNION SELECT CAST(o_orderdate AS DATE) FROM orders", "events", "orders")
def union_of_dates(events: DataFrame, orders: DataFrame) -> DataFrame:
    return union_dates(events.select(F.to_date("ts").alias("day")), orders.select(F.to_date("o_orderdate").alias("day")))


@query(
    """SELECT CAST(d AS DATE) AS ts FROM generate_series(TIMESTAMP '2023-12-20', TIMESTAMP '2024-02-10', INTERVAL 1 DAY) g(d)
       WHERE CAST(d AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE event_type = 'purchase' )""",
    "events",
)
def missing_days(events: DataFrame) -> DataFrame:
    some = events.where("event_type = 'purchase'")
    return missing_dates(some, "ts", F.lit("2023-12-20").cast("date"), F.lit("2024-02-10").cast("date"))


@query(
    """WITH caps AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS slate, ts AS captured FROM events WHERE ts < TIMESTAMP '2024-01-15 12:00:00'),
            last AS (SELECT event_type, slate, max(captured) AS captured FROM caps GROUP BY 1, 2)
       SELECT e.event_type, l.slate, l.captured, e.event_id, e.value FROM last l JOIN events e ON e.event_type = l.event_type AND e.ts = l.captured""",
    "events",
)
def snapshot_asof(events: DataFrame) -> DataFrame:
    """Per kind and day the last capture strictly before an instant, with its rows."""
    from .snapshots import latest_capture

    data = events.select(c("event_type").alias("kind"), F.to_date("ts").alias("slate_date"), c("ts").alias("captured_at_utc"), "event_id", "value")
    headers = data.select("kind", "slate_date", "captured_at_utc").distinct()
    last = latest_capture(headers, F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    found = data.join(last, ["kind", "slate_date", "captured_at_utc"])
    return found.select(c("kind").alias("event_type"), c("slate_date").alias("slate"), c("captured_at_utc").alias("captured"), "event_id", "value")


# -- the store itself, in a folder of its own ----------------------------------------------


def _moves(orders: DataFrame, shift: int = 0) -> DataFrame:
    """Orders as rows of the transactions table."""
    return orders.select(
        c("o_orderkey").cast("string").alias("transaction_id"), (c("o_custkey") + shift).cast("string").alias("player_id"), F.year("o_orderdate").alias("season_year"),
        F.to_date("o_orderdate").alias("known_date"), (c("o_orderkey") % 100).alias("seq"),
    )


def _fresh_store(df: DataFrame) -> Store:
    return Store(df.sparkSession, scratch_dir(df.sparkSession))


_MOVE = "CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(year(o_orderdate) AS INTEGER) AS season_year"


@query(
    f"""SELECT {_MOVE}, CAST(CASE WHEN o_orderkey % 3 = 0 AND year(o_orderdate) > 1996 THEN o_custkey + 7 ELSE o_custkey END AS VARCHAR) AS player_id FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 AND year(o_orderdate) > 1996""",
    "orders",
)
def store_upsert(orders: DataFrame) -> DataFrame:
    """Even orders are stored; then a batch of every third of the later years, each twice, of which the last by its ordinal stays."""
    store = _fresh_store(orders)
    store.upsert("transactions", _moves(orders.where("o_orderkey % 2 = 0")))
    batch = orders.where((c("o_orderkey") % 3 == 0) & (F.year("o_orderdate") > 1996))
    store.upsert("transactions", _moves(batch, 5).withColumn("seq", F.lit(1)).unionByName(_moves(batch, 7).withColumn("seq", F.lit(2))), ordinal="seq")
    return store.read("transactions").select("transaction_id", "season_year", "player_id")


@query(
    f"""SELECT {_MOVE}, CAST(CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE o_custkey + 7 END AS VARCHAR) AS player_id FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0""",
    "orders",
)
def store_insert_only(orders: DataFrame) -> DataFrame:
    store = _fresh_store(orders)
    store.upsert("transactions", _moves(orders.where("o_orderkey % 2 = 0")))
    store.insert_only("transactions", _moves(orders.where("o_orderkey % 3 = 0"), 7))
    return store.read("transactions").select("transaction_id", "season_year", "player_id")


@query(
    f"""SELECT {_MOVE}, CAST(CASE WHEN year(o_orderdate) = 1997 THEN o_custkey + 7 ELSE o_custkey END AS VARCHAR) AS player_id FROM orders WHERE year(o_orderdate) IN (1996, 1998) OR year(o_orderdate) = 1997 AND o_orderkey % 5 = 0""",
    "orders",
)
def store_rewrite(orders: DataFrame) -> DataFrame:
    """One partition rewritten; a reading of three partitions."""
    store = _fresh_store(orders)
    store.upsert("transactions", _moves(orders))
    store.rewrite("transactions", _moves(orders.where("o_orderkey % 5 = 0"), 7), 1997)
    return store.read("transactions", [1996, 1997, 1998]).select("transaction_id", "season_year", "player_id")


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS game_pk, CASE WHEN o_orderkey % 4 = 0 AND year(o_orderdate) = 1996 THEN 'z' ELSE u END AS official_id FROM orders, (SELECT unnest(['a', 'b']) AS u)
       WHERE year(o_orderdate) IN (1995, 1996) AND NOT (o_orderkey % 4 = 0 AND year(o_orderdate) = 1996 AND (u = 'b' OR o_orderkey % 8 = 0))""",
    "orders",
)
def store_replace_children(orders: DataFrame) -> DataFrame:
    """Two officials a game; a correction leaves one, another one, to every fourth game of a season and none to every eighth."""
    store = _fresh_store(orders)
    rows = orders.where(F.year("o_orderdate").isin(1995, 1996)).select(
        c("o_orderkey").cast("string").alias("game_pk"), F.year("o_orderdate").alias("season_year"), F.to_date("o_orderdate").alias("game_date"), F.lit("u").alias("official_type"), F.lit(False).alias("is_home_plate")
    )
    store.upsert("umpires", rows.withColumn("official_id", F.explode(F.array(F.lit("a"), F.lit("b")))))
    key = c("game_pk").cast("long")
    parents = rows.where((key % 4 == 0) & (c("season_year") == 1996))
    store.replace_children("umpires", parents.where(key % 8 != 0).withColumn("official_id", F.lit("z")), parents.select("game_pk"), 1996)
    return store.read("umpires").select("game_pk", "official_id")


class _Killed(Store):
    """A writer that dies when its files are written and before they are published; its lock stays."""

    def _announce(self, spec, number, files):
        self._fs.rename(self._path(f"{self.root}/_lock_{spec.name}"), self._path(f"{self.root}/_held"))
        raise InterruptedError


@query(
    f"""SELECT {_MOVE}, CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_custkey + 7 ELSE o_custkey END AS VARCHAR) AS player_id, 2 AS "version" FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0
        UNION ALL SELECT {_MOVE}, CAST(o_custkey AS VARCHAR), 1 FROM orders WHERE o_orderkey % 2 = 0""",
    "orders",
)
def store_recovery(orders: DataFrame) -> DataFrame:
    """A writer dies before it publishes: readers still see the rows before it (version 1); the next takes its lock away and writes (version 2)."""
    store = _fresh_store(orders)
    store.upsert("transactions", _moves(orders.where("o_orderkey % 2 = 0")))
    with contextlib.suppress(InterruptedError):
        _Killed(store.spark, store.root).upsert("transactions", _moves(orders.where("o_orderkey % 3 = 0"), 5))
    before = store.read("transactions")
    store._fs.rename(store._path(f"{store.root}/_held"), store._path(f"{store.root}/_lock_transactions"))
    patient = Store(store.spark, store.root, lock_seconds=-1)  # its owner counts as dead at once
    patient.recover()
    patient.upsert("transactions", _moves(orders.where("o_orderkey % 3 = 0"), 7))
    rows = lambda df, version: df.select("transaction_id", "season_year", "player_id", F.lit(version).alias("version"))
    return rows(before, 1).unionByName(rows(patient.read("transactions"), 2))


@query(
    f"""SELECT {_MOVE}, CAST(CASE WHEN o_orderkey = m THEN o_custkey + 7 ELSE o_custkey END AS VARCHAR) AS player_id, 1 AS files_replaced FROM orders, (SELECT min(o_orderkey) AS m FROM orders)""",
    "orders",
)
def store_file_grain(orders: DataFrame) -> DataFrame:
    """One row of a table is replaced: one of its files is rewritten, whatever the size of its partition."""
    store = _fresh_store(orders)
    store.upsert("transactions", _moves(orders))
    before = set(store.version("transactions").files)
    first = orders.agg(F.min("o_orderkey")).first()[0]
    store.upsert("transactions", _moves(orders.where(c("o_orderkey") == first), 7))
    replaced = len(before - set(store.version("transactions").files))
    return store.read("transactions").select("transaction_id", "season_year", "player_id", F.lit(replaced).alias("files_replaced"))


@query(
    """SELECT 'transactions' AS "table", count(*) AS n_rows, count(DISTINCT year(o_orderdate)) AS n_partitions, CAST(min(year(o_orderdate)) AS INTEGER) AS first_partition, CAST(max(year(o_orderdate)) AS INTEGER) AS last_partition FROM orders""",
    "orders",
)
def store_summary(orders: DataFrame) -> DataFrame:
    store = _fresh_store(orders)
    store.upsert("transactions", _moves(orders))
    if [int(p) for p in store.partitions("transactions")] != sorted({r[0] for r in store.keys("transactions", "season_year").collect()}):  # a few seasons
        raise AssertionError("the folder listing and the rows differ")
    return store.summary().where("n_rows > 0")


@query(
    """SELECT 'book_' || o_orderstatus AS slug, count(*) AS n, count(DISTINCT o_orderkey) AS games FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1""",
    "orders",
)
def mirror_load(orders: DataFrame) -> DataFrame:
    """A season of quotes into the mirror, twice: the second loading adds nothing."""
    store = _fresh_store(orders)
    season = orders.where(F.year("o_orderdate") == 1997)
    base = season.select(
        c("o_orderkey").cast("string").alias("game_pk"), F.lit(1997).alias("season_year"), F.to_date("o_orderdate").alias("game_date"), F.lit("totals").alias("market"),
        F.concat(F.lit("book_"), "o_orderstatus").alias("book_slug"), c("o_orderdate").alias("line_ts"), F.lit(-5).alias("mins_to_tip"), F.lit(True).alias("is_pregame"), F.lit(True).alias("is_opener"),
        c("o_orderkey").cast("int").alias("event_id"), c("o_orderdate").alias("first_pitch_utc"), F.lit(False).alias("is_doubleheader"), F.lit(1).alias("game_number"), F.lit("complete").alias("ingest_status"),
        F.lit(1).alias("source_tick_count"),
    )
    store.upsert("odds_ticks", base)
    store.upsert("odds_games", base)
    target = open_mirror(orders.sparkSession, scratch_dir(orders.sparkSession))
    for _ in range(2):
        sync_odds(store, target, 1997, F.lit("2025-01-01 00:00:00").cast("timestamp"))
    lines = target.read("odds_lines", [1997]).join(target.read("books"), "book_id")
    return lines.groupBy("slug").agg(F.count("*").alias("n"), F.countDistinct("game_pk").alias("games"))


@query(
    """SELECT count(*) AS object_count, CAST(sum(n) AS BIGINT) AS row_count FROM (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders WHERE year(o_orderdate) < 1998 GROUP BY 1)""",
    "orders",
)
def archive_manifest(orders: DataFrame) -> DataFrame:
    """Files of old partitions: rows by their footers, and by a scan that reads no column."""
    spark, root = orders.sparkSession, scratch_dir(orders.sparkSession)
    rows = orders.withColumn("season_year", F.year("o_orderdate"))
    rows.repartition("season_year").write.partitionBy("season_year").parquet(root)
    files = discover(spark, root, 1998)
    scanned = row_counts(spark, files, root).withColumnRenamed("rows", "scanned")
    return manifest(files.join(scanned, "path").where("rows = scanned")).select("object_count", "row_count")


@query(
    """SELECT season, CAST(count(*) AS BIGINT) AS n_rows, 'copied,present' AS results FROM (SELECT year(o_orderdate) AS y, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders) WHERE y < 1998 GROUP BY 1""",
    "orders",
)
def archive_upload(orders: DataFrame) -> DataFrame:
    """Old partitions are copied, verified, and read from where they went; doing it again copies nothing."""
    spark, root, target = orders.sparkSession, scratch_dir(orders.sparkSession), scratch_dir(orders.sparkSession)
    store = Store(spark, root)
    store.upsert("transactions", _moves(orders))
    files = discover(spark, root, 1998, live=[f"transactions/{f}" for f in store.version("transactions").files])
    results = [",".join(sorted(r[0] for r in upload(files, target).select("result").distinct().collect())) for _ in range(2)]
    there = spark.read.parquet(f"{target}/archive/transactions")
    return there.groupBy(c("season_year").alias("season")).agg(F.count("*").alias("n_rows")).withColumn("results", F.lit(",".join(results)))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS game_pk, CAST(o_custkey AS VARCHAR) AS player_id FROM orders WHERE year(o_orderdate) = 1995", "orders")
def store_season_ids(orders: DataFrame) -> DataFrame:
    """The games of one season's partition, with their rows."""
    store = _fresh_store(orders)
    rows = orders.select(
        c("o_orderkey").cast("string").alias("game_pk"), F.lit("t").alias("team_id"), c("o_custkey").cast("string").alias("player_id"), F.year("o_orderdate").alias("season_year"), F.to_date("o_orderdate").alias("game_date")
    )
    store.upsert("lineups", rows)
    return store.game_ids("lineups", 1995).join(store.read("lineups", [1995]), "game_pk").select("game_pk", "player_id")
