"""Registered warehouse queries over the driver's tables, and the SQL that they are held against."""

from __future__ import annotations

import uuid
from datetime import datetime
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions.columns import json_int, money, safe_ratio
from lakemill.operators import bitemporal, dimensions, hierarchy, keys, lookups, paths, rules, sketches, summaries
from lakemill.operators.intervals import overlap_join
from lakemill.operators.skew import salted_join
from lakemill.plans import loads
from lakemill.sources.clustered import read_within, write_clustered
from lakemill.sources.formats import append, read_appended, read_version, shared_dir
from lakemill.sources.tables import read
from lakemill.streaming.ingest import drain_into, stream_files, totals, totals_into
from lakemill.streaming.joins import answers_within, first_answers
from lakemill.streaming.sessions import numbered, session_changes, sessions_of

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("""
SELECT r_name, CAST(year(o_orderdate) AS INTEGER) AS o_year,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue, count(*) AS n_lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY 1, 2""")
def star_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue and lines by the customer's region and the order's year."""
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias("net"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("o_year"))
    place = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "r_name")
    return (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(place, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("r_name", "o_year")
        .agg(F.sum("net").cast("double").alias("revenue"), F.count("*").alias("n_lines"))
    )


@query("""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS day, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS iso_weekday, isodow(d) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders))""")
def date_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each day of the span of orders."""
    span = read(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return dimensions.date_dimension(span, "lo", "hi")


_KEY = "concat_ws('|', coalesce(length(c_name) || ':' || c_name, '-'), coalesce(length(CAST(c_nationkey AS VARCHAR)) || ':' || CAST(c_nationkey AS VARCHAR), '-'))"


@query(f"SELECT md5({_KEY}) AS short_key, sha256({_KEY}) AS long_key, c_custkey FROM customer")
def natural_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash keys of customers from their name and nation."""
    return read(spark, sf_dir, "customer").select(dimensions.natural_key("c_name", "c_nationkey", bits=128).alias("short_key"), dimensions.natural_key("c_name", "c_nationkey").alias("long_key"), "c_custkey")


def _later_customers(rows: DataFrame) -> DataFrame:
    """A second snapshot: each 13th customer gone, each 7th in another segment, each 50th also under a new key."""
    segment = F.when(F.col("c_custkey") % 7 == 0, F.lit("MOVED")).otherwise(F.col("c_mktsegment"))
    kept = rows.where("c_custkey % 13 <> 0").withColumn("c_mktsegment", segment)
    return kept.unionByName(rows.where("c_custkey % 50 = 0").withColumn("c_custkey", F.col("c_custkey") + 10_000_000))


_LATER = """later AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_custkey % 7 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 13 <> 0
  UNION ALL SELECT c_custkey + 10000000, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 50 = 0)"""


@query(f"WITH {_LATER} SELECT * FROM later UNION ALL SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM later)")
def upsert_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type 1 upsert of a later snapshot into the customer dimension."""
    rows = read(spark, sf_dir, "customer")
    return dimensions.upsert(rows, _later_customers(rows), "c_custkey")


@query(f"""WITH {_LATER} SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN o.c_custkey IS NULL THEN 'I' WHEN n.c_custkey IS NULL THEN 'D'
  WHEN o.c_name IS DISTINCT FROM n.c_name OR o.c_nationkey IS DISTINCT FROM n.c_nationkey OR o.c_acctbal IS DISTINCT FROM n.c_acctbal OR o.c_mktsegment IS DISTINCT FROM n.c_mktsegment THEN 'U' ELSE 'S' END AS change
FROM customer o FULL JOIN later n ON o.c_custkey = n.c_custkey""")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each customer changed between two snapshots."""
    rows = read(spark, sf_dir, "customer")
    return dimensions.snapshot_diff(rows, _later_customers(rows), "c_custkey")


@query("SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's latest event."""
    return dimensions.latest(read(spark, sf_dir, "events"), "user_id", F.desc("ts"), F.desc("event_id"))


_HISTORY = """
SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER w AS valid_to, lead(ts) OVER w IS NULL AS is_current FROM (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM (
    SELECT * FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS later FROM {source}) WHERE later IS NULL OR later > ts)) WHERE before IS NULL OR before <> event_type
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""


@query(_HISTORY.format(source="events"))
def user_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type 2 history of each user's event type."""
    return dimensions.history(read(spark, sf_dir, "events"), "user_id", "ts", "event_type", "event_id")


@query(_HISTORY.format(source="events"))
def merged_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history, from that of the days before the 16th and the later changes."""
    events = read(spark, sf_dir, "events")
    early = F.dayofmonth("ts") < 16
    log = ("user_id", "ts", "event_type", "event_id")
    points = dimensions.change_points(events.where(early), *log)
    return dimensions.merge_history(dimensions.history(points, *log), points, events.where(~early), *log)


#: Events reach the warehouse in loads of ten days; each fifth comes a load late.
_LOADED = "(SELECT *, CAST(1 + (day(ts) - 1) // 10 + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) AS load FROM events)"


def _loaded(events: DataFrame) -> DataFrame:
    return events.withColumn("load", (1 + F.floor((F.dayofmonth("ts") - 1) / 10) + (F.col("event_id") % 5 == 0).cast("long")).cast("long"))


def _two_times(spark: SparkSession, events: DataFrame) -> DataFrame:
    """The two-time history of users' event types, loaded load by load into a table."""
    path = _scratch(spark, "two-times")
    for load in range(1, 5):
        loads.load_changes(spark, path, events.where(F.col("load") == load), "user_id", "ts", "event_type", "event_id", load)
    return read_appended(spark, path)


_RECTANGLES = """
SELECT user_id, event_type AS value, ts AS valid_from, valid_to, known AS known_from, lead(known) OVER (PARTITION BY event_id ORDER BY known) AS known_to FROM (
  SELECT *, lag(known) OVER w IS NULL OR valid_to IS DISTINCT FROM lag(valid_to) OVER w AS new FROM (
    SELECT e.*, known, lead(ts) OVER (PARTITION BY known, user_id ORDER BY ts, event_id) AS valid_to FROM {log} e, (SELECT unnest(range(1, 5)) AS known) WHERE load <= known)
  WINDOW w AS (PARTITION BY event_id ORDER BY known)) WHERE new"""


@query(f"SELECT * FROM ({_RECTANGLES.format(log=_LOADED)}) WHERE valid_to IS NULL OR valid_to > valid_from")
def two_time_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was known of each user's event type over time, and from which load to which, from four loads with late events."""
    return bitemporal.rectangles(_two_times(spark, _loaded(read(spark, sf_dir, "events"))), "user_id")


@query(_HISTORY.format(source=f"(SELECT * FROM {_LOADED} WHERE load <= 2)"))
def history_as_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of users' event types as it was known after the second of four loads."""
    found = bitemporal.known_history(_two_times(spark, _loaded(read(spark, sf_dir, "events"))), "user_id", 2)
    return found.withColumnRenamed("value", "event_type")


@query(f"""WITH log AS {_LOADED}, states AS ({_RECTANGLES.format(log="(SELECT * FROM log WHERE event_type <> 'purchase')")}),
asked AS (SELECT event_id, user_id, ts, load FROM log WHERE event_type = 'purchase'),
found AS (SELECT event_id, known_from <= load AND (known_to IS NULL OR known_to > load) AS then_, known_to IS NULL AS now_, value FROM asked JOIN states
  ON asked.user_id = states.user_id AND ts >= valid_from AND (valid_to IS NULL OR ts < valid_to))
SELECT event_id, user_id, ts, load, (SELECT max(value) FROM found WHERE found.event_id = asked.event_id AND then_) AS reported, (SELECT max(value) FROM found WHERE found.event_id = asked.event_id AND now_) AS corrected FROM asked""")
def reported_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with its user's state at the time, as known when the purchase was loaded and as known after the last load."""
    events = _loaded(read(spark, sf_dir, "events"))
    table = _two_times(spark, events.where("event_type <> 'purchase'"))
    asked = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "load").withColumn("last", F.lit(4).cast("long"))
    reported = bitemporal.as_known(asked, table, "user_id", "ts", "load", "reported")
    return bitemporal.as_known(reported, table, "user_id", "ts", "last", "corrected").drop("last")


_SESSIONS = """SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts FROM (
  SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
    SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 24 HOUR THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s"""


@query(f"""WITH s AS ({_SESSIONS}), h AS ({_HISTORY.format(source="events")})
SELECT s.user_id, first_ts, last_ts, event_type, valid_from, valid_to, greatest(first_ts, valid_from) AS overlap_from, CASE WHEN valid_to < last_ts THEN valid_to ELSE last_ts END AS overlap_to
FROM s JOIN h ON s.user_id = h.user_id AND first_ts < last_ts AND first_ts < coalesce(valid_to, TIMESTAMP '9999-01-01') AND valid_from < last_ts""")
def session_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The states that each session of a user passes through, with the time of each that lies in the session."""
    events = read(spark, sf_dir, "events")
    spans = summaries.sessions(events, "user_id", "ts", "24 hours").drop("n_events")
    states = dimensions.history(events, "user_id", "ts", "event_type", "event_id").drop("is_current")
    return overlap_join(spans, states, "user_id", ("first_ts", "last_ts"), ("valid_from", "valid_to"))


@query(f"""WITH past AS ({_HISTORY.format(source="(SELECT * FROM events WHERE event_type <> 'purchase')")})
SELECT p.event_id, p.user_id, p.ts, past.event_type AS state FROM (SELECT * FROM events WHERE event_type = 'purchase') p
LEFT JOIN past ON p.user_id = past.user_id AND p.ts >= past.valid_from AND (past.valid_to IS NULL OR p.ts < past.valid_to)""")
def point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with its user's state at the time, from the history of the other event types."""
    events = read(spark, sf_dir, "events")
    past = dimensions.history(events.where("event_type <> 'purchase'"), "user_id", "ts", "event_type", "event_id").withColumnRenamed("event_type", "state")
    return lookups.point_in_time(events.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), past, "user_id", "ts", "state")


@query("""SELECT c.event_id, c.user_id, c.ts, p.event_id AS purchase_id, p.value AS purchase_value FROM (SELECT * FROM events WHERE event_type = 'click') c
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON c.user_id = p.user_id AND c.ts >= p.ts""")
def as_of_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each click with its user's latest purchase."""
    events = read(spark, sf_dir, "events")
    bought = events.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("p_ts"), F.col("event_id").alias("purchase_id"), F.col("value").alias("purchase_value"))
    return lookups.as_of(events.where("event_type = 'click'").select("event_id", "user_id", "ts"), bought, "user_id", "ts", "p_ts", ["purchase_id", "purchase_value"])


@query("""SELECT coalesce(s_suppkey, -1) AS l_suppkey, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
FROM lineitem LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 <> 0) ON l_suppkey = s_suppkey GROUP BY 1""")
def unknown_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by supplier, where suppliers that the dimension lacks count as -1."""
    known = read(spark, sf_dir, "supplier").where("s_suppkey % 10 <> 0")
    facts = lookups.with_unknown(read(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity"), known, "l_suppkey", "s_suppkey")
    return facts.groupBy("l_suppkey").agg(F.count("*").alias("n_lines"), F.sum(money("l_quantity")).cast("double").alias("quantity"))


@query("""SELECT s_suppkey, s_name, s_nationkey, s_acctbal, FALSE AS is_placeholder FROM supplier WHERE s_suppkey % 10 <> 0
UNION ALL SELECT DISTINCT l_suppkey, NULL, NULL, NULL, TRUE FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 <> 0)""")
def late_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplier dimension with placeholders for suppliers that only lines have."""
    return dimensions.placeholders(read(spark, sf_dir, "supplier").where("s_suppkey % 10 <> 0"), read(spark, sf_dir, "lineitem"), "s_suppkey", "l_suppkey")


@query("""SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""")
def late_dimension_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The placeholders after the missing suppliers have arrived by an upsert."""
    suppliers = read(spark, sf_dir, "supplier")
    held = dimensions.placeholders(suppliers.where("s_suppkey % 10 <> 0"), read(spark, sf_dir, "lineitem"), "s_suppkey", "l_suppkey")
    return dimensions.upsert(held.drop("is_placeholder"), suppliers.where("s_suppkey % 10 = 0"), "s_suppkey")


@query("""WITH moves AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS moved FROM orders GROUP BY 1, 2),
scaffold AS (SELECT c_custkey, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM customer, (SELECT min(month) AS lo, max(month) AS hi FROM moves))
SELECT c_custkey, s.month, CAST(coalesce(moved, 0) AS DOUBLE) AS moved, CAST(sum(coalesce(moved, 0)) OVER (PARTITION BY c_custkey ORDER BY s.month) AS DOUBLE) AS balance
FROM scaffold s LEFT JOIN moves m ON s.c_custkey = m.o_custkey AND s.month = m.month""")
def monthly_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by customer and month with a running balance."""
    moves = read(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    rows = summaries.monthly_balance(read(spark, sf_dir, "customer"), moves, "c_custkey", "o_orderdate", money("o_totalprice"))
    return rows.withColumns({"moved": F.col("moved").cast("double"), "balance": F.col("balance").cast("double")})


def _levels(kind: str) -> str:
    return f"""SELECT c_mktsegment, o_orderpriority, CAST(grouping(c_mktsegment) AS INTEGER) AS g_segment, CAST(grouping(o_orderpriority) AS INTEGER) AS g_priority,
CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY {kind}"""


def _leveled(kind: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Order totals by segment and priority at several levels."""
        rows = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        groups = {
            "rollup": lambda: rows.rollup("c_mktsegment", "o_orderpriority"),
            "cube": lambda: rows.cube("c_mktsegment", "o_orderpriority"),
            "sets": lambda: rows.groupingSets([[F.col("c_mktsegment"), F.col("o_orderpriority")], [F.col("o_orderpriority")], []], F.col("c_mktsegment"), F.col("o_orderpriority")),
        }[kind]()
        return groups.agg(F.grouping("c_mktsegment").cast("int").alias("g_segment"), F.grouping("o_orderpriority").cast("int").alias("g_priority"), F.sum(money("o_totalprice")).cast("double").alias("total"), F.count("*").alias("n_orders"))

    run.__name__ = f"totals_{kind}"
    return run


totals_rollup = query(_levels("ROLLUP (c_mktsegment, o_orderpriority)"))(_leveled("rollup"))
totals_cube = query(_levels("CUBE (c_mktsegment, o_orderpriority)"))(_leveled("cube"))
totals_sets = query(_levels("GROUPING SETS ((c_mktsegment, o_orderpriority), (o_orderpriority), ())"))(_leveled("sets"))


@query("SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(value) AS n FROM events GROUP BY 1")
def incremental_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by event type, from those of the days before the 21st and those of the later days."""
    events = read(spark, sf_dir, "events")
    early = F.dayofmonth("ts") < 21
    both = summaries.merged(summaries.partials(events.where(early), "event_type", money("value")), summaries.partials(events.where(~early), "event_type", money("value")), "event_type")
    return both.withColumn("total", F.col("total").cast("double"))


def _sketched_lines(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """Sketches of lines by flag and year of shipping, from two loads of a table, as one by flag."""
    path, early = _scratch(spark, "sketches"), F.coalesce(F.year("l_shipdate") < 1998, F.lit(False))
    for load, part in enumerate((lines.where(early), lines.where(~early))):
        made = sketches.sketched(part, ["l_returnflag", "year"], {"orders": F.col("l_orderkey")}, {"prices": F.col("l_extendedprice")})
        append(made, path, load)
    return sketches.united(read_appended(spark, path), ["l_returnflag"], ["orders"], ["prices"])


@query("SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_orders, TRUE AS within_error FROM lineitem GROUP BY 1")
def sketched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders by flag, and whether the count from stored sketches is within the stated error."""
    lines = read(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    exact = lines.groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").alias("n_orders"))
    near = F.abs(sketches.distinct_count("orders") - F.col("n_orders")) <= sketches.distinct_error() * F.col("n_orders")
    return exact.join(_sketched_lines(spark, lines), "l_returnflag").select("l_returnflag", "n_orders", near.alias("within_error"))


@query("SELECT l_returnflag, share, TRUE AS within_error FROM (SELECT DISTINCT l_returnflag FROM lineitem), (SELECT unnest([0.01, 0.1, 0.5, 0.9, 0.99]::DOUBLE[]) AS share)")
def sketched_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of prices by flag from stored sketches: whether the share of prices up to each is within the stated error."""
    lines = read(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    shares = [0.01, 0.1, 0.5, 0.9, 0.99]
    found = _sketched_lines(spark, lines).select("l_returnflag", F.explode(F.array(*[F.struct(F.lit(s).alias("share"), sketches.quantile("prices", s).alias("value")) for s in shares])).alias("q")).select("l_returnflag", "q.*")
    upto = F.avg((F.col("l_extendedprice") <= F.col("value")).cast("double"))
    below = F.avg((F.col("l_extendedprice") < F.col("value")).cast("double"))
    ranks = lines.select("l_returnflag", "l_extendedprice").join(F.broadcast(found), "l_returnflag").groupBy("l_returnflag", "share").agg(upto.alias("upto"), below.alias("below"))  # five rows a flag
    near = (F.col("upto") >= F.col("share") - sketches.rank_error()) & (F.col("below") <= F.col("share") + sketches.rank_error())
    return ranks.select("l_returnflag", "share", near.alias("within_error"))


_SKEWED = "(SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_orderkey % 50 = 1 THEN NULL ELSE l_partkey END AS key FROM lineitem)"


@query(f"""SELECT key, p_brand, CAST(l_linenumber AS INTEGER) AS l_linenumber, count(*) AS n_lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
FROM {_SKEWED} LEFT JOIN part ON key = p_partkey GROUP BY ALL""")
def skewed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their part, where one part has a third of all lines and some lines have none; summed by part and line number."""
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).when(F.col("l_orderkey") % 50 == 1, F.lit(None)).otherwise(F.col("l_partkey")).cast("long")
    lines = read(spark, sf_dir, "lineitem").select(key.alias("key"), "l_orderkey", "l_linenumber", "l_extendedprice")
    found = salted_join(lines, read(spark, sf_dir, "part").select("p_partkey", "p_brand"), "key", "p_partkey", "left", task_rows=20_000)
    return found.groupBy("key", "p_brand", "l_linenumber").agg(F.count("*").alias("n_lines"), F.sum(money("l_extendedprice")).cast("double").alias("price"))


@query("""SELECT 'line key is unique' AS rule, CAST(coalesce(sum(m), 0) AS BIGINT) AS n_bad FROM (SELECT count(*) AS m FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'line has its order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'order has lines', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'discount is a share', count(*) FROM lineitem WHERE NOT coalesce(l_discount BETWEEN 0 AND 1, FALSE)
UNION ALL SELECT 'customer is named', count(*) FROM customer WHERE c_name IS NULL OR c_name = ''
UNION ALL SELECT 'line ships after its order', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE NOT coalesce(l_shipdate >= o_orderdate, FALSE)""")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that break each of six rules."""
    line, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    return rules.report(
        rules.unique("line key is unique", line, "l_orderkey", "l_linenumber"),
        rules.foreign_key("line has its order", line, "l_orderkey", orders, "o_orderkey"),
        rules.foreign_key("order has lines", orders, "o_orderkey", line, "l_orderkey"),
        rules.holds("discount is a share", line, F.col("l_discount").between(0, 1)),
        rules.holds("customer is named", read(spark, sf_dir, "customer"), F.col("c_name") != ""),
        rules.holds("line ships after its order", line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")), F.col("l_shipdate") >= F.col("o_orderdate")),
    )


@query("""SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_events FROM (
  SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
    SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 24 HOUR THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s""")
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' sessions, which a gap of a day ends."""
    return summaries.sessions(read(spark, sf_dir, "events"), "user_id", "ts", "24 hours")


_STEPS = ["signup", "click", "purchase", "error"]


@query(f"""WITH o AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS o FROM events),
s1 AS (SELECT user_id, min(o) AS a FROM o WHERE event_type = '{_STEPS[0]}' GROUP BY 1),
s2 AS (SELECT o.user_id, min(o) AS a FROM o JOIN s1 ON o.user_id = s1.user_id AND o > a WHERE event_type = '{_STEPS[1]}' GROUP BY 1),
s3 AS (SELECT o.user_id, min(o) AS a FROM o JOIN s2 ON o.user_id = s2.user_id AND o > a WHERE event_type = '{_STEPS[2]}' GROUP BY 1),
s4 AS (SELECT o.user_id, min(o) AS a FROM o JOIN s3 ON o.user_id = s3.user_id AND o > a WHERE event_type = '{_STEPS[3]}' GROUP BY 1)
SELECT user_id, CAST((user_id IN (SELECT user_id FROM s1))::INT + (user_id IN (SELECT user_id FROM s2))::INT + (user_id IN (SELECT user_id FROM s3))::INT + (user_id IN (SELECT user_id FROM s4))::INT AS INTEGER) AS steps
FROM (SELECT DISTINCT user_id FROM events)""")
def path_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many steps of a path each user has taken in order."""
    events = read(spark, sf_dir, "events")
    return paths.steps_reached(events, paths.bucket_maps(events, "user_id", "ts", "event_id", "event_type", _STEPS), "user_id")


_PARENTS = """edges AS (SELECT DISTINCT child, parent FROM (
  SELECT p_partkey AS child, CASE WHEN p_partkey = 1 THEN 5 ELSE p_partkey // (2 + p_size % 3) END AS parent FROM part
  UNION ALL SELECT p_partkey, p_partkey // 5 FROM part WHERE p_partkey % 2 = 0) WHERE parent > 0)"""


def _part_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hierarchy of parts: a parent by number and size, another for even numbers, and a cycle through part 1."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_size")
    first = part.select(F.col("p_partkey").alias("child"), F.when(F.col("p_partkey") == 1, 5).otherwise(F.expr("p_partkey div (2 + p_size % 3)")).alias("parent"))
    second = part.where("p_partkey % 2 = 0").select("p_partkey", F.expr("p_partkey div 5"))
    return first.union(second).where("parent > 0")


# A shortest way passes no node twice, so the walk by steps ends where it would go on in the cycle: 40 steps are over twice the depth at any of the test sizes.
_ABOVE = f"""{_PARENTS}, steps AS (SELECT child AS node, parent AS ancestor, 1 AS depth FROM edges
  UNION SELECT node, parent, depth + 1 FROM steps JOIN edges ON ancestor = child WHERE depth < 40),
pairs AS (SELECT node, ancestor, CAST(min(depth) AS INTEGER) AS depth FROM steps GROUP BY 1, 2)"""


@query(f"WITH RECURSIVE {_ABOVE} SELECT * FROM pairs")
def part_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ancestors of each part in the hierarchy of parts."""
    return hierarchy.closure(_part_edges(spark, sf_dir), "child", "parent")


@query(f"""WITH RECURSIVE {_ABOVE}, own AS (SELECT l_partkey AS node, sum(CAST(l_quantity AS DECIMAL(18,2))) AS q, count(*) AS n FROM lineitem GROUP BY 1),
up AS (SELECT node, q AS own, q AS part, n FROM own UNION ALL SELECT ancestor, NULL, q, n FROM pairs JOIN own USING (node) WHERE node <> ancestor)
SELECT node, CAST(max(own) AS DOUBLE) AS own, CAST(sum(part) AS DOUBLE) AS total, CAST(sum(n) AS BIGINT) AS n_rows FROM up GROUP BY 1""")
def part_subtree_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity sold of each part, and of it with all parts below it."""
    pairs = hierarchy.closure(_part_edges(spark, sf_dir), "child", "parent")
    found = hierarchy.subtree_totals(read(spark, sf_dir, "lineitem").select("l_partkey", money("l_quantity").alias("q")), "l_partkey", F.col("q"), pairs)
    return found.select("node", F.col("own").cast("double").alias("own"), F.col("total").cast("double").alias("total"), "n_rows")


@query("""SELECT l_returnflag, count(*) AS n_lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-02-01' AND l_shipdate <= TIMESTAMP '1996-04-30' AND l_suppkey BETWEEN 3 AND 40 GROUP BY 1""")
def clustered_lines(spark: SparkSession, sf_dir: str, file_rows: int = 5_000_000) -> DataFrame:
    """Lines of a quarter and some suppliers, from a table laid out by both columns."""
    path = _scratch(spark, "clustered")
    lines = read(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice", "l_shipdate", "l_suppkey")
    write_clustered(lines, path, ["l_shipdate", "l_suppkey"], file_rows)
    found = read_within(spark, path, {"l_shipdate": (datetime(1996, 2, 1), datetime(1996, 4, 30)), "l_suppkey": (3, 40)})
    return found.groupBy("l_returnflag").agg(F.count("*").alias("n_lines"), F.sum(money("l_extendedprice")).cast("double").alias("price"))


def _class_counts(table: str, columns: list[str], most: int) -> str:
    """SQL for the number of classes of each set of columns, as s (comma-joined names), n (columns) and k."""
    sets = [s for size in range(most + 1) for s in combinations(columns, size)]
    some = [f"SELECT '{','.join(s)}' AS s, {len(s)} AS n, count(*) AS k FROM (SELECT DISTINCT {', '.join(s) or '1 AS one'} FROM {table})" for s in sets]
    return " UNION ALL ".join(some)


_CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_LINE = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag"]


@query(" UNION ALL ".join(f"""SELECT '{t}' AS table_name, s AS key_columns FROM (WITH c AS ({_class_counts(t, columns, 2)}), u AS (SELECT s, n FROM c WHERE k = (SELECT count(*) FROM {t}))
  SELECT s FROM u WHERE n = 1 OR NOT EXISTS (SELECT 1 FROM u AS v WHERE v.n < u.n AND list_has_all(string_split(u.s, ','), string_split(v.s, ','))))""" for t, columns in (("customer", _CUSTOMER), ("lineitem", _LINE))))
def key_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimal keys of customers and of lines, of one or two columns."""
    found = [(t, ",".join(k)) for t, columns in (("customer", _CUSTOMER), ("lineitem", _LINE)) for k in keys.minimal_keys(read(spark, sf_dir, t), columns)]
    return spark.createDataFrame(found, "table_name string, key_columns string")


_PLACE = ["c_custkey", "c_name", "c_mktsegment", "c_nationkey", "n_name", "n_regionkey", "r_name"]


@query(f"""WITH wide AS (SELECT {", ".join(_PLACE)} FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
c AS ({_class_counts("wide", _PLACE, 3)}), names AS (SELECT unnest({_PLACE!r}) AS determined),
d AS (SELECT x.s, x.n, determined FROM c AS x, names, c AS y WHERE x.n <= 2 AND y.n = x.n + 1 AND x.k = y.k AND NOT list_contains(string_split(x.s, ','), determined)
  AND list_contains(string_split(y.s, ','), determined) AND (x.n = 0 OR list_has_all(string_split(y.s, ','), string_split(x.s, ','))))
SELECT s AS determining, determined FROM d WHERE n = 0 OR NOT EXISTS (SELECT 1 FROM d AS e WHERE e.determined = d.determined AND e.n < d.n AND (e.n = 0 OR list_has_all(string_split(d.s, ','), string_split(e.s, ','))))""")
def customer_dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which one or two columns of customers with their nation and region determine another."""
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    wide = read(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    found = keys.dependencies(wide, _PLACE)
    return spark.createDataFrame([(",".join(a), b) for a, b in found], "determining string, determined string")


@query("SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n_events FROM events GROUP BY 1")
def json_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by a field of their JSON properties."""
    return read(spark, sf_dir, "events").groupBy(json_int("props", "$.k").alias("k")).agg(F.count("*").alias("n_events"))


def _event_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int, lateness: str | None) -> DataFrame:
    """The event files as a stream. Unless a lateness is given it covers the table's span: the files are in any order, and none of their rows is late."""
    events = read(spark, sf_dir, "events")
    if lateness is None:
        span = events.agg((F.unix_timestamp(F.max("ts").cast("timestamp")) - F.unix_timestamp(F.min("ts").cast("timestamp"))).alias("s")).first().s or 0
        lateness = f"{span + 86400} seconds"
    return stream_files(spark, f"{sf_dir}/events.parquet*", events.schema, "ts", lateness, files_per_trigger)


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') || '|' || event_type AS bucket, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(value) AS n FROM events GROUP BY 1")
def streamed_totals(spark: SparkSession, sf_dir: str, files_per_trigger: int = 64, lateness: str | None = None) -> DataFrame:
    """Totals by day and event type from a stream of the event files, added batch by batch."""
    path = _scratch(spark, "stream")
    stream = _event_stream(spark, sf_dir, files_per_trigger, lateness)
    totals_into(stream, "event_type", ("ts", "1 day"), money("value"), ["event_id"], f"{path}/table", f"{path}/checkpoint")
    return totals(spark, f"{path}/table").select("bucket", F.col("total").cast("double").alias("total"), "n")


@query("""SELECT event_id, user_id, ts, arg_min(p_ts, (p_ts, p_id)) AS purchase_ts, arg_min(p_id, (p_ts, p_id)) AS purchase_id, arg_min(p_value, (p_ts, p_id)) AS purchase_value FROM
  (SELECT c.event_id, c.user_id, c.ts, p.ts AS p_ts, p.event_id AS p_id, p.value AS p_value FROM events c LEFT JOIN events p
   ON p.event_type = 'purchase' AND p.user_id = c.user_id AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 6 HOUR WHERE c.event_type = 'click') GROUP BY ALL""")
def streamed_answers(spark: SparkSession, sf_dir: str, files_per_trigger: int = 64, lateness: str | None = None) -> DataFrame:
    """Each click with its user's first purchase in the six hours after it, from a join of two streams of the event files."""
    path = _scratch(spark, "answers")
    side = lambda: _event_stream(spark, sf_dir, files_per_trigger, lateness)
    clicks = side().where("event_type = 'click'").select("event_id", "user_id", "ts")
    bought = side().where("event_type = 'purchase'").select(F.col("user_id").alias("buyer"), F.col("ts").alias("purchase_ts"), F.col("event_id").alias("purchase_id"), F.col("value").alias("purchase_value"))
    pairs = answers_within(clicks, bought, ("user_id", "buyer"), ("ts", "purchase_ts"), "6 hours")
    drain_into(pairs, f"{path}/table", f"{path}/checkpoint")
    asked = read(spark, sf_dir, "events").where("event_type = 'click'").select("event_id", "user_id", "ts")
    found = first_answers(asked, read_appended(spark, f"{path}/table", pairs.schema), "event_id", ["purchase_ts", "purchase_id", "purchase_value"])
    return found.withColumn("purchase_ts", F.col("purchase_ts").cast("timestamp_ntz"))


@query("""SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_events FROM (
  SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
    SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 24 HOUR THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s""")
def streamed_sessions(spark: SparkSession, sf_dir: str, files_per_trigger: int = 64, lateness: str | None = None) -> DataFrame:
    """Users' sessions from a stream of the event files; late rows extend and join them."""
    path = _scratch(spark, "sessions")
    changes = session_changes(_event_stream(spark, sf_dir, files_per_trigger, lateness), "user_id", "ts", 86_400)
    drain_into(changes, f"{path}/table", f"{path}/checkpoint", numbered, "update")
    found = sessions_of(read_appended(spark, f"{path}/table", numbered(changes, 0).schema), "user_id")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_ts", "last_ts")})


@query(f"WITH {_LATER} SELECT * FROM later UNION ALL SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM later)")
def loaded_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer dimension after two loads, of the table and of a later snapshot, as a table of versions."""
    path, rows = _scratch(spark, "customers"), read(spark, sf_dir, "customer")
    for snapshot in (rows, _later_customers(rows)):
        loads.load_dimension(spark, path, snapshot, "c_custkey")
    return read_version(spark, path)


@query("""SELECT CASE WHEN l_suppkey % 10 = 0 THEN -1 ELSE l_suppkey END AS l_suppkey, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / nullif(CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE), 0) AS unit_price
FROM lineitem GROUP BY 1""")
def loaded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by supplier from a fact table that grew by two loads, those shipped before 1998 and the others."""
    path, lines = _scratch(spark, "lines"), read(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    known = read(spark, sf_dir, "supplier").where("s_suppkey % 10 <> 0")
    early = F.coalesce(F.year("l_shipdate") < 1998, F.lit(False))
    for facts in (lines.where(early), lines.where(~early)):
        loads.load_facts(spark, path, facts, "l_suppkey", known, "s_suppkey")
    quantity = F.sum(money("l_quantity")).cast("double")
    return read_appended(spark, path).groupBy("l_suppkey").agg(F.count("*").alias("n_lines"), quantity.alias("quantity"), safe_ratio(F.sum(money("l_extendedprice")).cast("double"), quantity).alias("unit_price"))
