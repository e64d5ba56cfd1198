"""Tables written and read again, jobs over them, and streams of a table's files."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import jobs
from ..plans.iterate import shared_path
from ..schemas import EVENTS, Table, conform
from ..sources import demo, tables
from ..streaming import sessions
from .views import B, EV

SUPPLIERS = Table("suppliers", "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")


def _dated(df):
    d = F.col("date")
    return df.withColumns({"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d), "user_id": F.col("user_id").cast("string").cast("binary")})


def stored_events(spark, sf):
    """Events in a declared table by day and bucket; one day is written anew with half of its rows, which replaces that day alone."""
    path = shared_path(spark, "events")
    events = _dated(demo.events(spark, sf))
    tables.write(events, EVENTS, path)
    tables.write(events.where("day = 5 AND event_id % 2 = 0"), EVENTS, path, "overwrite")
    buckets = len(tables.partition_values(spark, path))
    back = tables.read(spark, EVENTS, path)
    empty = tables.empty(spark, EVENTS).unionByName(conform(back, EVENTS))
    return empty.groupBy("day", "user_id_modulo").agg(F.count("*").alias("events"), F.count_distinct("user_id").alias("users"), F.max("timestamp").cast("string").alias("last"), F.lit(buckets).alias("partitions"))


def text_tables(spark, sf):
    """Suppliers as CSV and as JSON, read with their declared schema."""
    path, df = shared_path(spark, "text"), conform(demo.load(spark, sf, "supplier"), SUPPLIERS)
    tables.write_csv(df, f"{path}/csv", ";")
    df.write.json(f"{path}/json")
    a = tables.read_csv(spark, SUPPLIERS, f"{path}/csv", ";").withColumn("kind", F.lit("csv"))
    return a.unionByName(tables.read_json(spark, SUPPLIERS, f"{path}/json").withColumn("kind", F.lit("json")))


def jobs_over_tables(spark, sf):
    """Two jobs, given in the wrong order: the second reads what the first has written."""
    catalog = jobs.Catalog(spark, shared_path(spark, "jobs"), {"suppliers": SUPPLIERS})
    own = jobs.Job("own", lambda: demo.load(spark, sf, "supplier"), {}, ["suppliers"])
    count = jobs.Job("count", lambda rows, least: rows.where(F.col("s_acctbal") > least).groupBy("s_nationkey").agg(F.count("*").alias("suppliers"), F.round(F.sum("s_acctbal"), 2).alias("balance")), {"rows": "suppliers"}, ["counts"], {"least": 0.0})
    jobs.run([count, own], catalog)
    return catalog.read("counts")


def _drained(spark, stream):
    path = shared_path(spark, "stream")
    return sessions.run_available(stream, f"{path}/out", f"{path}/state")


def _signals(spark, sf):
    return demo.event_stream(spark, sf).select(F.col("uid").alias("user_id"), "ts", demo.cell_name(F.col("k")).alias("cell_id"))


def stream_cell_counts(spark, sf):
    """Events by hour and cell, of the hours that the watermark has passed."""
    return _drained(spark, sessions.cell_counts(_signals(spark, sf))).select(F.unix_timestamp("start").alias("start_s"), "cell_id", "events")


def stream_sessions(spark, sf):
    """Trips told by gaps of six hours, of those that the watermark has passed."""
    s = _drained(spark, sessions.trip_sessions(_signals(spark, sf), "6 hours"))
    return s.select("user_id", F.unix_timestamp("trip_start").alias("start_s"), F.unix_timestamp("trip_end").alias("end_s"), "stays")


def stream_distinct(spark, sf):
    """Events without those that repeat a user's time and cell; every event comes twice."""
    s = _signals(spark, sf)
    return _drained(spark, sessions.without_duplicates(s.union(s))).select("user_id", F.unix_timestamp("ts").alias("t"), "cell_id")


def stream_dwell(spark, sf):
    """Users' runs in a cell that another one has ended: state of one run a user."""
    s = _signals(spark, sf).select("user_id", F.unix_timestamp("ts").alias("t"), F.concat(F.lit("c"), (F.col("user_id") + F.substring("cell_id", 2, 2).cast("int")) % 3).alias("cell_id"))
    return _drained(spark, sessions.dwell(s))


_PASSED = "(SELECT max(epoch(ts)) - 7200 FROM b)"
_C = "'C' || lpad(cast(k AS VARCHAR), 2, '0')"
QUERIES = {
    "stored_events": (stored_events, f"WITH {EV}, s AS (SELECT * FROM ev WHERE day(date) <> 5 OR event_id % 2 = 0 OR user_id_modulo NOT IN (SELECT user_id_modulo FROM ev WHERE day(date) = 5 AND event_id % 2 = 0)), g AS (SELECT cast(day(date) AS TINYINT) AS day, user_id_modulo, count(*) AS events, count(DISTINCT user_id) AS users, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last FROM s GROUP BY ALL) SELECT *, cast((SELECT count(*) FROM g) AS INTEGER) AS partitions FROM g"),
    "text_tables": (text_tables, "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, kind FROM supplier, (VALUES ('csv'), ('json')) v(kind)"),
    "jobs_over_tables": (jobs_over_tables, "SELECT s_nationkey, count(*) AS suppliers, round(sum(s_acctbal), 2) AS balance FROM supplier WHERE s_acctbal > 0 GROUP BY s_nationkey"),
    "stream_cell_counts": (stream_cell_counts, f"WITH {B}, h AS (SELECT cast(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS start_s, {_C} AS cell_id FROM b) SELECT start_s, cell_id, count(*) AS events FROM h WHERE start_s + 3600 <= {_PASSED} GROUP BY start_s, cell_id"),
    "stream_sessions": (stream_sessions, f"WITH {B}, o AS (SELECT uid, cast(epoch(ts) AS BIGINT) AS t, CASE WHEN coalesce(epoch(ts) - lag(epoch(ts)) OVER w >= 21600, true) THEN 1 ELSE 0 END AS n FROM b WINDOW w AS (PARTITION BY uid ORDER BY ts)), i AS (SELECT *, sum(n) OVER (PARTITION BY uid ORDER BY t RANGE UNBOUNDED PRECEDING) AS g FROM o) SELECT uid AS user_id, min(t) AS start_s, max(t) + 21600 AS end_s, count(*) AS stays FROM i GROUP BY uid, g HAVING end_s <= {_PASSED}"),
    "stream_distinct": (stream_distinct, f"WITH {B} SELECT DISTINCT uid AS user_id, cast(epoch(ts) AS BIGINT) AS t, {_C} AS cell_id FROM b"),
    "stream_dwell": (stream_dwell, f"WITH {B}, c AS (SELECT uid, cast(epoch(ts) AS BIGINT) AS t, 'c' || cast((uid + k) % 3 AS VARCHAR) AS cell_id FROM b), o AS (SELECT *, CASE WHEN lag(cell_id) OVER w = cell_id AND t - lag(t) OVER w <= 43200 THEN 0 ELSE 1 END AS n FROM c WINDOW w AS (PARTITION BY uid ORDER BY t, cell_id)), i AS (SELECT *, sum(n) OVER (PARTITION BY uid ORDER BY t, cell_id ROWS UNBOUNDED PRECEDING) AS g FROM o), r AS (SELECT uid, g, any_value(cell_id) AS cell_id, min(t) AS start_s, max(t) AS end_s, count(*) AS events FROM i GROUP BY uid, g) SELECT uid AS user_id, cell_id, start_s, end_s, events FROM r WHERE g < (SELECT max(g) FROM r q WHERE q.uid = r.uid)"),
}
