"""Time segments, tourism and exports."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..codes import ABROAD, MOVE, STAY, UNDETERMINED, UNKNOWN
from ..functions import grid
from ..operators import coverage, export, segments, tourism
from ..plans.iterate import cut
from ..schemas import Table, conform
from ..sources import demo
from .coverage import _lattice_connection
from .views import B, CONN, EV, FOOT, ZONES

UNTIL = 1_706_400_000  # 2024-01-28
P = tourism.Params(min_stay_minutes=180, min_night_minutes=240, midnight_hour=4)


def time_segments(spark, sf):
    """A whole history folded by user."""
    e = demo.events(spark, sf)
    fp = coverage.prune_share_of_best(coverage.dominance(coverage.tiles_in_range(coverage.impute_defaults(demo.cells(spark)), demo.lattice(spark).drop("k"), coverage.Params(bin_size=250.0))))
    near = coverage.overlap_groups(coverage.nearby_cells(fp, demo.lattice(spark), 500.0), 250.0)
    s = segments.time_segments(e, near, 19752, segments.Params(missing_stay=43200, missing_move=28800, min_stay=900))
    return s.withColumn("cells", F.array_join("cells", ","))


def _segments_sql() -> str:
    """The state machine as a recursion over each user's entries: the opening of a day (0), its events (1), the first event of
    the next one (2), its end (3), or a day without events (4). ``b`` is the last segment of the day before, ``n`` the open one.
    """
    seg = "STRUCT(s BIGINT, e BIGINT, l BIGINT, c VARCHAR[], p BIGINT, st INTEGER)"
    make = lambda s, e, l, c, p, st: f"cast({{s: {s}, e: {e}, l: {l}, c: {c}, p: {p}, st: {st}}} AS {seg})"  # noqa: E731, E741
    none, empty = "NULL", "[]"
    fresh = lambda at: make(at, "t", "t", "[cell_id]", none, UNDETERMINED)
    bridged = f"CASE b0.st WHEN {STAY} THEN 43200 WHEN {MOVE} THEN 28800 WHEN {ABROAD} THEN 259200 END"
    opened = f"CASE WHEN t - b0.l <= {bridged} THEN {make('m', 't', 'b0.l', f'CASE WHEN b0.st = {ABROAD} THEN [] ELSE b0.c END', 'b0.p', 'b0.st')} ELSE {make('m', 't - least(300, (t - m) // 2)', 'b0.l', empty, none, UNKNOWN)} END"
    cases = [  # (when, closed, open)
        ("kind = 0", "[]", opened),
        ("kind = 3", f"CASE WHEN n.e <= z THEN [n, {make('n.e', 'z', 'n.l', empty, none, UNKNOWN)}] ELSE [n] END", none),
        ("kind = 4 AND b0 IS NULL", "[]", none),
        ("kind = 4", f"[CASE WHEN b0.st = {ABROAD} AND z - b0.l <= 259200 THEN {make('m', 'z', 'b0.l', empty, 'b0.p', ABROAD)} ELSE {make('m', 'z', 'b0.l', empty, none, UNKNOWN)} END]", none),
        (f"abroad AND n.st <> {ABROAD}", "[n]", make("n.e", "t", "n.l", empty, "plmn", ABROAD)),
        ("abroad AND g > 259200", "[n]", make("n.e", "t", none, empty, none, UNKNOWN)),
        ("abroad AND plmn // 100 = n.p // 100", "[]", make("n.s", "t", "t", "n.c", "n.p", "n.st")),
        ("abroad", "[n]", make("n.e", "t", "t", empty, "plmn", ABROAD)),
        (f"n.st IN ({UNKNOWN}, {ABROAD})", "[n]", fresh("n.e")),
        (f"meets AND g <= 43200 AND n.st = {MOVE}", "[n]", fresh("n.e")),
        ("meets AND g <= 43200", "[]", make("n.s", "t", "t", "list_distinct(list_append(n.c, cell_id))", "n.p", f"CASE WHEN t - n.s > 900 THEN {STAY} ELSE n.st END")),
        ("NOT meets AND g <= 28800", f"[n, {make('n.e', 'n.e + g // 2', 'n.l', 'n.c', none, MOVE)}]", make("n.e + g // 2", "t", "t", "[cell_id]", none, MOVE)),
        ("true", f"[{make('n.s', 'n.e + least(300, g // 2)', 'n.l', 'n.c', 'n.p', 'n.st')}, {make('n.e + least(300, g // 2)', 't - least(300, g // 2)', none, empty, none, UNKNOWN)}]", fresh("t - least(300, g // 2)")),
    ]
    chosen = " ".join(f"WHEN {when} THEN {{x: cast({closed} AS {seg}[]), n: cast({now} AS {seg})}}" for when, closed, now in cases)
    return f"""WITH RECURSIVE {EV}, {FOOT}, pb AS (SELECT * FROM (SELECT *, max(sd) OVER (PARTITION BY grid_id) AS best FROM sd) WHERE sd * 100 >= best * 90.0),
pp AS (SELECT cell_id, x, y FROM pb JOIN tl USING (grid_id)), nr AS (SELECT a.cell_id, list(DISTINCT b.cell_id) AS near FROM pp a JOIN pp b ON a.cell_id <> b.cell_id AND sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)) <= 500 GROUP BY a.cell_id),
e0 AS (SELECT user_id, t, t // 86400 AS day, cell_id, coalesce(near, []) AS near, plmn, domain = 'outbound' AS abroad FROM ev LEFT JOIN nr USING (cell_id) WHERE t < 19754 * 86400),
f0 AS (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY t, cell_id, plmn NULLS FIRST) AS i FROM e0),
ud AS (SELECT user_id, unnest(range(min(day), 19753)) AS day FROM e0 GROUP BY user_id),
et AS (SELECT u.user_id, u.day, 1 AS kind, t, cell_id, near, plmn, abroad, i FROM ud u JOIN f0 f ON f.user_id = u.user_id AND f.day = u.day
  UNION ALL SELECT u.user_id, u.day, CASE WHEN f.t IS NULL THEN 4 ELSE 0 END, t, cell_id, near, plmn, abroad, 0 FROM ud u LEFT JOIN f0 f ON f.user_id = u.user_id AND f.day = u.day AND f.i = 1
  UNION ALL SELECT u.user_id, u.day, 2, f.t, f.cell_id, f.near, f.plmn, f.abroad, 0 FROM ud u JOIN f0 f ON f.user_id = u.user_id AND f.day = u.day + 1 AND f.i = 1 WHERE EXISTS (SELECT 1 FROM f0 h WHERE h.user_id = u.user_id AND h.day = u.day)
  UNION ALL SELECT user_id, day, 3, NULL, NULL, NULL, NULL, NULL, 0 FROM f0 WHERE i = 1 AND day < 19753),
en AS MATERIALIZED (SELECT *, day * 86400 AS m, day * 86400 + 86399 AS z, row_number() OVER (PARTITION BY user_id ORDER BY day, kind, i) AS q FROM et),
r AS (SELECT DISTINCT user_id, cast(0 AS BIGINT) AS q, cast(NULL AS BIGINT) AS day, cast(NULL AS {seg}) AS b, cast(NULL AS {seg}) AS n, cast(NULL AS {seg}) AS lm, cast([] AS {seg}[]) AS made FROM en
  UNION ALL
  SELECT user_id, q, day, CASE kind WHEN 3 THEN coalesce(cut[-1], lm) WHEN 4 THEN cut[-1] ELSE b0 END, step.n, CASE WHEN kind = 0 THEN NULL ELSE coalesce(cut[-1], lm) END, cut
  FROM (SELECT *, list_filter(list_transform(step.x, lambda s: cast({{s: s.s, e: least(s.e, z), l: s.l, c: s.c, p: s.p, st: s.st}} AS {seg})), lambda s: s.s <= z AND s.e > s.s) AS cut
    FROM (SELECT *, CASE {chosen} END AS step
      FROM (SELECT en.*, r.n, r.lm, CASE WHEN kind IN (0, 4) AND r.b.st = {UNKNOWN} AND coalesce(m - r.b.l > 604800, true) THEN NULL ELSE r.b END AS b0, t - r.n.e AS g,
          len(r.n.c) > 0 AND len(list_filter(r.n.c, lambda c: c <> cell_id AND NOT list_contains(near, c))) = 0 AS meets
        FROM r JOIN en ON en.user_id = r.user_id AND en.q = r.q + 1)))),
sg AS (SELECT user_id, day, q, unnest(made) AS s, unnest(range(len(made))) AS j FROM r)
SELECT user_id, md5(user_id || strftime(epoch_ms(s.s * 1000), '%Y-%m-%d %H:%M:%S')) AS time_segment_id, s.s AS start_s, s.e AS end_s, s.l AS last_event_s, array_to_string(list_sort(s.c), ',') AS cells, cast(s.p AS INTEGER) AS plmn, s.st AS state,
  row_number() OVER (PARTITION BY user_id, day ORDER BY q DESC, j DESC) = 1 AS is_last, day FROM sg"""


def outbound_user_events(spark, sf):
    """All events of the users who were abroad in the first ten days of the month."""
    e = demo.events(spark, sf).where(F.dayofmonth("date") <= 10)
    return segments.with_outbound_users(e).select("user_id", "event_id", "domain")


def segment_totals(spark, sf):
    """Seconds in each state by day: segments leave no part of a day from the first event on untold."""
    s = time_segments(spark, sf)
    return s.groupBy("day", "state").agg(F.count("*").alias("segments"), F.sum(F.col("end_s") - F.col("start_s")).alias("seconds"))


def _segments(spark, sf):
    """Stays as if segmented: each event stays some hours in its cell, at most to the end of the day."""
    b = demo.base_events(spark, sf)
    t = F.unix_timestamp("ts")
    return b.select(
        F.col("uid").alias("user_id"), F.concat(F.lit("s"), F.col("event_id").cast("string")).alias("time_segment_id"), t.alias("start_s"),
        F.least(t + (1 + F.col("k") % 9) * 3600, F.floor(t / 86400) * 86400 + 86399).alias("end_s"), F.when(F.col("event_type").isin("error", "click"), 310).when(F.col("event_type") == "view", 262).otherwise(214).alias("mcc"),
        F.when(F.col("k") % 3 != 0, 1).otherwise(2).alias("state"), F.array(demo.cell_name(F.col("k"))).alias("cells"),
    )


def _stays(spark, sf):
    residents = demo.base_events(spark, sf).where("uid % 50 = 0").select(F.col("uid").alias("user_id"))
    return tourism.tourism_stays(_segments(spark, sf), _lattice_connection(spark), demo.zones(spark, sf).select("grid_id", "hierarchical_id"), P, residents)


def tourism_stays(spark, sf):
    s = _stays(spark, sf)
    return s.select("user_id", "time_segment_id", "is_overnight", F.array_join(F.transform("zones", lambda z: F.concat_ws("=", z["zone_id"], F.format_number(z["weight"], 6))), ",").alias("zones"))


def _trips(spark, sf):
    return tourism.trips(_stays(spark, sf), 24)


def trips(spark, sf):
    t = tourism.trip_table(_trips(spark, sf), UNTIL)
    return t.withColumn("time_segment_ids", F.array_join("time_segment_ids", ","))


def _countries(spark):
    return spark.sql("SELECT * FROM VALUES (310, 'US'), (214, 'ES') AS t(mcc, iso2)")


def _visits(spark, sf):
    return tourism.visits(tourism.by_zone(_trips(spark, sf), 2, _countries(spark)), 24)


#: The stays of the month are moved on by half a month, so that trips lie across its end.
HALF_MONTH = 15 * 86400


def _monthly(spark, sf):
    """(month, closed trips) of three runs; each reads its own month's stays and the trips that the run before left open."""
    stays = cut(_stays(spark, sf).withColumns({c: F.col(c) + HALF_MONTH for c in ("start_s", "end_s")}))
    held, out = None, []
    for month, since, until in tourism.month_bounds("2024-01", "2024-03"):
        run = cut(tourism.month_trips(stays, since, until, 24, held))
        held = run.where("open")
        out.append((month, run.where("not open").drop("open")))
    return out


def trips_by_month(spark, sf):
    """Trips in the month in which they ended for good."""
    parts = [tourism.trip_table(t, UNTIL + 100 * 86400).withColumn("month", F.lit(m)) for m, t in _monthly(spark, sf)]
    return functools.reduce(DataFrame.unionByName, parts).withColumn("time_segment_ids", F.array_join("time_segment_ids", ",")).drop("is_trip_finished")


def zone_nights_by_month(spark, sf):
    """Nights and departures of each month's trips."""
    each = lambda t: tourism.zone_departures(tourism.visits(tourism.by_zone(t, 2, _countries(spark)), 24), UNTIL + 100 * 86400)
    parts = [each(t).withColumn("month", F.lit(m)) for m, t in _monthly(spark, sf)]
    return functools.reduce(DataFrame.unionByName, parts).withColumn("nights_spent", F.round("nights_spent", 6))


def visits(spark, sf):
    return _visits(spark, sf).select("user_id", "trip_id", "zone_id", "time_segment_id", "country_of_origin", "visit_start", F.round("zone_weight", 9).alias("zone_weight"))


def zone_nights(spark, sf):
    return tourism.zone_departures(_visits(spark, sf), UNTIL).withColumn("nights_spent", F.round("nights_spent", 6))


def avg_destinations(spark, sf):
    a = tourism.averages(_visits(spark, sf), UNTIL)
    return a.select("country_of_origin", *[F.round(c, 6).alias(c) for c in ("avg_destinations", "avg_nights_spent_per_destination")])


_MONTH = "CASE WHEN max(end_s) OVER (PARTITION BY trip_id) + 86400 + 1296000 < 1706745600 THEN '2024-01' WHEN max(end_s) OVER (PARTITION BY trip_id) + 86400 + 1296000 < 1709251200 THEN '2024-02' ELSE '2024-03' END AS month"
_STAYS = f"""{B}, {CONN}, {ZONES}, sg AS (SELECT uid AS user_id, 's' || event_id AS time_segment_id, cast(epoch(ts) AS BIGINT) AS start_s, CASE WHEN event_type IN ('error', 'click') THEN 310 WHEN event_type = 'view' THEN 262 ELSE 214 END AS mcc, k FROM b),
s2 AS (SELECT *, least(start_s + (1 + k % 9) * 3600, start_s // 86400 * 86400 + 86399) AS end_s FROM sg),
s3 AS (SELECT *, (start_s % 86400) // 3600 <= 4 AND (end_s % 86400) // 3600 > 4 AND end_s - start_s >= 14400 AS is_overnight FROM s2 WHERE k % 3 <> 0 AND end_s - start_s >= 10800 AND mcc <> 214 AND user_id NOT IN (SELECT uid FROM b WHERE uid % 50 = 0)),
cz AS (SELECT c.k, hid, post FROM cl c JOIN po USING (cell_id) JOIN zn z ON z.grid_id = po.grid_id),
tr AS (SELECT *, last_value(o IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY start_s, end_s ROWS UNBOUNDED PRECEDING) AS trip_start FROM (SELECT *, CASE WHEN coalesce(start_s - max(end_s) OVER (PARTITION BY user_id ORDER BY start_s, end_s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 86400, true) THEN start_s END AS o FROM s3)),
ti AS (SELECT *, md5(user_id || '|' || trip_start) AS trip_id FROM tr),
bz AS (SELECT user_id, time_segment_id, start_s, end_s, is_overnight, trip_id, split_part(hid, '|', 2) AS zone_id, CASE mcc WHEN 310 THEN 'US' WHEN 214 THEN 'ES' ELSE 'XX' END AS country_of_origin, sum(post) AS zone_weight FROM ti JOIN cz USING (k) GROUP BY ALL),
vi AS (SELECT *, last_value(o IGNORE NULLS) OVER (PARTITION BY trip_id, zone_id ORDER BY start_s, end_s ROWS UNBOUNDED PRECEDING) AS visit_start FROM (SELECT *, CASE WHEN coalesce(start_s - max(end_s) OVER (PARTITION BY trip_id, zone_id ORDER BY start_s, end_s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 86400, true) THEN start_s END AS o FROM bz)),
vf AS (SELECT *, max(end_s) OVER (PARTITION BY trip_id) < {UNTIL} AS tf, max(end_s) OVER (PARTITION BY trip_id, zone_id, visit_start) < {UNTIL} AS vf, max(cast(is_overnight AS INTEGER)) OVER (PARTITION BY trip_id) = 1 AS ot FROM vi)"""


def _outbound(spark, sf):
    b = demo.base_events(spark, sf)
    t = F.unix_timestamp("ts")
    seg = b.where("event_type = 'signup'").select(F.col("uid").alias("user_id"), t.alias("start_s"), (t + (1 + F.col("k") % 9) * 3600).alias("end_s"), F.when(F.col("k") % 2 == 0, 20801).when(F.col("k") % 5 == 0, 99901).otherwise(31001).alias("plmn"), F.lit(5).alias("state"))
    countries = spark.sql("SELECT * FROM VALUES (310, 'US', 'America/New_York'), (208, 'FR', 'Europe/Paris') AS t(mcc, iso2, timezone)")
    usual = b.where("uid % 20 = 0").select(F.col("uid").alias("user_id"), F.lit("FR").alias("iso2"))
    return tourism.local_overnight(tourism.outbound_segments(seg, countries, P, usual), P)


def outbound_nights(spark, sf):
    return tourism.outbound_nights(_outbound(spark, sf), UNTIL, P)


OUTBOUND_SQL = f"""WITH {B}, s AS (SELECT uid, cast(epoch(ts) AS BIGINT) AS s, cast(epoch(ts) AS BIGINT) + (1 + k % 9) * 3600 AS e, CASE WHEN k % 2 = 0 THEN 'FR' WHEN k % 5 = 0 THEN 'XX' ELSE 'US' END AS iso2, CASE WHEN k % 2 = 0 THEN 1 WHEN k % 5 = 0 THEN 0 ELSE -5 END AS tz FROM b WHERE event_type = 'signup'),
k AS (SELECT *, (e + tz * 3600 - 14400) // 86400 > (s + tz * 3600 - 14400 - 1) // 86400 AND e - s >= 12000 AS o FROM s WHERE e - s >= 10800 AND NOT (uid % 20 = 0 AND iso2 = 'FR')),
t AS (SELECT *, last_value(b IGNORE NULLS) OVER (PARTITION BY uid ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS ts FROM (SELECT *, CASE WHEN coalesce(s - max(e) OVER (PARTITION BY uid ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 259200, true) THEN s END AS b FROM k)),
v AS (SELECT *, last_value(c IGNORE NULLS) OVER (PARTITION BY uid, ts, iso2 ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS vs FROM (SELECT *, CASE WHEN coalesce(s - max(e) OVER (PARTITION BY uid, ts, iso2 ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 86400, true) THEN s END AS c FROM t))
SELECT iso2, sum(CASE WHEN o AND f THEN 1.0::DOUBLE ELSE 0 END) AS nights_spent FROM (SELECT *, max(e) OVER (PARTITION BY uid, ts, iso2, vs) < {UNTIL} AS f FROM v) GROUP BY iso2"""


def _customers(spark, sf):
    c = demo.load(spark, sf, "customer")
    k = F.col("c_custkey") % 100
    return c.select("c_custkey", "c_mktsegment", "c_nationkey", grid.pack(F.floor(k / 10), k % 10).alias("grid_id"), F.lit(1.0).alias("value"))


def hierarchy_rollup(spark, sf):
    r = export.hierarchy_rollup(_customers(spark, sf), demo.zones(spark, sf), [1, 2, 3, 4], "value", ["c_mktsegment"])
    return r


def k_anon_delete(spark, sf):
    r = export.hierarchy_rollup(export.select_case(_customers(spark, sf), {"c_mktsegment": "BUILDING"}), demo.zones(spark, sf), [2, 3], "value")
    return export.delete_small(r, ["value"], 5)


def grid_rollup(spark, sf):
    c = _customers(spark, sf).join(demo.lattice(spark).select("grid_id", "origin"), "grid_id")
    return export.grid_rollup(c, "INSPIRE_1km", "value").withColumn("zoning", F.lit("1km")).unionByName(export.grid_rollup(c, "INSPIRE_100m", "value").withColumn("zoning", F.lit("100m")))


def country_factors(spark, sf):
    n = demo.load(spark, sf, "nation")
    f = n.where("n_nationkey % 3 <> 0").select(F.col("n_name").alias("iso2"), F.when(F.col("n_nationkey") % 4 != 1, F.col("n_nationkey") * 0.1).alias("deduplication_factor"))
    c = demo.load(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("country_of_origin")).agg(F.count("*").cast("double").alias("value"))
    return export.scale_by_country(c, f, ["value"], "deduplication_factor", 0.95).withColumn("value", F.round("value", 6))


def multi_mno_sum(spark, sf):
    def one(i):
        c = _customers(spark, sf).where(F.col("c_custkey") % 2 == i)
        r = export.hierarchy_rollup(c, demo.zones(spark, sf), [1, 2, 3], "value")
        return export.obfuscate(r, ["value"], 6)

    return export.aggregate_operators([(one(0), 0.4), (one(1), 0.6)], ["level", "zone_id"], ["value"]).withColumn("value", F.round("value", 6))


ZONE_VALUES = Table("zone_values", "level int, zone_id string, value double")


def output_audit(spark, sf):
    """Problems of an export of customers by segment: a column that lacks, one of another type, one too many, and nulls."""
    zone = F.when(F.col("c_custkey") % 9 != 0, F.concat(F.lit("Z"), F.col("c_nationkey").cast("string")))
    df = demo.load(spark, sf, "customer").select(zone.alias("zone_id"), F.col("c_custkey").cast("float").alias("value"), "c_mktsegment")
    return export.output_problems(df, ZONE_VALUES, ["zone_id", "value", "level"])


def multi_mno_checked(spark, sf):
    """The sum over two operators whose tables must have the declared schema, and what is told of one that hasn't."""
    rows = lambda i: export.hierarchy_rollup(_customers(spark, sf).where(F.col("c_custkey") % 2 == i), demo.zones(spark, sf), [1, 2], "value")
    good = [conform(rows(i), ZONE_VALUES) for i in (0, 1)]
    try:
        export.aggregate_operators([(good[0], 0.5), (good[1].withColumn("value", F.col("value").cast("int")), 0.5)], ["level", "zone_id"], ["value"], ZONE_VALUES)
        told = "nothing"
    except ValueError as e:
        told = str(e)
    out = export.aggregate_operators([(good[0], 0.4), (good[1], 0.6)], ["level", "zone_id"], ["value"], ZONE_VALUES)
    return out.withColumns({"value": F.round("value", 6), "refused": F.lit(told)})


_CU = "cu AS (SELECT c_custkey, c_mktsegment, c_nationkey, cast((c_custkey % 100 // 10 << 16) + c_custkey % 100 % 10 AS INTEGER) AS grid_id FROM customer)"
_T = CONN.split(", cl AS")[0]
QUERIES = {
    "time_segments": (time_segments, _segments_sql()),
    "segment_totals": (segment_totals, f"SELECT day, state, count(*) AS segments, cast(sum(end_s - start_s) AS BIGINT) AS seconds FROM ({_segments_sql()}) GROUP BY day, state"),
    "tourism_stays": (tourism_stays, f"WITH {_STAYS} SELECT user_id, time_segment_id, is_overnight, string_agg(hid || '=' || format('{{:.6f}}', post), ',' ORDER BY hid) AS zones FROM s3 JOIN cz USING (k) GROUP BY ALL"),
    "trips": (trips, f"WITH {_STAYS} SELECT user_id, trip_id, trip_start, string_agg(time_segment_id, ',' ORDER BY time_segment_id) AS time_segment_ids, max(end_s) AS trip_end, max(end_s) < {UNTIL} AS is_trip_finished FROM ti GROUP BY user_id, trip_id, trip_start"),
    "trips_by_month": (trips_by_month, f"WITH {_STAYS}, m AS (SELECT *, {_MONTH} FROM ti) SELECT user_id, md5(user_id || '|' || (trip_start + {HALF_MONTH})) AS trip_id, trip_start + {HALF_MONTH} AS trip_start, string_agg(time_segment_id, ',' ORDER BY time_segment_id) AS time_segment_ids, max(end_s) + {HALF_MONTH} AS trip_end, month FROM m GROUP BY user_id, trip_start, month"),
    "zone_nights_by_month": (zone_nights_by_month, f"WITH {_STAYS}, m AS (SELECT *, {_MONTH} FROM vf) SELECT month, country_of_origin, ot AS is_overnight, zone_id, round(sum(CASE WHEN is_overnight THEN zone_weight ELSE 0 END), 6) AS nights_spent, count(DISTINCT trip_id) AS departures FROM m GROUP BY ALL"),
    "visits": (visits, f"WITH {_STAYS} SELECT user_id, trip_id, zone_id, time_segment_id, country_of_origin, visit_start, round(zone_weight, 9) AS zone_weight FROM vi"),
    "zone_nights": (zone_nights, f"WITH {_STAYS} SELECT country_of_origin, ot AS is_overnight, zone_id, round(sum(CASE WHEN vf AND is_overnight THEN zone_weight ELSE 0 END), 6) AS nights_spent, count(DISTINCT CASE WHEN tf THEN trip_id END) AS departures FROM vf GROUP BY ALL"),
    "avg_destinations": (avg_destinations, f"WITH {_STAYS}, z AS (SELECT country_of_origin, trip_id, zone_id, sum(CASE WHEN is_overnight THEN zone_weight ELSE 0 END) AS n FROM vf WHERE tf GROUP BY ALL), a AS (SELECT country_of_origin, avg(c) AS d FROM (SELECT country_of_origin, trip_id, count(*) AS c FROM z GROUP BY ALL) GROUP BY ALL) SELECT country_of_origin, round(d, 6) AS avg_destinations, round(avg(n), 6) AS avg_nights_spent_per_destination FROM z JOIN a USING (country_of_origin) GROUP BY country_of_origin, d"),
    "outbound_nights": (outbound_nights, OUTBOUND_SQL),
    "hierarchy_rollup": (hierarchy_rollup, f"WITH {_T}, {ZONES}, {_CU} SELECT c_mktsegment, l AS level, split_part(hid, '|', l) AS zone_id, count(*)::DOUBLE AS value FROM cu JOIN zn USING (grid_id), (VALUES (1), (2), (3)) q(l) GROUP BY ALL"),
    "k_anon_delete": (k_anon_delete, f"WITH {_T}, {ZONES}, {_CU} SELECT l AS level, split_part(hid, '|', l) AS zone_id, count(*)::DOUBLE AS value FROM cu JOIN zn USING (grid_id), (VALUES (2), (3)) q(l) WHERE c_mktsegment = 'BUILDING' GROUP BY ALL HAVING count(*) >= 5"),
    "grid_rollup": (grid_rollup, f"WITH {_CU} SELECT '1kmN3000E4000' AS zone_id, count(*)::DOUBLE AS value, '1km' AS zoning FROM cu GROUP BY ALL UNION ALL SELECT '100mN' || (30000 + (grid_id & 65535)) || 'E' || (40000 + (grid_id >> 16)), count(*), '100m' FROM cu GROUP BY grid_id"),
    "country_factors": (country_factors, "SELECT n_name AS country_of_origin, round(count(*) * CASE WHEN n_nationkey % 3 = 0 OR n_nationkey % 4 = 1 THEN 0.95::DOUBLE ELSE n_nationkey * 0.1::DOUBLE END, 6) AS value FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name, n_nationkey"),
    "outbound_user_events": (outbound_user_events, f"WITH {EV}, d AS (SELECT * FROM ev WHERE day(date) <= 10) SELECT user_id, event_id, domain FROM d WHERE user_id IN (SELECT user_id FROM d WHERE domain = 'outbound')"),
    "output_audit": (output_audit, "SELECT * FROM (VALUES ('level', 'missing', 0::BIGINT), ('value', 'type float, not double', 0), ('c_mktsegment', 'not declared', 0)) v(column_name, problem, rows) UNION ALL SELECT 'zone_id', 'null', count(*) FROM customer WHERE c_custkey % 9 = 0 HAVING count(*) > 0"),
    "multi_mno_checked": (multi_mno_checked, f"WITH {_T}, {ZONES}, {_CU} SELECT l AS level, split_part(hid, '|', l) AS zone_id, round(sum(CASE c_custkey % 2 WHEN 0 THEN 0.4::DOUBLE ELSE 0.6::DOUBLE END), 6) AS value, 'zone_values: [(''value'', ''type int, not double'', 0)]' AS refused FROM cu JOIN zn USING (grid_id), (VALUES (1), (2)) q(l) GROUP BY ALL"),
    "multi_mno_sum": (multi_mno_sum, f"WITH {_T}, {ZONES}, {_CU}, o AS (SELECT c_custkey % 2 AS o, l AS level, split_part(hid, '|', l) AS zone_id, count(*) AS n FROM cu JOIN zn USING (grid_id), (VALUES (1), (2), (3)) q(l) GROUP BY ALL HAVING count(*) >= 6) SELECT level, zone_id, round(sum(n * CASE o WHEN 0 THEN 0.4::DOUBLE ELSE 0.6::DOUBLE END), 6) AS value FROM o GROUP BY ALL"),
}
