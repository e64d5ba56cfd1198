"""Event and network cleaning, semantic flags, device activity."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import activity, device_filter, event_cleaning, network_cleaning, semantic_cleaning
from ..sources import demo
from .views import BRONZE, EV, haversine


def _flagged(spark, sf):
    return event_cleaning.flag_events(demo.bronze_events(spark, sf), date=F.col("date"), tie_break=["event_id"])


FLAGS = ["user_id_flag_1", "timestamp_flag_1", "mcc_flag_1", "mnc_flag_1", "timestamp_flag_4", "mcc_flag_2", "plmn_flag_2", "mnc_flag_2", "timestamp_flag_2", "no_mno_info_flag_5", "no_location_flag_6", "duplicated_flag_7"]


def event_flags(spark, sf):
    return _flagged(spark, sf).select("event_id", *FLAGS, "domain", "to_preserve")


def event_clean(spark, sf):
    e = event_cleaning.clean_events(_flagged(spark, sf), event_cleaning.Params(timezone="Europe/Madrid"))
    return e.select("event_id", F.lower(F.hex("user_id")).alias("user_id"), F.unix_timestamp("timestamp").alias("t"), "domain", "user_id_modulo", F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"), F.col("day").cast("int").alias("day"))


def event_metrics(spark, sf):
    return event_cleaning.metrics_by_column(_flagged(spark, sf), ["date"]).select(F.col("date").cast("string").alias("date"), "variable", "type_of_error", "value")


_GROUPS = {"user_id": [1], "timestamp": [1, 4, 2], "mcc": [1, 2], "mnc": [1, 2], "plmn": [2], "no_mno_info": [5], "no_location": [6], "duplicated": [7]}
_METRICS = " UNION ALL ".join(
    [f"SELECT date, '{f.rpartition('_flag_')[0]}' AS variable, {f[-1]} AS type_of_error, count(*) FILTER ({f}) AS value FROM flagged GROUP BY date" for f in FLAGS]
    + [f"SELECT date, '{k}', 0, count(*) FILTER (NOT ({' OR '.join(f'{k}_flag_{c}' for c in v)})) FROM flagged GROUP BY date" for k, v in _GROUPS.items()]
)


def event_frequency(spark, sf):
    f = event_cleaning.frequency_metrics(_flagged(spark, sf), ["date"])
    return f.select(F.col("date").cast("string").alias("date"), "user_id_modulo", F.lower(F.hex("user_id")).alias("user_id"), "cell_id", "initial_frequency", "final_frequency")


def _semantic(spark, sf):
    return semantic_cleaning.flag_events(demo.events(spark, sf), demo.network_days(spark), cells=3000)


def semantic_flags(spark, sf):
    return _semantic(spark, sf).select("event_id", "error_flag")


def semantic_metrics(spark, sf):
    return semantic_cleaning.metrics(_semantic(spark, sf)).select(F.col("date").cast("string").alias("date"), "type_of_error", "value")


def event_cache(spark, sf):
    return semantic_cleaning.event_cache(_semantic(spark, sf)).select("user_id", F.col("date").cast("string").alias("date"), "event_id", "is_last_event")


_H = haversine("{0}lat", "{0}lon", "{1}lat", "{1}lon")
_FAR = "coalesce({d} / nullif(abs(t - {o}_t), 0) > 55.0 AND {d} > 10000, false)"


def _far(side: str) -> str:
    return _FAR.format(d=haversine("slat", "slon", f"{side}lat", f"{side}lon"), o=side)


SEM = (
    EV
    + """, j AS (SELECT ev.*, net.cell_id AS nc, net.lat AS nlat, net.lon AS nlon, vs, ve FROM ev LEFT JOIN net ON net.cell_id = ev.cell_id),
f0 AS (SELECT *, CASE WHEN domain = 'outbound' THEN 0 WHEN nc IS NULL THEN 1 WHEN ts < vs OR coalesce(ts > ve, false) THEN 2 END AS f FROM j),
f1 AS (SELECT *, domain <> 'outbound' AND (coalesce(lag(ts) OVER w = ts AND (lag(cell_id) OVER w IS DISTINCT FROM cell_id OR lag(latitude) OVER w IS DISTINCT FROM latitude OR lag(longitude) OVER w IS DISTINCT FROM longitude), false)
  OR coalesce(lead(ts) OVER w = ts AND (lead(cell_id) OVER w IS DISTINCT FROM cell_id OR lead(latitude) OVER w IS DISTINCT FROM latitude OR lead(longitude) OVER w IS DISTINCT FROM longitude), false)) AS twice FROM f0 WINDOW w AS (PARTITION BY user_id, date ORDER BY ts, cell_id)),
f2 AS (SELECT *, CASE WHEN twice THEN 5 ELSE f END AS g FROM f1),
f3 AS (SELECT *, CASE WHEN g IS NULL THEN coalesce(latitude, nlat) END AS slat, CASE WHEN g IS NULL THEN coalesce(longitude, nlon) END AS slon, CASE WHEN g IS NULL THEN t END AS st FROM f2),
f4 AS (SELECT *, last_value(st IGNORE NULLS) OVER b AS b_t, last_value(slat IGNORE NULLS) OVER b AS blat, last_value(slon IGNORE NULLS) OVER b AS blon, first_value(st IGNORE NULLS) OVER a AS a_t, first_value(slat IGNORE NULLS) OVER a AS alat, first_value(slon IGNORE NULLS) OVER a AS alon FROM f3
  WINDOW b AS (PARTITION BY user_id, date ORDER BY ts, cell_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (PARTITION BY user_id, date ORDER BY ts, cell_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
f5 AS (SELECT *, """
    + _far("b")
    + " AS fb, "
    + _far("a")
    + """ AS fa FROM f4),
sem AS (SELECT *, coalesce(g, CASE WHEN fb AND fa THEN 3 WHEN fb OR fa THEN 4 END, 0) AS error_flag FROM f5)"""
)


def network_clean(spark, sf):
    c = network_cleaning.clean_cells(network_cleaning.flag_cells(demo.raw_network(spark, sf)))
    return c.select("cell_row", "cell_id", "azimuth_angle", "power", "technology", "elevation_angle", "cell_type", F.unix_timestamp("valid_date_start").alias("vs"), F.unix_timestamp("valid_date_end").alias("ve"))


NET = r"""r0 AS (SELECT p_partkey AS p, DATE '2024-01-01' + cast(p_partkey % 10 AS INTEGER) AS date, p_size FROM part),
r AS (SELECT p AS cell_row, date, CASE WHEN p % 53 <> 0 THEN '21401' || lpad(cast(p AS VARCHAR), 9, '0') END AS cell_id, CASE WHEN p % 47 = 0 THEN 95.0 ELSE 40 + p % 100 * 0.01::DOUBLE END AS latitude, CASE WHEN p % 43 <> 0 THEN -4 + p % 100 * 0.01::DOUBLE END AS longitude,
  CASE WHEN p % 41 = 0 THEN 0.0 ELSE 10.0 + p % 40 END AS antenna_height, CASE WHEN p % 37 = 0 THEN 3 ELSE p % 2 END AS directionality, CASE WHEN p % 31 = 0 THEN NULL WHEN p % 29 = 0 THEN 361.0 ELSE cast(p % 360 AS DOUBLE) END AS azimuth_angle,
  CASE WHEN p % 23 = 0 THEN 91.0 ELSE cast(p % 10 AS DOUBLE) END AS elevation_angle, CASE WHEN p % 19 = 0 THEN -1.0 ELSE 9.0 END AS vertical_beam_width, CASE WHEN p % 17 = 0 THEN -5.0 ELSE cast(1 + p_size AS DOUBLE) END AS power,
  CASE WHEN p % 13 = 0 THEN '6G' WHEN p % 2 = 0 THEN 'LTE' ELSE '5G' END AS technology, CASE WHEN p % 11 = 0 THEN 'soon' ELSE strftime(date, '%Y-%m-%d 00:00:00') END AS vss,
  CASE WHEN p % 7 = 0 THEN strftime(date - 1, '%Y-%m-%d 00:00:00') WHEN p % 5 = 0 THEN strftime(date + 90, '%Y-%m-%d 00:00:00') END AS ves, CASE WHEN p % 59 = 0 THEN NULL WHEN p % 3 = 0 THEN 'macrocell' ELSE 'microcell' END AS cell_type FROM r0),
n AS (SELECT *, try_cast(vss AS TIMESTAMP) AS vs, try_cast(ves AS TIMESTAMP) AS ve FROM r),
nf AS (SELECT *, coalesce(vs > ve, false) AS bad_dates, cell_id IS NULL AS e_cell, latitude > 90 AS e_lat, longitude IS NULL AS e_lon, directionality NOT IN (0, 1) AS e_dir,
  coalesce(directionality = 1 AND (azimuth_angle IS NULL OR azimuth_angle > 360), false) AS e_az, antenna_height <= 0 AS e_ant, elevation_angle > 90 AS e_el, vertical_beam_width < 0 AS e_vb, power < 0 AS e_pow, technology = '6G' AS e_tech, vs IS NULL AS e_vs, cell_type IS NULL AS e_type FROM n),
nk AS (SELECT *, NOT (e_cell OR e_lat OR e_lon OR e_dir OR e_az) AS keep FROM nf)"""


def network_metrics(spark, sf):
    f = network_cleaning.flag_cells(demo.raw_network(spark, sf))
    return network_cleaning.metrics_by_column(f).where("value > 0 and type_code <> 0").select(F.col("date").cast("string").alias("date"), "field_name", "type_code", "value")


_ERRORS = (
    ("cell_id", 1, "e_cell", "cell_id"), ("latitude", 2, "e_lat", "latitude"), ("longitude", 1, "e_lon", "longitude"), ("directionality", 2, "e_dir", "directionality"), ("azimuth_angle", 1, "directionality = 1 AND azimuth_angle IS NULL", "azimuth_angle"),
    ("azimuth_angle", 2, "directionality = 1 AND azimuth_angle > 360", "azimuth_angle"), ("antenna_height", 2, "e_ant", "antenna_height"), ("elevation_angle", 2, "e_el", "elevation_angle"), ("vertical_beam_width", 2, "e_vb", "vertical_beam_width"),
    ("power", 2, "e_pow", "power"), ("technology", 2, "e_tech", "technology"), ("valid_date_start", 4, "e_vs", "vss"), ("cell_type", 1, "e_type", "cell_type"),
)
_NM = " UNION ALL ".join([f"SELECT date, '{f}' AS field_name, {c} AS type_code, count(*) AS value FROM nk WHERE {e} GROUP BY date" for f, c, e, _ in (*_ERRORS, ("dates", 2, "bad_dates", ""))] + ["SELECT date, NULL, 100, count(*) FROM nk GROUP BY date", "SELECT date, NULL, 101, count(*) FROM nk WHERE keep GROUP BY date"])


def network_row_metrics(spark, sf):
    return network_cleaning.row_metrics(network_cleaning.flag_cells(demo.raw_network(spark, sf))).select(F.col("date").cast("string").alias("date"), "variable", "value")


_ANY = "(NOT keep OR bad_dates OR e_ant OR e_el OR e_vb OR e_pow OR e_tech OR e_vs OR e_type)"


def network_top_errors(spark, sf):
    raw = demo.raw_network(spark, sf)
    t = network_cleaning.top_errors(raw, network_cleaning.flag_cells(raw), top=5)
    return t.select(F.col("date").cast("string").alias("date"), "field_name", "type_code", "error_value", "error_count", F.round("accumulated_percentage", 6).alias("accumulated_percentage"))


_VALUE = {"latitude": "'95.0'", "azimuth_angle": "CASE WHEN azimuth_angle IS NULL THEN NULL ELSE '361.0' END", "antenna_height": "'0.0'", "elevation_angle": "'91.0'", "vertical_beam_width": "'-1.0'", "power": "'-5.0'", "longitude": "cast(NULL AS VARCHAR)"}
_TE = " UNION ALL ".join(f"SELECT date, '{f}' AS field_name, {c} AS type_code, {_VALUE.get(f, f'cast({v} AS VARCHAR)')} AS error_value FROM nk WHERE {e}" for f, c, e, v in _ERRORS)
TOP_SQL = f"""WITH {NET}, e AS ({_TE}), c AS (SELECT date, field_name, type_code, error_value, count(*) AS error_count FROM e GROUP BY ALL),
x AS (SELECT *, row_number() OVER w AS rn, 100.0::DOUBLE * sum(error_count) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(error_count) OVER (PARTITION BY date) AS p FROM c WINDOW w AS (PARTITION BY date ORDER BY error_count DESC, field_name, type_code, error_value NULLS FIRST))
SELECT cast(date AS VARCHAR) AS date, field_name, type_code, error_value, error_count, round(p, 6) AS accumulated_percentage FROM x WHERE rn <= 5"""


def device_activity(spark, sf):
    s = activity.statistics(activity.preprocess(demo.events(spark, sf), demo.network_days(spark), "Europe/Madrid"))
    r = lambda c, n: F.round(c, n).alias(c)
    return s.select("user_id", F.col("local_date").cast("string").alias("local_date"), "event_cnt", "unique_cell_cnt", "unique_location_cnt", r("sum_distance_m", 2), "unique_hour_cnt", r("mean_time_gap", 4), r("stdev_time_gap", 4))


ACTIVITY_SQL = (
    f"WITH {EV}, a AS (SELECT ev.*, ts + INTERVAL 1 HOUR AS lt, coalesce(latitude, net.lat) AS la, coalesce(longitude, net.lon) AS lo FROM ev LEFT JOIN net ON net.cell_id = ev.cell_id AND ev.date <= DATE '2024-01-30'), "
    "c AS (SELECT *, cast(lt AS DATE) AS ld FROM a), n AS (SELECT *, lead(t) OVER w AS nt, lead(la) OVER w AS na, lead(lo) OVER w AS no FROM c WINDOW w AS (PARTITION BY user_id, ld ORDER BY ts, cell_id)), "
    f"d AS (SELECT *, nt - t AS gap, {haversine('la', 'lo', 'na', 'no')} AS dist FROM n) "
    "SELECT user_id, cast(ld AS VARCHAR) AS local_date, count(*) AS event_cnt, count(DISTINCT cell_id) AS unique_cell_cnt, count(DISTINCT CASE WHEN la IS NOT NULL AND lo IS NOT NULL THEN (la, lo) END) AS unique_location_cnt, "
    "round(coalesce(sum(dist), 0), 2) AS sum_distance_m, count(DISTINCT hour(lt)) AS unique_hour_cnt, round(avg(gap), 4) AS mean_time_gap, round(stddev_samp(gap), 4) AS stdev_time_gap FROM d GROUP BY user_id, ld"
)


def device_area(spark, sf):
    """Events of devices that were seen in a triangle, sampled."""
    cells = demo.network_days(spark).where("date = '2024-01-01'")
    inside = device_filter.cells_in_polygon(device_filter.cells_in_box(cells, -60, -30, 60, 30), [(-50.0, -30.0), (50.0, -30.0), (0.0, 25.0), (-50.0, -30.0)])
    ev = device_filter.sample_devices(device_filter.events_of_devices_seen(demo.events(spark, sf), inside), 0.5)
    return ev.select("event_id", "user_id")


AREA_SQL = f"""WITH {EV}, e AS (SELECT * FROM ev), c AS (SELECT cell_id FROM net WHERE lat BETWEEN -30 AND 30 AND lon BETWEEN -60 AND 60 AND lat > -30 AND abs(lon) < 50 * (25 - lat) / 55.0)
SELECT event_id, user_id FROM e WHERE user_id IN (SELECT user_id FROM e JOIN c USING (cell_id)) AND ('0x' || substr(md5(cast(user_id AS VARCHAR)), 1, 8))::BIGINT % 10000 < 5000"""

def event_bounds(spark, sf):
    """Bounds that are off by default: a bounding box, the length of cell ids, and buckets of users hashed again."""
    e = demo.bronze_events(spark, sf)
    e = e.withColumn("cell_id", F.when(F.col("event_id") % 5 == 0, F.substring("cell_id", 1, 10)).otherwise(F.col("cell_id")))
    f = event_cleaning.flag_events(e, event_cleaning.Params(bbox=(-3.98, 40.02, -3.93, 40.08), check_cell_length=True, rehash=True, deduplicate=False), F.col("date"))
    return f.select("event_id", "latitude_flag_2", "longitude_flag_2", "cell_id_flag_2", "user_id_modulo", "to_preserve")


BOUNDS_SQL = f"""WITH {BRONZE}, b1 AS (SELECT *, coalesce(latitude NOT BETWEEN 40.02::DOUBLE AND 40.08::DOUBLE, false) AS la, coalesce(longitude NOT BETWEEN -3.98::DOUBLE AND -3.93::DOUBLE, false) AS lo, event_id % 5 = 0 AND cell_id IS NOT NULL AS ci FROM flagged)
SELECT event_id, la AS latitude_flag_2, lo AS longitude_flag_2, ci AS cell_id_flag_2, cast(('0x' || substr(sha256(unhex(user_id)), 1, 14))::BIGINT % 8 AS INTEGER) AS user_id_modulo,
  NOT (la OR lo OR ci OR user_id_flag_1 OR timestamp_flag_1 OR mcc_flag_1 OR mnc_flag_1 OR timestamp_flag_4 OR mcc_flag_2 OR plmn_flag_2 OR mnc_flag_2 OR timestamp_flag_2 OR no_mno_info_flag_5 OR no_location_flag_6) AS to_preserve FROM b1"""


def network_cell_length(spark, sf):
    raw = demo.raw_network(spark, sf)
    raw = raw.withColumn("cell_id", F.when(F.col("cell_row") % 6 == 0, F.substring("cell_id", 1, 12)).otherwise(F.col("cell_id")))
    return network_cleaning.flag_cells(raw, network_cleaning.Params(check_cell_length=True)).select("cell_row", "cell_id_flag_1", "cell_id_flag_2", "cell_id_flag_0")


LENGTH_SQL = "SELECT p_partkey AS cell_row, p_partkey % 53 = 0 AS cell_id_flag_1, p_partkey % 6 = 0 AND p_partkey % 53 <> 0 AS cell_id_flag_2, p_partkey % 6 <> 0 AND p_partkey % 53 <> 0 AS cell_id_flag_0 FROM part"

_BUCKET = "cast(('0x' || substr(user_id, 1, 14))::BIGINT % 8 AS INTEGER)"
QUERIES = {
    "event_flags": (event_flags, f"WITH {BRONZE} SELECT event_id, {', '.join(FLAGS)}, domain, to_preserve FROM flagged"),
    "event_clean": (event_clean, f"WITH {BRONZE}, k AS (SELECT *, t - INTERVAL 1 HOUR AS u FROM flagged WHERE to_preserve) SELECT event_id, user_id, cast(epoch(u) AS BIGINT) AS t, domain, {_BUCKET} AS user_id_modulo, cast(year(u) AS INTEGER) AS year, cast(month(u) AS INTEGER) AS month, cast(day(u) AS INTEGER) AS day FROM k"),
    "event_metrics_by_column": (event_metrics, f"WITH {BRONZE} SELECT cast(date AS VARCHAR) AS date, variable, type_of_error, value FROM ({_METRICS})"),
    "event_frequency": (event_frequency, f"WITH {BRONZE} SELECT cast(date AS VARCHAR) AS date, coalesce({_BUCKET}, -1) AS user_id_modulo, user_id, cell_id, count(*) AS initial_frequency, count(*) FILTER (to_preserve) AS final_frequency FROM flagged GROUP BY ALL"),
    "semantic_flags": (semantic_flags, f"WITH {SEM} SELECT event_id, error_flag FROM sem"),
    "semantic_metrics": (semantic_metrics, f"WITH {SEM} SELECT cast(d.date AS VARCHAR) AS date, cast(c AS INTEGER) AS type_of_error, count(error_flag) AS value FROM (SELECT DISTINCT date FROM ev) d CROSS JOIN range(6) r(c) LEFT JOIN sem ON sem.date = d.date AND error_flag = c GROUP BY ALL"),
    "event_cache": (event_cache, f"WITH {SEM}, v AS (SELECT *, row_number() OVER (PARTITION BY user_id, date ORDER BY ts, cell_id) AS a, row_number() OVER (PARTITION BY user_id, date ORDER BY ts DESC, cell_id DESC) AS z FROM sem WHERE error_flag = 0) SELECT user_id, cast(date AS VARCHAR) AS date, event_id, false AS is_last_event FROM v WHERE a = 1 UNION ALL SELECT user_id, cast(date AS VARCHAR), event_id, true FROM v WHERE z = 1"),
    "network_clean": (network_clean, f"WITH {NET} SELECT cell_row, cell_id, azimuth_angle, CASE WHEN NOT e_pow THEN power END AS power, CASE WHEN NOT e_tech THEN technology END AS technology, CASE WHEN NOT e_el THEN elevation_angle END AS elevation_angle, cell_type, cast(epoch(CASE WHEN NOT bad_dates THEN vs END) AS BIGINT) AS vs, cast(epoch(CASE WHEN NOT bad_dates THEN ve END) AS BIGINT) AS ve FROM nk WHERE keep"),
    "network_metrics": (network_metrics, f"WITH {NET} SELECT cast(date AS VARCHAR) AS date, field_name, type_code, value FROM ({_NM})"),
    "network_row_metrics": (network_row_metrics, f"WITH {NET} SELECT cast(date AS VARCHAR) AS date, 'rows_deleted' AS variable, count(*) FILTER (NOT keep) AS value FROM nk GROUP BY date UNION ALL SELECT cast(date AS VARCHAR), 'rows_with_some_error', count(*) FILTER ({_ANY}) FROM nk GROUP BY date"),
    "network_top_errors": (network_top_errors, TOP_SQL),
    "device_activity": (device_activity, ACTIVITY_SQL),
    "device_area": (device_area, AREA_SQL),
    "event_bounds": (event_bounds, BOUNDS_SQL),
    "network_cell_length": (network_cell_length, LENGTH_SQL),
}
