"""Quality warnings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import coverage, event_cleaning, network_cleaning, quality, semantic_cleaning
from ..sources import demo
from .cleaning import _METRICS, _NM, NET, SEM, _flagged, _semantic
from .views import BRONZE, EV, FOOT



def _frequency(spark, sf):
    return event_cleaning.frequency_metrics(_flagged(spark, sf), ["date"])


def _out(df, *keys):
    return df.withColumn("date", F.col("date").cast("string")).select("date", *keys, F.round("daily_value", 6).alias("daily_value"), "warning", F.round("condition_value", 6).alias("condition_value"))


def qw_size(spark, sf):
    f = _frequency(spark, sf)
    return _out(quality.size_warnings(f, "initial_frequency", 7, 1.0, 320, 345)).withColumn("kind", F.lit("raw")).unionByName(_out(quality.size_warnings(f, "final_frequency", 7, 1.0, 290, 310)).withColumn("kind", F.lit("clean")))


def qw_error_rate(spark, sf):
    f = _frequency(spark, sf)
    return _out(quality.rate_warnings(quality.error_rate(f, ["date"]), ["date"], 7, 1.0, 5.0, 11.0))


def qw_error_rate_by_cell(spark, sf):
    r = quality.error_rate(_frequency(spark, sf).where("cell_id is not null"), ["date", "cell_id"])
    return _out(quality.rate_warnings(r, ["date", "cell_id"], None, 2.5, 300.0, 60.0), "cell_id")


def _named(spark, sf):
    """Frequencies of rows with a user, its id as text."""
    return _frequency(spark, sf).where("user_id is not null").withColumn("user_id", F.lower(F.hex("user_id")))


def qw_error_rate_by_user(spark, sf):
    return _out(quality.rate_warnings(quality.error_rate(_named(spark, sf), ["date", "user_id"]), ["date", "user_id"], None, 2.5, 300.0, 60.0), "user_id")


def qw_error_rate_by_user_cell(spark, sf):
    r = quality.error_rate(_named(spark, sf).where("cell_id is not null"), ["date", "user_id", "cell_id"])
    return _out(quality.rate_warnings(r, ["date", "user_id", "cell_id"], None, 2.5, 300.0, 60.0), "user_id", "cell_id")


def qw_error_type(spark, sf):
    f = _flagged(spark, sf)
    r = quality.error_type_rate(event_cleaning.metrics_by_column(f, ["date"]), event_cleaning.frequency_metrics(f, ["date"]))
    return _out(quality.rate_warnings(r, ["date", "variable", "type_of_error"], 7, 2.0, 80.0, 2.0), "variable", "type_of_error")


def _rate_sql(src: str, keys: str, others: str, rows: int | None, var: float, over: float, upper: float) -> str:
    w = "(PARTITION BY date)" if rows is None else f"({f'PARTITION BY {others} ' if others else ''}ORDER BY date ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING)"
    return f"""q AS (SELECT *, avg(v) OVER w AS a, avg(v) OVER w + {var}::DOUBLE * stddev_samp(v) OVER w AS u FROM {src} WINDOW w AS {w}),
z AS (SELECT {keys}, v, 'upper_variability' AS warning, u AS c FROM q WHERE round(v - u, 9) > 0 UNION ALL SELECT {keys}, v, 'over_average', {over} FROM q WHERE a <> 0 AND round(v / a * 100 - 100 - {over}, 9) > 0 UNION ALL SELECT {keys}, v, 'upper_limit', {upper} FROM q WHERE v > {upper})
SELECT cast(date AS VARCHAR) AS date{''.join(f', {k}' for k in keys.split(', ')[1:])}, round(v, 6) AS daily_value, warning, round(c::DOUBLE, 6) AS condition_value FROM z"""


def _size_sql(kind: str, agg: str, lo: int, hi: int) -> str:
    return f"""SELECT cast(date AS VARCHAR) AS date, v AS daily_value, warning, round(c::DOUBLE, 6) AS condition_value, '{kind}' AS kind FROM (WITH d AS (SELECT date, {agg} AS v FROM flagged GROUP BY date), q AS (SELECT *, avg(v) OVER w - stddev_samp(v) OVER w AS l, avg(v) OVER w + stddev_samp(v) OVER w AS u FROM d WINDOW w AS (ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT date, v, 'lower_variability' AS warning, l AS c FROM q WHERE round(l - v, 9) > 0 UNION ALL SELECT date, v, 'upper_variability', u FROM q WHERE round(v - u, 9) > 0 UNION ALL SELECT date, v, 'lower_limit', {lo} FROM q WHERE v < {lo} UNION ALL SELECT date, v, 'upper_limit', {hi} FROM q WHERE v > {hi})"""


def _rates(spark, sf):
    return quality.semantic_rates(semantic_cleaning.metrics(_semantic(spark, sf)))


def qw_semantic(spark, sf):
    return _out(quality.semantic_warnings(_rates(spark, sf), 7, 1.0, 8.0), "type_of_error")


def semantic_log(spark, sf):
    l = quality.semantic_log(_rates(spark, sf))
    return l.withColumn("date", F.col("date").cast("string")).select("date", *[F.round(f"error_{c}", 6).alias(f"error_{c}") for c in (1, 2, 3, 4, 5)])


_SR = SEM + """, dc AS (SELECT d.date, cast(c AS INTEGER) AS type_of_error, count(error_flag) AS n FROM (SELECT DISTINCT date FROM ev) d CROSS JOIN range(6) r(c) LEFT JOIN sem ON sem.date = d.date AND error_flag = c GROUP BY ALL),
sr AS (SELECT date, type_of_error, v FROM (SELECT *, n / sum(n) OVER (PARTITION BY date) * 100 AS v FROM dc) WHERE type_of_error <> 0)"""


def _network(spark, sf):
    return network_cleaning.metrics_by_column(network_cleaning.flag_cells(demo.raw_network(spark, sf)))


def qw_network(spark, sf):
    return _out(quality.network_warnings(_network(spark, sf), 4, 1.0, 20.0, 20.0, 150, 1e9, 25.0), "measure")


NETWORK_SQL = f"""WITH {NET}, m0 AS ({_NM}), tot AS (SELECT date, value AS r FROM m0 WHERE type_code = 100),
codes AS (SELECT DISTINCT field_name, type_code FROM m0 WHERE field_name IS NOT NULL), me AS (SELECT date, CASE type_code WHEN 100 THEN 'raw_size' ELSE 'clean_size' END AS measure, value::DOUBLE AS v FROM m0 WHERE type_code >= 100
 UNION ALL SELECT date, 'error_rate', 100 - value / r * 100 FROM m0 JOIN tot USING (date) WHERE type_code = 101
 UNION ALL SELECT t.date, 'rate_' || c.field_name || '_' || c.type_code, coalesce(value, 0) / r * 100 FROM tot t CROSS JOIN codes c LEFT JOIN m0 ON m0.date = t.date AND m0.field_name = c.field_name AND m0.type_code = c.type_code),
q AS (SELECT *, measure LIKE '%size' AS sz, avg(v) OVER w AS a, avg(v) OVER w - stddev_samp(v) OVER w AS l, avg(v) OVER w + stddev_samp(v) OVER w AS u FROM me WINDOW w AS (PARTITION BY measure ORDER BY date ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)),
z AS (SELECT date, measure, v, 'over_average' AS warning, 20 AS c FROM q WHERE v > a * 1.2::DOUBLE UNION ALL SELECT date, measure, v, 'under_average', 20 FROM q WHERE sz AND v < a * 0.8::DOUBLE UNION ALL SELECT date, measure, v, 'upper_variability', u FROM q WHERE v > u UNION ALL SELECT date, measure, v, 'lower_variability', l FROM q WHERE sz AND v < l
 UNION ALL SELECT date, measure, v, 'upper_limit', 25 FROM q WHERE NOT sz AND v > 25 UNION ALL SELECT date, measure, v, 'lower_limit', 150 FROM q WHERE sz AND v < 150)
SELECT cast(date AS VARCHAR) AS date, measure, round(v, 6) AS daily_value, warning, round(c::DOUBLE, 6) AS condition_value FROM z"""


def network_plots(spark, sf):
    lines = quality.plot_lines(_network(spark, sf).where("type_code = 100").select("date", F.col("value").cast("double").alias("daily_value")), ["date"], 4, 1.0)
    shares = quality.plot_shares(_network(spark, sf)).groupBy("field_name").agg(F.sum("value").alias("value"))
    a = lines.withColumn("date", F.col("date").cast("string")).select("date", F.lit("line").alias("kind"), "daily_value", F.round("average", 6).alias("average"))
    return a.unionByName(shares.select(F.col("field_name").alias("date"), F.lit("pie").alias("kind"), F.col("value").cast("double").alias("daily_value"), F.lit(None).cast("double").alias("average")))


def footprint_missing(spark, sf):
    fp = coverage.dominance(coverage.tiles_in_range(coverage.impute_defaults(demo.cells(spark)), demo.lattice(spark).drop("k"), coverage.Params(bin_size=250.0))).where("signal_dominance > 0.9999")
    ev = demo.events(spark, sf)
    m = quality.footprint_metrics(demo.network_days(spark), fp, ev, 20.0, 5.0)
    return m.withColumn("date", F.col("date").cast("string")).select("date", "cell_id", "events", F.round("percent", 6).alias("percent"), "status")


MISSING_SQL = f"""WITH {EV}, {FOOT}, lk AS (SELECT d.date, net.cell_id FROM net, (SELECT DATE '2024-01-01' + cast(i AS INTEGER) AS date FROM range(30) r(i)) d WHERE net.cell_id NOT IN (SELECT cell_id FROM sd WHERE sd > 0.9999)),
c AS (SELECT l.date, l.cell_id, count(e.event_id) AS events FROM lk l LEFT JOIN ev e ON e.date = l.date AND e.cell_id = l.cell_id GROUP BY ALL), a AS (SELECT date, count(*) AS n FROM ev GROUP BY date),
p AS (SELECT c.date, cell_id, events, coalesce(events * 100.0::DOUBLE / n, 0) AS percent FROM c LEFT JOIN a ON a.date = c.date)
SELECT cast(date AS VARCHAR) AS date, cell_id, events, round(percent, 6) AS percent, CASE WHEN sum(percent) OVER (PARTITION BY date) > 20 THEN 'critical' WHEN sum(percent) OVER (PARTITION BY date) > 5 THEN 'warning' ELSE 'ok' END AS status FROM p"""

_ER = "(count(*) - count(*) FILTER (to_preserve)) / count(*) * 100::DOUBLE"
QUERIES = {
    "qw_size": (qw_size, f"WITH {BRONZE} {_size_sql('raw', 'count(*)', 320, 345)} UNION ALL {_size_sql('clean', 'count(*) FILTER (to_preserve)', 290, 310)}"),
    "qw_error_rate": (qw_error_rate, f"WITH {BRONZE}, er AS (SELECT date, {_ER} AS v FROM flagged GROUP BY date), " + _rate_sql("er", "date", "", 7, 1.0, 5.0, 11.0)),
    "qw_error_rate_by_cell": (qw_error_rate_by_cell, f"WITH {BRONZE}, er AS (SELECT date, cell_id, {_ER} AS v FROM flagged WHERE cell_id IS NOT NULL GROUP BY date, cell_id), " + _rate_sql("er", "date, cell_id", "cell_id", None, 2.5, 300.0, 60.0)),
    "qw_error_rate_by_user": (qw_error_rate_by_user, f"WITH {BRONZE}, er AS (SELECT date, user_id, {_ER} AS v FROM flagged WHERE user_id IS NOT NULL GROUP BY date, user_id), " + _rate_sql("er", "date, user_id", "user_id", None, 2.5, 300.0, 60.0)),
    "qw_error_rate_by_user_cell": (qw_error_rate_by_user_cell, f"WITH {BRONZE}, er AS (SELECT date, user_id, cell_id, {_ER} AS v FROM flagged WHERE user_id IS NOT NULL AND cell_id IS NOT NULL GROUP BY date, user_id, cell_id), " + _rate_sql("er", "date, user_id, cell_id", "user_id, cell_id", None, 2.5, 300.0, 60.0)),
    "qw_error_type": (qw_error_type, f"WITH {BRONZE}, er AS (SELECT m.date, variable, type_of_error, value / n * 100::DOUBLE AS v FROM ({_METRICS}) m JOIN (SELECT date, count(*) AS n FROM flagged GROUP BY date) t USING (date) WHERE type_of_error <> 0), " + _rate_sql("er", "date, variable, type_of_error", "variable, type_of_error", 7, 2.0, 80.0, 2.0)),
    "qw_semantic": (qw_semantic, f"WITH {_SR}, q AS (SELECT *, CASE WHEN count(*) OVER w >= 2 THEN avg(v) OVER w + stddev_samp(v) OVER w ELSE 8.0::DOUBLE END AS b FROM sr WINDOW w AS (PARTITION BY type_of_error ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) SELECT cast(date AS VARCHAR) AS date, type_of_error, round(v, 6) AS daily_value, 'upper_control_limit' AS warning, round(b, 6) AS condition_value FROM q WHERE v > b"),
    "semantic_log": (semantic_log, f"WITH {_SR} SELECT cast(date AS VARCHAR) AS date, " + ", ".join(f"round(max(CASE WHEN type_of_error = {c} THEN v END), 6) AS error_{c}" for c in (1, 2, 3, 4, 5)) + " FROM sr GROUP BY date"),
    "qw_network": (qw_network, NETWORK_SQL),
    "network_plots": (network_plots, f"WITH {NET}, m0 AS ({_NM}) SELECT cast(date AS VARCHAR) AS date, 'line' AS kind, value::DOUBLE AS daily_value, round(avg(value) OVER (ORDER BY date ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), 6) AS average FROM m0 WHERE type_code = 100 UNION ALL SELECT field_name, 'pie', sum(value)::DOUBLE, NULL FROM m0 WHERE field_name IS NOT NULL GROUP BY field_name"),
    "footprint_missing": (footprint_missing, MISSING_SQL),
}
