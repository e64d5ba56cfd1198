"""Schemas, sources, jobs, plans, coverage models and streams on small frames."""

import json
import math
import shutil
import struct

import pytest
from pyspark.sql import functions as F

from cellscape import jobs, schemas
from cellscape.functions import geo, grid
from cellscape.operators import coverage, event_cleaning, export, migration, network_cleaning, permanence, population, quality, tourism, usual_environment, zoning
from cellscape.plans import iterate, joins, windows
from cellscape.sources import tables
from cellscape.streaming import sessions


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_conform_and_audit(spark):
    df = spark.createDataFrame([("1", 2.5, "x"), (None, 1.0, "y")], "grid_id string, population double, extra string")
    out = schemas.conform(df, schemas.POPULATION)
    assert out.schema == schemas.POPULATION.schema and out.first()["grid_id"] == 1 and out.first()["timestamp"] is None
    found = {(r["column_name"], r["problem"]): r["rows"] for r in schemas.audit(df, schemas.POPULATION, ("grid_id",)).collect()}
    assert found["extra", "not declared"] == 0 and found["grid_id", "null"] == 1 and ("timestamp", "missing") in found
    with pytest.raises(ValueError, match="population"):
        schemas.assert_conforms(df, schemas.POPULATION)


@pytest.mark.parametrize("e,n", [(0, 0), (0, 65535), (32767, 1), (32768, 2), (65535, 65535)])
def test_grid_ids_round_trip(spark, e, n):
    g = grid.pack(F.lit(e), F.lit(n))
    assert (one(spark, grid.easting_index(g)), one(spark, grid.northing_index(g))) == (e, n)
    assert (one(spark, g) < 0) == (e >= 32768)


def test_inspire_names(spark):
    g, o = grid.pack(F.lit(13), F.lit(27)), grid.origin(F.lit(3_000_000), F.lit(2_000_000))
    assert one(spark, grid.inspire_id(g, o)) == "100mN20027E30013" and one(spark, grid.inspire_id(g, o, 1000)) == "1kmN2002E3001"
    x, y = grid.inspire_centroid(F.lit("1kmN2002E3001"))
    assert (one(spark, x), one(spark, y)) == (3_001_500, 2_002_500)


def test_projection_known_points(spark):
    x, y = geo.project(52.0, 10.0)
    assert (round(x, 6), round(y, 6)) == (4321000, 3210000)
    cx, cy = geo.to_grid(F.lit(40.4168), F.lit(-3.7038))
    px, py = geo.project(40.4168, -3.7038)
    assert one(spark, cx) == pytest.approx(px) and one(spark, cy) == pytest.approx(py)
    assert abs(px - 3_160_000) < 10_000 and abs(py - 2_030_000) < 10_000


def test_haversine(spark):
    assert one(spark, geo.haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))) == pytest.approx(math.pi * geo.EARTH_RADIUS)
    assert one(spark, geo.haversine(F.lit(1.0), F.lit(None).cast("double"), F.lit(0.0), F.lit(1.0))) is None


def test_lattice_join_is_exact(spark):
    a = spark.range(60).select("id", (F.col("id") * 37 % 100).cast("double").alias("x"), (F.col("id") * 53 % 100).cast("double").alias("y"))
    b = a.select(F.col("id").alias("other"), F.col("x").alias("other_x"), F.col("y").alias("other_y"))
    got = {(r["id"], r["other"]) for r in joins.lattice_range_join(a, b, 17.0, 10.0).collect()}
    rows = [(r["id"], r["x"], r["y"]) for r in a.collect()]
    assert got == {(i, j) for i, x, y in rows for j, u, v in rows if math.hypot(x - u, y - v) <= 17}


def test_nearest_in_time_ties_and_bounds(spark):
    pts = spark.createDataFrame([(100,)], "p long")
    ev = spark.createDataFrame([(1, 90, "b"), (1, 110, "a"), (2, 150, "c"), (3, 151, "d"), (4, 90, "z"), (4, 90, "y")], "u long, t long, c string")
    got = {r["u"]: r["c"] for r in joins.nearest_in_time(pts, ev, ["u"], "p", "t", 50, ["c"]).collect()}
    assert got == {1: "b", 2: "c", 4: "y"}


def test_islands_break_strictly_over_the_gap(spark):
    df = spark.createDataFrame([(1, 0, 10), (1, 20, 25), (1, 36, 40), (1, 38, 39), (1, 50, 51)], "u long, s long, e long")
    got = windows.gaps_and_islands(df, ["u"], ["s", "e"], F.col("s"), F.col("e"), 10, "g").orderBy("s").collect()
    assert [r["g"] for r in got] == [0, 0, 36, 36, 36]


def test_iteration_stops(spark):
    df = spark.createDataFrame([("a", 8.0), ("b", 0.0)], "k string, v double")
    out = iterate.iterate_until(df, lambda s: s.select("k", (F.col("v") / 2).alias("v")), ["k"], "v", 0.6, 50)
    assert {r["k"]: r["v"] for r in out.collect()} == {"a": 0.5, "b": 0.0}


def test_population_step_by_hand(spark):
    """Two cells, three tiles, one unseen; two iterations."""
    devices = spark.createDataFrame([("p", "A", 6), ("p", "B", 4)], "time_point string, cell_id string, device_count long")
    prob = spark.createDataFrame([("A", 1, 1.0), ("A", 2, 0.5), ("B", 2, 0.5)], "cell_id string, grid_id int, cell_connection_probability double")
    tiles = spark.createDataFrame([(1,), (2,), (3,)], "grid_id int")
    got = {r["grid_id"]: r["population"] for r in population.fixed_iterations(devices, prob, tiles, 1).collect()}
    assert got == pytest.approx({1: 4.0, 2: 2.0 + 4.0})
    two = {r["grid_id"]: r["population"] for r in population.fixed_iterations(devices, prob, tiles, 2).collect()}
    w = 4 * 1.0 / (4 * 1.0 + 6 * 0.5)
    assert two == pytest.approx({1: 6 * w, 2: 6 * (1 - w) + 4}) and sum(two.values()) == pytest.approx(10)
    assert population.present_population(devices.limit(0), prob, tiles).count() == 0
    full = population.present_population(devices, prob, tiles, 30, 1e-6)
    assert sum(r["population"] for r in full.collect()) == pytest.approx(10)


def test_time_points(spark):
    got = [str(r[0]) for r in population.time_points(spark, "2024-01-01 00:00:00", "2024-01-02 00:00:00", 43200).collect()]
    assert got == ["2024-01-01 00:00:00", "2024-01-01 12:00:00", "2024-01-02 00:00:00"]


def test_event_bounds(spark):
    rows = [
        ("a", "2024-01-02 00:00:00", 100, "01", 10000, "c"), ("b", "2024-01-02 00:00:01", 999, "001", 99999, "c"), ("c", "2024-01-01 00:00:00", 99, "1", 9999, "c"), ("d", "x", 1000, "0001", 100000, None),
        ("e", None, None, None, None, None), ("f", "2024-01-01 10:00:00", 214, "01", 20801, None), ("f", "2024-01-01 10:00:00", 214, "01", 20801, None), (None, "2024-01-01 10:00:00", 214, "01", None, "c"),
    ]
    df = spark.createDataFrame(rows, "user_id string, timestamp string, mcc int, mnc string, plmn int, cell_id string").withColumns({"user_id": F.col("user_id").cast("binary"), "latitude": F.lit(None).cast("double"), "longitude": F.lit(None).cast("double"), "date": F.lit("2024-01-01").cast("date"), "n": F.monotonically_increasing_id()})
    got = event_cleaning.flag_events(df, date=F.col("date"), tie_break=["n"]).orderBy("n").collect()
    col = lambda c: [r[c] for r in got]
    assert col("timestamp_flag_2") == [False, True] + [False] * 6
    assert col("mcc_flag_2") == [False, False, True, True] + [False] * 4
    assert col("mnc_flag_2") == [False, False, True, True] + [False] * 4
    assert col("plmn_flag_2") == [False, False, True, True] + [False] * 4
    assert col("timestamp_flag_4")[3] and not col("timestamp_flag_4")[4] and col("timestamp_flag_1")[4]
    assert col("no_mno_info_flag_5") == [False] * 4 + [True] + [False] * 3
    assert sum(col("duplicated_flag_7")) == 1 and col("domain")[5] == "outbound" and not col("no_location_flag_6")[5]
    assert [r["to_preserve"] for r in got] == [True, False, False, False, False, True, False, False] or [r["to_preserve"] for r in got] == [True, False, False, False, False, False, True, False]


def test_network_percent_cut(spark):
    raw = spark.createDataFrame([(i, v) for i, v in enumerate([95.0] * 6 + [96.0] * 3 + [97.0])], "cell_row long, latitude double")
    full = raw.selectExpr("*", "date'2024-01-01' AS date", "'c' AS cell_id", "1.0 AS longitude", "1.0 AS altitude", "1.0 AS antenna_height", "0 AS directionality", "cast(null as double) AS azimuth_angle", "1.0 AS elevation_angle", "1.0 AS horizontal_beam_width", "1.0 AS vertical_beam_width", "1.0 AS power", "1.0 AS range", "1 AS frequency", "'LTE' AS technology", "'2024-01-01 00:00:00' AS valid_date_start", "cast(null as string) AS valid_date_end", "'macrocell' AS cell_type")
    flagged = network_cleaning.flag_cells(full)
    got = network_cleaning.top_errors(full, flagged, percent=70.0).collect()
    assert [(r["error_value"], r["error_count"]) for r in sorted(got, key=lambda r: -r["error_count"])] == [("95.0", 6), ("96.0", 3)]
    assert not flagged.where("to_preserve").count() and flagged.where("azimuth_angle_flag_1").count() == 0


def test_beam_table_loses_three_decibels(spark):
    rows = {r["beam_degree"]: r["sd"] for r in coverage.beam_table(spark, [-30.0]).collect()}
    for half in (10, 20, 33):  # the widest curve of the table loses more than 3 dB from 51 degrees on
        loss = one(spark, coverage.angular_loss(F.lit(float(half)), F.lit(rows[half]), F.lit(-30.0)))
        assert loss == pytest.approx(-3, abs=0.3)
    assert one(spark, coverage.angular_loss(F.lit(180.0), F.lit(rows[33]), F.lit(-30.0))) == pytest.approx(-30)
    assert one(spark, coverage.angular_loss(F.lit(-350.0), F.lit(rows[33]), F.lit(-30.0))) == one(spark, coverage.angular_loss(F.lit(10.0), F.lit(rows[33]), F.lit(-30.0)))


def test_footprint_ties_and_groups(spark):
    fp = spark.createDataFrame([("a", 1, 0.5), ("b", 1, 0.5), ("c", 1, 0.45), ("a", 2, 0.9), ("a", 3, 0.2), ("b", 3, 0.1)], "cell_id string, grid_id int, signal_dominance double")
    assert {(r["cell_id"], r["grid_id"]) for r in coverage.prune_top(fp, coverage.Params(cells_per_tile=1)).collect()} == {("a", 1), ("a", 2), ("a", 3)}
    assert {(r["cell_id"], r["grid_id"]) for r in coverage.prune_share_of_best(fp, coverage.Params(best_percent=90)).collect()} == {("a", 1), ("b", 1), ("c", 1), ("a", 2), ("a", 3)}
    g = {tuple(r["cells"]): r["grid_ids"] for r in coverage.footprint_groups(fp.where("cell_id <> 'c'")).collect()}
    assert g == {("a", "b"): [1, 3], ("a",): [2]}


def test_zoning(spark):
    square = [(0.0, 0.0), (100.0, 0.0), (100.0, 100.0), (0.0, 100.0), (0.0, 0.0)]
    z = spark.createDataFrame([("z", [{"x": x, "y": y} for x, y in square])], "zone_id string, ring array<struct<x: double, y: double>>")
    t = spark.createDataFrame([(1, 50.0, 50.0), (2, 150.0, 50.0), (3, 99.0, 1.0)], "grid_id int, tile_x double, tile_y double")
    assert {r["grid_id"]: r["zone_id"] for r in zoning.map_zones(t, z, 30.0).collect()} == {1: "z", 2: "undefined", 3: "z"}
    assert one(spark, zoning.zone_at_level(F.lit("A|A1|A11"), 3)) == "A11" and one(spark, zoning.zone_at_level(F.lit("A"), 2)) is None
    assert [one(spark, zoning.nuts_parent(F.lit(x))) for x in ("ES", "ES3", "ES30")] == [None, "ES", "ES3"]
    box = zoning.snapped_extent(-3.71, 40.41, -3.70, 40.42, 5, 4)
    assert (box[2] - box[0]) % 400 == 0 and zoning.blueprint(spark, box, 4).count() == 16
    assert zoning.cover(spark, box).select("grid_id").distinct().count() == (box[2] - box[0]) * (box[3] - box[1]) // 10_000


def test_stay_gap_bounds(spark):
    p = permanence.DailyParams()
    noon = 12 * 3600
    cells = spark.createDataFrame([("a", 0.0, 0.0), ("b", 10.0, 0.0)], "cell_id string, x double, y double")
    ev = spark.createDataFrame([(1, noon, "a"), (1, noon + 7200, "a"), (1, noon + 7200 + 901, "b")], "user_id long, t long, cell_id string").selectExpr("*", "cast(null as int) AS plmn", "false AS abroad")
    got = permanence.stay_intervals(permanence.without_moves(permanence.enrich(ev, cells, p), p), p).orderBy("init").collect()
    assert [(r["init"] - noon, r["end"] - noon) for r in got] == [(-450, 3600), (3600, 7650), (7651, 8551)]
    users = spark.createDataFrame([(1, 0)], "user_id long, day long")
    slots = permanence.slot_durations(permanence.stay_intervals(permanence.enrich(ev, cells, p), p), users, p)
    assert slots.where("cell_id = '-99'").count() == 24 - slots.where("cell_id <> '-99'").select("slot").distinct().count()


def test_night_gap_and_moves(spark):
    p = permanence.DailyParams()
    cells = spark.createDataFrame([("a", 0.0, 0.0), ("b", 100_000.0, 0.0)], "cell_id string, x double, y double")
    rows = [(1, 23 * 3600, "a"), (1, 86400 + 7 * 3600, "a"), (2, 0, "a"), (2, 1000, "b"), (2, 2000, "a")]
    ev = spark.createDataFrame(rows, "user_id long, t long, cell_id string").selectExpr("*", "cast(null as int) AS plmn", "false AS abroad")
    kept = permanence.without_moves(permanence.enrich(ev, cells, p), p)
    assert kept.where("user_id = 2").count() == 2
    got = permanence.stay_intervals(kept.where("user_id = 1"), p).orderBy("init").collect()
    assert got[0]["end"] == got[1]["init"] == 23 * 3600 + 4 * 3600


def test_logical_days(spark):
    h = lambda x: x * 3600
    df = spark.createDataFrame([(0, h(3)), (0, h(4)), (0, h(23)), (1, 86400 + h(7)), (1, 86400 + h(8))], "day long, slot long").withColumn("dps", F.array(F.lit("g")))
    got = {(r["time_interval"], r["slot"] // 3600): r["logical_day"] for r in permanence.logical_days(df).collect()}
    assert got["all", 3] == -1 and got["all", 4] == 0
    assert got["night_time", 23] == 0 and got["night_time", 31] == 0 and ("night_time", 32) not in got and got["night_time", 3] == -1
    assert got["working_hours", 32] == 1 and ("working_hours", 31) not in got


def test_holidays_are_no_workdays_but_abroad(spark):
    df = spark.createDataFrame([(19723, "grid"), (19723, "abroad"), (19724, "grid"), (19728, "grid")], "logical_day long, id_type string")
    off = spark.sql("SELECT date'2024-01-01' AS date")
    got = {}
    for r in permanence.day_types(df, off).collect():
        got.setdefault((r["logical_day"], r["id_type"]), set()).add(r["day_type"])
    assert got == {(19723, "grid"): {"all", "holidays"}, (19723, "abroad"): {"all", "workdays"}, (19724, "grid"): {"all", "workdays"}, (19728, "grid"): {"all", "weekends"}}


def test_midterm_period_and_missing_dates(spark):
    m = one(spark, permanence.midterm_months("2024-01", "2024-02", 3))
    assert [(x["month"], str(x["first"]), str(x["last"])) for x in m] == [("2024-01", "2023-12-29", "2024-02-03"), ("2024-02", "2024-01-29", "2024-03-03")]
    df = spark.sql("SELECT date'2024-01-01' AS date")
    assert [str(r["date"]) for r in permanence.missing_dates(df, ["2024-01-01", "2024-01-02"]).collect()] == ["2024-01-02"]


def scores(spark, rows):
    return spark.createDataFrame([(u, "all", d, i, t, l, s, f) for u, d, i, t, l, s, f in rows], "user_id long, season string, day_type string, time_interval string, id_type string, location string, lps long, total_frequency long")


def test_labels_cascade_by_device(spark):
    rows = [
        (1, "all", "all", "device_observation", "-1", 100, 10), (1, "all", "night_time", "device_observation", "-1", 50, 10), (1, "all", "all", "grid", "7", 90, 9), (1, "all", "night_time", "grid", "7", 45, 9), (1, "all", "all", "grid", "8", 5, 2),
        (2, "all", "all", "device_observation", "-1", 100, 10), (2, "all", "night_time", "device_observation", "-1", 50, 10), (2, "all", "all", "grid", "7", 75, 8), (2, "all", "night_time", "grid", "7", 45, 9),
        (3, "all", "all", "device_observation", "-1", 1, 1), (3, "all", "all", "grid", "7", 1, 1),
    ]
    got = {(r["user_id"], r["label"]): r["label_rule"] for r in usual_environment.label_tiles(scores(spark, rows)).collect()}
    assert got == {(1, "ue"): "ue_1", (1, "home"): "h_1", (2, "ue"): "ue_1", (2, "home"): "h_2"}
    whole = {(r["user_id"], r["label"]): r["label_rule"] for r in usual_environment.label_tiles(scores(spark, rows), global_stop=True).collect()}
    assert (2, "home") not in whole and whole[1, "home"] == "h_1"


def test_gap_cut_at_the_bound(spark):
    rows = [(1, "all", "all", "grid", str(i), s, 1) for i, s in enumerate([10, 8, 8, 5, 4])]
    cut = lambda g, p: sorted(r["lps"] for r in usual_environment.cut_at_gap(scores(spark, rows), g, p).collect())
    assert cut(3, False) == [8, 8, 10] and cut(2, False) == [10] and cut(4, False) == [4, 5, 8, 8, 10] and cut(30, True) == [8, 8, 10] and cut(31, True) == [4, 5, 8, 8, 10]


def test_migration_overlap_bounds(spark):
    home = lambda rows: spark.createDataFrame(rows, "user_id long, grid_id int")
    a, b = home([(1, 1), (1, 2), (2, 1), (3, 1), (4, 1)]), home([(1, 1), (1, 3), (2, 1), (3, 9), (5, 1)])
    assert {r["user_id"]: r["overlap"] for r in migration.migrating_users(a, b, 0.5).collect()} == {3: 0.0, 4: 0.0, 5: 0.0}
    zones = spark.createDataFrame([(1, "A|A1"), (2, "A|A1"), (3, "A|A2"), (9, "B|B1")], "grid_id int, hierarchical_id string")
    m = migration.migration_matrix(migration.zone_weights(a, zones, [1, 2]), migration.zone_weights(b, zones, [1, 2]), migration.migrating_users(a, b, 0.6))
    assert {(r["level"], r["previous_zone"], r["new_zone"]): r["migration"] for r in m.collect()} == {(1, "A", "B"): 1.0, (2, "A1", "B1"): 1.0, (2, "A1", "A2"): 0.5}


def test_trips_and_month_ends(spark):
    h = 3600
    rows = [(1, "a", 0, 10 * h), (1, "b", 34 * h, 40 * h), (1, "c", 64 * h + 1, 70 * h)]
    df = spark.createDataFrame(rows, "user_id long, time_segment_id string, start_s long, end_s long")
    t = {r["trip_start"]: r for r in tourism.trip_table(tourism.trips(df, 24), 60 * h).collect()}
    assert set(t) == {0, 64 * h + 1} and t[0]["time_segment_ids"] == ["a", "b"] and t[0]["is_trip_finished"] and not t[64 * h + 1]["is_trip_finished"]
    night = lambda s, e: one(spark, tourism.overnight(F.lit(s), F.lit(e)))
    assert night(0, 5 * h) and night(4 * h, 10 * h) and not night(5 * h, 20 * h) and not night(0, 4 * h + 3599) and not night(4 * h, 5 * h)


def test_export_bounds(spark):
    df = spark.createDataFrame([("a", 4.0), ("b", 5.0), ("c", 6.0), (None, 9.0)], "zone_id string, value double")
    assert sorted(r["value"] for r in export.obfuscate(df, ["value"], 5).collect()) == [-1.0, 5.0, 6.0, 9.0]
    assert export.delete_small(df, ["value"], 5).count() == 3
    assert export.select_case(df, {"zone_id": None}).count() == 1
    f = spark.createDataFrame([("a", 2.0), ("b", None)], "iso2 string, factor double")
    got = {r["zone_id"]: r["value"] for r in export.scale_by_country(df, f, ["value"], "factor", 0.5, "zone_id").collect()}
    assert got == {"a": 8.0, "b": 2.5, "c": 3.0, None: 4.5}
    with pytest.raises(ValueError, match="zoning"):
        export.grid_rollup(df, "ABROAD", "value")


def test_warnings_need_history_and_spread(spark):
    rows = [(f"2024-01-{d:02d}", v) for d, v in ((1, 10), (2, 10), (3, 10), (4, 11), (5, 1))]
    df = spark.createDataFrame(rows, "date string, n long").withColumn("date", F.col("date").cast("date"))
    got = [(r["date"].day, r["warning"]) for r in quality.size_warnings(df, "n", 3, 2.0, 2, 100).collect()]
    assert sorted(got) == [(4, "upper_variability"), (5, "lower_limit"), (5, "lower_variability")]


def test_tables_and_jobs(spark, tmp_path):
    root = f"file://{tmp_path}"
    t = schemas.Table("t", "k int, v double, day int", ("day",))
    df = spark.createDataFrame([(1, 1.0, 1), (2, 2.0, 2)], "k long, v float, day long")
    tables.write(df, t, f"{root}/t")
    tables.write(df.where("day = 2").withColumn("v", F.lit(9.0)), t, f"{root}/t", "overwrite")
    assert sorted((r["k"], r["v"]) for r in tables.read(spark, t, f"{root}/t").collect()) == [(1, 1.0), (2, 9.0)]
    assert tables.partition_values(spark, f"{root}/t") == [{"day": "1"}, {"day": "2"}]
    tables.write_csv(df, f"{root}/c", ";")
    assert tables.read_csv(spark, t, f"{root}/c", ";").count() == 2
    df.write.json(f"{root}/j")
    assert tables.read_json(spark, t, f"{root}/j").schema == t.schema and tables.empty(spark, t).count() == 0
    catalog = jobs.Catalog(spark, root, {"t": t})
    double = jobs.Job("double", lambda a: a.withColumn("v", F.col("v") * 2), {"a": "t"}, ["d"])
    total = jobs.Job("total", lambda a, top: a.agg(F.sum("v").alias("v")).where(F.col("v") < top), {"a": "d"}, ["s"], {"top": 100})
    assert [j.name for j in jobs.order([total, double])] == ["double", "total"]
    assert set(jobs.run([total, double], catalog)) == {"double", "total"} and catalog.read("s").first()["v"] == 20.0
    with pytest.raises(jobs.CriticalWarning):
        jobs.run([jobs.Job("stop", lambda a: a, {"a": "t"}, ["x"], stop_if=lambda m: m["x"].count() > 0)], catalog)
    with pytest.raises(ValueError, match="made by"):
        jobs.order([double, jobs.Job("again", lambda a: a, {"a": "t"}, ["d"])])
    assert tables.exists(spark, f"{root}/s") and tables.delete(spark, f"{root}/s") and not tables.exists(spark, f"{root}/s")


def test_geo_files(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    (tmp_path / "z.json").write_text(json.dumps({"features": [{"properties": {"id": "ES3", "level": 1}, "geometry": {"type": "Polygon", "coordinates": [ring]}}]}))
    r = tables.read_geojson(spark, f"file://{tmp_path}/z.json", "id string, level int").first()
    assert r["id"] == "ES3" and [(p["x"], p["y"]) for p in r["ring"]] == [tuple(map(float, p)) for p in ring]
    rows = [(bytearray(struct.pack("<BIdd", 1, 1, x, y)),) for x, y in ((3.25, -1e-3), (0.0, 4e6))]
    got = tables.points_from_wkb(spark.createDataFrame(rows, "geometry binary")).select("x", "y").collect()
    assert sorted(tuple(g) for g in got) == [(0.0, 4e6), (3.25, -1e-3)]


def test_streams(spark, tmp_path):
    rows = [(1, "a", 0), (1, "a", 3600), (1, "a", 3600), (1, "b", 7200), (2, "c", 0), (1, "a", 40 * 3600), (3, "z", 400 * 3600)]
    df = spark.createDataFrame(rows, "user_id long, cell_id string, t long").withColumn("ts", F.timestamp_seconds(F.col("t") + 1_700_000_000))
    for i in (0, 1):
        df.where(F.col("t") <= 7200 if i == 0 else F.col("t") > 7200).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    source = lambda: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
    run = lambda s, n: sessions.run_available(s, f"file://{tmp_path}/{n}", f"file://{tmp_path}/{n}-c").collect()
    trips = {(r["user_id"], r["stays"]) for r in run(sessions.trip_sessions(source()), "trips")}
    assert {(1, 4), (2, 1)} <= trips
    counts = {(r["cell_id"], r["events"]) for r in run(sessions.cell_counts(source()), "counts")}
    assert {("a", 1), ("a", 2), ("b", 1), ("c", 1)} <= counts
    assert len(run(sessions.without_duplicates(source()), "once")) == len(rows) - 1
    dwell = sorted((r["user_id"], r["cell_id"], r["start_s"], r["end_s"], r["events"]) for r in run(sessions.dwell(source()), "dwell"))
    assert dwell == [(1, "a", 0, 3600, 3), (1, "b", 7200, 7200, 1)]
    shutil.rmtree(tmp_path / "in")


def test_scores_are_checked_first(spark):
    from cellscape.operators import permanence

    dps = spark.createDataFrame([(1, 19724, 19724 * 86400 + 3600, "grid", ["g"])], "user_id long, day long, slot long, id_type string, dps array<string>")
    holidays, tiles = spark.createDataFrame([], "date date"), spark.createDataFrame([("g", 5)], "group_id string, grid_id int")
    made = permanence.midterm_scores(dps, holidays, tiles).cache()
    assert made.count() > 0
    with pytest.raises(ValueError, match="don't fit a day"):
        permanence.midterm_scores(dps, holidays, tiles, slot_seconds=7000)
    with pytest.raises(ValueError, match="aren't of slots"):
        permanence.midterm_scores(dps.withColumn("slot", F.col("slot") + 1800), holidays, tiles)
    odd = permanence.MidTermParams(intervals=(("all", 0, 24), ("late", 17, 23)))
    with pytest.raises(ValueError, match="don't fit a day"):
        permanence.midterm_scores(dps.where("false"), holidays, tiles, odd, slot_seconds=7200)
    seasons = spark.createDataFrame([("all", "2024-01"), ("all", "2024-02"), ("spring", "2024-03")], "season string, month string")
    assert permanence.longterm_scores(made, seasons.limit(1)).count() > 0
    with pytest.raises(ValueError, match="2024-02.*2024-03"):
        permanence.longterm_scores(made, seasons)


def test_trips_carried_over_runs_equal_one_run(spark):
    import random

    from cellscape.operators import tourism

    draw, rows = random.Random(7), []
    for user in range(20):
        t = draw.randrange(5 * 86400)
        while t < 60 * 86400:
            end = t + draw.choice([3600, 40_000, 10 * 86400])  # some stays are longer than a run
            rows.append((user, f"s{len(rows)}", t, end))
            t += int(draw.expovariate(1 / draw.choice([20_000, 200_000]))) + 1
    stays = spark.createDataFrame(rows, "user_id long, time_segment_id string, start_s long, end_s long")
    whole = sorted(map(tuple, tourism.trips(stays, 24).select("time_segment_id", "trip_id", "trip_start").collect()))
    got, held = [], None
    for since in range(0, 60, 4):
        run = iterate.cut(tourism.month_trips(stays, since * 86400, (since + 4) * 86400, 24, held))
        got += run.where("not open").select("time_segment_id", "trip_id", "trip_start").collect()
        held = run.where("open")
        assert run.where(f"not open and end_s + 86400 >= {(since + 4) * 86400}").count() == 0
    got += held.select("time_segment_id", "trip_id", "trip_start").collect()
    assert sorted(map(tuple, got)) == whole and len({x[1] for x in whole}) > 40


def test_month_bounds():
    from cellscape.operators import tourism

    assert tourism.month_bounds("2023-12", "2024-02") == [("2023-12", 1701388800, 1704067200), ("2024-01", 1704067200, 1706745600), ("2024-02", 1706745600, 1709251200)]
    with pytest.raises(ValueError):
        tourism.month_bounds("2024-02", "2024-01")


def test_points_settle_by_themselves(spark):
    from cellscape.operators import population

    devices = spark.createDataFrame([("p", "a", 10), ("p", "b", 1), ("q", "a", 4)], "time_point string, cell_id string, device_count long")
    prob = spark.createDataFrame([("a", 1, 0.5), ("a", 2, 0.5), ("b", 2, 0.5), ("b", 3, 1.0), ("c", 4, 1.0), ("a", 5, 0.0)], "cell_id string, grid_id int, cell_connection_probability double")
    tiles = spark.range(1, 11).selectExpr("cast(id AS int) AS grid_id")

    def by_hand(counts, tolerance, most):
        u = {g: sum(counts.values()) / 10 for g in (1, 2, 3, 4)}
        p = {"a": {1: 0.5, 2: 0.5}, "b": {2: 0.5, 3: 1.0}}
        for _ in range(most):
            new = {}
            for c, n in counts.items():
                total = sum(u[g] * x for g, x in p[c].items())
                for g, x in p[c].items():
                    new[g] = new.get(g, 0) + n * u[g] * x / total
            change = sum(abs(new[g] - u[g]) for g in new)
            u = {**u, **new}
            if change < tolerance:
                break
        return new

    got = {(r["time_point"], r["grid_id"]): r["population"] for r in population.present_population(devices, prob, tiles, 30, 0.3).collect()}
    want = {(t, g): v for t, counts in (("p", {"a": 10, "b": 1}), ("q", {"a": 4})) for g, v in by_hand(counts, 0.3, 30).items()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(v) for k, v in want.items())


def test_labels_of_coarse_tiles_are_dealt_out(spark):
    from cellscape.operators import usual_environment

    labels = spark.createDataFrame([(1, "all", str((4 << 16) + 6), "home", "h_1", "x")], "user_id long, season string, location string, label string, label_rule string, extra string")
    got = usual_environment.at_base_tiles(labels)
    assert got.columns == labels.columns
    assert sorted(int(r["location"]) for r in got.collect()) == [(4 << 16) + 6, (4 << 16) + 7, (5 << 16) + 6, (5 << 16) + 7]


def test_geojson_lines_with_holes(spark, tmp_path):
    from cellscape.sources import tables

    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 0.0)]
    df = spark.createDataFrame([("a", 1, square, [square[::-1]]), ("b", None, square, [])], "name string, n int, ring array<struct<x:double,y:double>>, holes array<array<struct<x:double,y:double>>>")
    tables.write_geojson(df, str(tmp_path / "f"))
    assert sorted(map(str, tables.read_geojson(spark, str(tmp_path / "f"), "name string, n int", lines=True).collect())) == sorted(map(str, df.collect()))


def test_dwell_runs_over_parts(spark, tmp_path):
    """A user's rows of one batch come in parts that are in no order."""
    hours = [8, 1, 9, 0, 4, 2, 10, 5, 11, 3, 7, 6]
    rows = [(1, "a" if h < 5 else "b" if h < 9 else "c", h * 3600) for h in hours]
    spark.createDataFrame(rows, "user_id long, cell_id string, t long").coalesce(1).write.parquet(f"file://{tmp_path}/in")
    source = spark.readStream.schema("user_id long, cell_id string, t long").parquet(f"file://{tmp_path}/in")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        got = sessions.run_available(sessions.dwell(source), f"file://{tmp_path}/out", f"file://{tmp_path}/state").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r["cell_id"], r["start_s"], r["end_s"], r["events"]) for r in got) == [("a", 0, 4 * 3600, 5), ("b", 5 * 3600, 8 * 3600, 4)]


def test_a_gap_of_the_whole_length_ends_a_trip(spark, tmp_path):
    rows = [(1, 0), (1, 21599), (1, 21599 + 21600), (2, 40 * 86400)]
    df = spark.createDataFrame(rows, "user_id long, t long").select("user_id", F.timestamp_seconds(F.col("t") + 1_700_000_000).alias("ts"))
    df.coalesce(1).write.parquet(f"file://{tmp_path}/in")
    trips = sessions.trip_sessions(spark.readStream.schema(df.schema).parquet(f"file://{tmp_path}/in"), "6 hours")
    got = sessions.run_available(trips, f"file://{tmp_path}/out", f"file://{tmp_path}/state").select("stays", F.unix_micros("trip_end").alias("end")).collect()
    assert sorted((r["stays"], r["end"] / 1e6 - 1_700_000_000) for r in got) == [(1, 21599 + 2 * 21600), (2, 21599 + 21600)]


def test_points_that_go_on_together(spark):
    """A point that would have settled alone goes on while another changes; a step's change counts the tiles that nothing connects."""
    devices = spark.createDataFrame([("p", "A", 6), ("p", "B", 400), ("q", "A", 1)], "time_point string, cell_id string, device_count long")
    prob = spark.createDataFrame([("A", 1, 1.0), ("A", 2, 0.5), ("B", 2, 0.5)], "cell_id string, grid_id int, cell_connection_probability double")
    tiles = spark.createDataFrame([(1,), (2,), (3,)], "grid_id int")
    get = lambda df: {(r["time_point"], r["grid_id"]): r["population"] for r in df.collect()}
    together = get(population.converged_together(devices, prob, tiles, 20, 0.5))
    n = next(i for i in range(1, 21) if together == pytest.approx(get(population.fixed_iterations(devices, prob, tiles, i)), rel=1e-12))
    alone = get(population.present_population(devices, prob, tiles, 20, 0.5))
    assert n > 1 and alone["q", 1] != pytest.approx(together["q", 1], rel=1e-9)
    assert get(population.converged_together(devices, prob, tiles, 1, 0.5)) == pytest.approx(get(population.fixed_iterations(devices, prob, tiles, 1)))


def test_k_anonymity_takes_all_customers(spark, tmp_path):
    """Customers whose keys are beyond a hundred thousand count like others."""
    from cellscape import queries

    for t in ("nation", "region", "customer"):
        df = spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
        (df.withColumn("c_custkey", F.col("c_custkey") + 900_000) if t == "customer" else df).write.parquet(f"file://{tmp_path}/{t}.parquet")
    assert queries.queries()["k_anon_delete"](spark, f"file://{tmp_path}").count() > 0


@pytest.mark.parametrize("name", ["footprint_dominance", "footprint_topn", "footprint_pct_best", "footprint_groups", "group_members", "connection_probability", "hull_stays"])
def test_growing_sides_are_not_broadcast(spark, name):
    """Tables of cells and tiles never go through the driver, however small their files."""
    from cellscape import queries

    plan = queries.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Broadcast" not in plan


def test_labels_do_not_broadcast_devices(spark):
    """What has a row for each device, or more, is shuffled to labels, however small its file."""
    from cellscape.operators import usual_environment

    row = lambda kind, loc, n: (1, "all", "all", "all", kind, loc, n, n)
    scores = spark.createDataFrame([row("grid", "5", 9), row("device_observation", "-1", 10)], "user_id long, season string, day_type string, time_interval string, id_type string, location string, lps long, total_frequency long")
    labels = usual_environment.label_tiles(scores, cascades=[[usual_environment.Rule(code, "all", "all", "lps", 70)] for code in ("u", "h", "w")])
    assert "Broadcast" not in labels._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["label"] for r in labels.collect()) == ["home", "ue", "work"]


def test_free_slots_are_neither_joined_nor_shuffled(spark):
    """A day's slots are made after all joins, from one row of it; scores of one, several, foreign and unknown cells."""
    p = permanence.DailyParams(slots=24)
    rows = [(1, "a", False, 0, 3600), (1, "a", False, 3600, 5700), (1, "b", False, 5700, 7200), (1, "208", True, 7200, 9900), (1, "b", False, 9900, 10800), (1, "z", False, 10800, 14400), (1, "a", False, 86400, 90000)]
    stays = spark.createDataFrame(rows, "user_id long, cell_id string, abroad boolean, init long, end long")
    slots = permanence.slot_durations(stays, spark.createDataFrame([(1, 0)], "user_id long, day long"), p)
    lines = slots._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    made = [i for i, line in enumerate(lines) if "Generate" in line and "86400" in line]
    assert made
    for i in made:
        low = depth(lines[i])
        for line in reversed(lines[:i]):
            if depth(line) < low:
                low = depth(line)
                assert "Join" not in line
    assert slots.count() == 26 and slots.where("cell_id = '-99'").count() == 20
    groups = spark.createDataFrame([("a", "g"), ("a", "h"), ("b", "h"), ("b", "i")], "cell_id string, group_id string")
    got = {(r["slot"], r["id_type"]): r["dps"] for r in permanence.daily_scores(slots, groups, p).where("slot < 14400").collect()}
    assert got == {(0, "grid"): ["g", "h"], (3600, "grid"): ["g", "h"], (7200, "abroad"): ["208"]}


def test_slots_that_are_unknown_in_part(spark):
    rows = [(1, 0, 0, "-99", 3600), (1, 0, 3600, "-99", 2000), (1, 0, 3600, "a", 1600), (1, 0, 7200, "-99", 1000), (1, 0, 7200, "a", 2600), (2, 0, 0, "a", 3600)]
    df = spark.createDataFrame(rows, "user_id long, day long, slot long, cell_id string, seconds long")
    r = quality.unknown_share(df, 60.0).first()
    assert (r["devices"], r["mostly_unknown"], r["percent"]) == (2, 1, 50.0)
    plan = quality.unknown_share(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan  # what is unknown whole isn't grouped by slot


def test_longterm_scores_without_those_of_months(spark):
    """Equal to the long-term scores of stored mid-term scores, also where a tile is in two groups, and no tile's row is shuffled."""
    import random

    from cellscape.operators import permanence
    from cellscape.plans import iterate

    r = random.Random(16)
    kinds = [("grid", ["g"]), ("grid", ["g", "h"]), ("grid", ["none"]), ("abroad", ["208"]), ("unknown", ["-99"])]
    picked = [(u, 19720 + d, (19720 + d) * 86400 + h * 3600, *k) for u in range(3) for d in range(45) for h in range(24) for k in kinds if r.random() < 0.06]
    dps = iterate.cut(spark.createDataFrame(picked, "user_id long, day long, slot long, id_type string, dps array<string>"))
    holidays = spark.sql("SELECT explode(array(date'2024-01-01', date'2024-01-06')) AS date")
    tiles = iterate.cut(spark.createDataFrame([("g", 5), ("g", 6), ("h", 6), ("h", 7)], "group_id string, grid_id int"))
    seasons = spark.createDataFrame([("all", "2023-12"), ("all", "2024-01"), ("all", "2024-02"), ("winter", "2024-01")], "season string, month string")
    names = ["user_id", "season", "day_type", "time_interval", "id_type", "location", "lps", "total_frequency", F.round("frequency_mean", 9), F.round("frequency_std", 9)]
    made = permanence.longterm_of_days(dps, holidays, tiles, seasons)
    stored = permanence.longterm_scores(permanence.midterm_scores(dps, holidays, tiles), seasons)
    key = lambda row: tuple(map(str, row))
    rows = sorted(map(tuple, made.select(*names).collect()), key=key)
    assert rows == sorted(map(tuple, stored.select(*names).collect()), key=key) and len(rows) > 300
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and ("location" in line or "place" in line)]
    with pytest.raises(ValueError, match="2024-05"):
        permanence.longterm_of_days(dps, holidays, tiles, seasons.unionByName(spark.createDataFrame([("x", "2024-05")], "season string, month string")))


def test_metrics_make_only_the_scores_they_read(spark, monkeypatch):
    from cellscape.queries import environment

    asked = []
    made = environment._longterm
    monkeypatch.setattr(environment, "_longterm", lambda spark, sf, *params: asked.append(params) or made(spark, sf, *params))
    assert environment.usual_environment_metrics(spark, "/root/testdata/sf0.001").count() > 0
    assert [(p[0].day_types, [i[0] for i in p[0].intervals]) for p in asked] == [(("all",), ["all", "night_time"])]


def test_few_bytes_of_much_work_are_dealt_over_all_tasks(spark):
    from cellscape.operators import areas, segments, tourism

    stays = spark.createDataFrame([(1, 0, 5)], "user_id long, start_s long, end_s long")
    tiles = spark.createDataFrame([(1, 50.0, 50.0)], "grid_id int, tile_x double, tile_y double")
    shapes = spark.createDataFrame([([(0.0, 0.0), (90.0, 0.0), (0.0, 90.0)],)], "ring array<struct<x:double,y:double>>")
    ev = spark.createDataFrame([(1, 3600, "a", None, "domestic")], "user_id long, s long, cell_id string, plmn int, domain string").withColumn("timestamp", F.timestamp_seconds("s"))
    near = spark.createDataFrame([("a", ["b"])], "cell_id string, overlapping_cell_ids array<string>")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for made in (tourism.trips(stays, 24), areas.tile_pieces(tiles, shapes, 500.0), segments.time_segments(ev, near, 0)):
        assert made.rdd.getNumPartitions() == n and made.count() > 0
