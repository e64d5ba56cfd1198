"""Coverage and present population."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import coverage, export, population
from ..sources import demo
from .views import CONN, CONN_GROUND, EV, FOOT_GROUND, ZONES


def _cells(spark, sf):
    return coverage.place_cells(coverage.impute_defaults(demo.antennas(spark, sf)), use_elevation=True)


def _tiles(spark, sf):
    return coverage.place_tiles(demo.ground(spark, sf), use_elevation=True)


def _footprint(spark, sf):
    return coverage.dominance(coverage.tiles_in_range(_cells(spark, sf), _tiles(spark, sf).drop("k"), coverage.Params(bin_size=250.0)))


def _lattice_connection(spark):
    """Of the hundred cells that the events name."""
    fp = coverage.dominance(coverage.tiles_in_range(coverage.impute_defaults(demo.cells(spark)), demo.lattice(spark).drop("k"), coverage.Params(bin_size=250.0)))
    return coverage.posterior_probability(coverage.connection_probability(fp))


def cell_heights(spark, sf):
    """Heights of cells and of tiles, each over the ground and without it."""
    cells = [coverage.place_cells(coverage.impute_defaults(demo.antennas(spark, sf)), up).select(F.lit("cell").alias("kind"), F.col("cell_id").alias("name"), F.lit(up).alias("over_ground"), F.col("cell_z").alias("z")) for up in (True, False)]
    tiles = [coverage.place_tiles(demo.ground(spark, sf), up).select(F.lit("tile").alias("kind"), F.col("grid_id").cast("string").alias("name"), F.lit(up).alias("over_ground"), F.col("tile_z").alias("z")) for up in (True, False)]
    return functools.reduce(DataFrame.unionByName, cells + tiles)


def cell_defaults(spark, sf):
    return _cells(spark, sf).select("cell_id", "power", "path_loss_exponent", "horizontal_beam_width", F.round(coverage.watt_to_dbm(F.col("power")), 6).alias("dbm"))


def footprint_dominance(spark, sf):
    return _footprint(spark, sf).select("cell_id", "grid_id", F.round("distance", 6).alias("distance"), F.round("signal_strength", 6).alias("signal_strength"), F.round("signal_dominance", 9).alias("signal_dominance"))


def footprint_topn(spark, sf):
    p = coverage.Params(cells_per_tile=3, min_dominance=0.05)
    return coverage.prune_top(coverage.prune_small(_footprint(spark, sf), p), p).select("cell_id", "grid_id")


def footprint_pct_best(spark, sf):
    return coverage.prune_share_of_best(_footprint(spark, sf), coverage.Params(best_percent=70.0)).select("cell_id", "grid_id")


def _groups(spark, sf):
    return coverage.footprint_groups(coverage.prune_share_of_best(_footprint(spark, sf), coverage.Params(best_percent=95.0)))


def footprint_groups(spark, sf):
    return _groups(spark, sf).select("group_id", F.array_join("cells", ",").alias("cells"), F.array_join("grid_ids", ",").alias("grid_ids"))


def group_tiles(spark, sf):
    """The incremental step: groups known so far are those whose id ends in a letter."""
    g = _groups(spark, sf)
    return coverage.group_tiles(g, g.where("group_id rlike '[a-f]$'")).withColumn("kind", F.lit("tile")).select("group_id", "kind", F.col("grid_id").cast("string").alias("member")).unionByName(
        coverage.cell_groups(g).select("group_id", F.lit("cell").alias("kind"), F.col("cell_id").alias("member"))
    )


_GRP = FOOT_GROUND + """, pb AS (SELECT * FROM (SELECT *, max(sd) OVER (PARTITION BY grid_id) AS best FROM sd) WHERE sd * 100 >= best * 95.0),
gs AS (SELECT grid_id, string_agg(cell_id, ',' ORDER BY cell_id) AS cells FROM pb GROUP BY grid_id), gg AS (SELECT cells, string_agg(cast(grid_id AS VARCHAR), ',' ORDER BY grid_id) AS grid_ids FROM gs GROUP BY cells), gr AS (SELECT md5(grid_ids) AS group_id, cells, grid_ids FROM gg)"""


def _pairs(spark, sf):
    fp = coverage.prune_share_of_best(_footprint(spark, sf), coverage.Params(best_percent=95.0))
    return coverage.nearby_hulls(coverage.cell_hulls(fp, _tiles(spark, sf)), 200.0, 25.0)


def cell_distance(spark, sf):
    return coverage.cell_distances(_pairs(spark, sf)).select("cell_id_a", "cell_id_b", F.round("distance", 6).alias("distance"))


def cell_overlap_groups(spark, sf):
    return coverage.overlap_groups(_pairs(spark, sf), 0.0).select("cell_id", F.array_join("overlapping_cell_ids", ",").alias("overlapping"))


#: Distance of hulls without hulls: the widest gap between two sets of points, over the normals of all their segments and the lines between them.
_PAIR = _GRP + """, pp AS (SELECT cell_id, x, y FROM pb JOIN tl USING (grid_id)), pl AS (SELECT cell_id, list({x: x, y: y}) AS ps, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM pp GROUP BY cell_id),
ca AS (SELECT a.cell_id AS a, b.cell_id AS b, a.ps AS pa, b.ps AS pb FROM pl a JOIN pl b ON a.cell_id < b.cell_id AND a.x0 - 250 <= b.x1 AND b.x0 <= a.x1 + 250 AND a.y0 - 250 <= b.y1 AND b.y0 <= a.y1 + 250),
di AS (SELECT a, b, q.y - p.y AS dx, p.x - q.x AS dy FROM (SELECT a, b, pa, unnest(pa) AS p FROM ca), unnest(pa) r(q) UNION SELECT a, b, q.y - p.y, p.x - q.x FROM (SELECT a, b, pb, unnest(pb) AS p FROM ca), unnest(pb) r(q) UNION SELECT a, b, q.x - p.x, q.y - p.y FROM (SELECT a, b, pb, unnest(pa) AS p FROM ca), unnest(pb) r(q)),
ga AS (SELECT a, b, greatest(list_min(list_transform(pb, lambda p: p.x * dx + p.y * dy)) - list_max(list_transform(pa, lambda p: p.x * dx + p.y * dy)), list_min(list_transform(pa, lambda p: p.x * dx + p.y * dy)) - list_max(list_transform(pb, lambda p: p.x * dx + p.y * dy))) / sqrt(dx * dx + dy * dy) AS gap FROM di JOIN ca USING (a, b) WHERE dx <> 0 OR dy <> 0),
hd AS (SELECT a, b, greatest(0, coalesce(max(gap), 0) - 50) AS distance FROM ca LEFT JOIN ga USING (a, b) GROUP BY a, b),
pr AS (SELECT a AS cell_id_a, b AS cell_id_b, distance FROM hd WHERE distance <= 200 UNION ALL SELECT b, a, distance FROM hd WHERE distance <= 200)"""


def _connection(spark, sf):
    return coverage.posterior_probability(coverage.connection_probability(_footprint(spark, sf)))


def connection_probability(spark, sf):
    return _connection(spark, sf).select("cell_id", "grid_id", F.round("cell_connection_probability", 9).alias("p"), F.round("posterior_probability", 9).alias("posterior"))


def angular_model(spark, sf):
    """Dominance with azimuth and elevation losses, and each cell's effective coverage."""
    cells = _cells(spark, sf)
    table = coverage.beam_table(spark, [-30.0])
    cells = coverage.with_beam_sd(coverage.with_beam_sd(cells, table, "horizontal_beam_width", "azimuth_back_loss", "sd_azimuth"), table, "vertical_beam_width", "elevation_back_loss", "sd_elevation")
    pairs = coverage.dominance(coverage.tiles_in_range(cells, _tiles(spark, sf).drop("k"), coverage.Params(bin_size=250.0)), azimuth=True, elevation=True)
    total = pairs.groupBy("cell_id").agg(F.sum("signal_dominance").alias("total_dominance"))
    return coverage.effective_coverage(pairs).join(total, "cell_id").select("cell_id", *[F.round(c, 6).alias(c) for c in ("centre_x", "centre_y", "effective_range", "total_dominance")])


def _loss(angle: str, sd: str) -> str:
    """dB at an angle off the main direction, with a back loss of -30."""
    turned = f"(({angle} + 180) - 360 * floor(({angle} + 180) / 360) - 180)"
    return f"(exp(-0.5 * power({turned} / {sd}, 2)) - 1) * 30 / (1 - exp(-0.5 * power(180 / {sd}, 2)))"


_ANGULAR = (
    FOOT_GROUND
    + f""", ag AS (SELECT i * (180.0::DOUBLE / 719) AS a FROM range(720) r(i)), sg AS (SELECT i * 180.0::DOUBLE / 1000 AS sd FROM range(1, 1000) r(i)),
th AS (SELECT sd, arg_min(a, struct_pack(d := abs(-3 - {_loss('a', 'sd')}), a := a)) AS three FROM sg, ag GROUP BY sd),
be AS (SELECT deg, arg_min(sd, struct_pack(d := abs(three - deg), sd := sd)) AS sd FROM th, (VALUES (4), (32)) v(deg) GROUP BY deg),
pa AS (SELECT f.*, c.x AS cx, c.y AS cy, c.z - t.z AS cz, t.x AS tx, t.y AS ty, c.k % 2 AS dir, cast(c.k * 37 % 360 AS DOUBLE) AS az, (SELECT sd FROM be WHERE deg = 32) AS sa, (SELECT sd FROM be WHERE deg = 4) AS se
  FROM ft f JOIN ci c USING (cell_id) JOIN tl t USING (grid_id)),
tu AS (SELECT *, radians(degrees(atan2(tx - cx, ty - cy)) - az) AS tn FROM pa),
an AS (SELECT *, degrees(atan2(sin(tn) * distance, cos(tn) * distance * cos(radians(5)) + cz * sin(radians(5)))) AS side, degrees(atan2(cz, distance)) - 5 AS down FROM tu),
ad AS (SELECT *, 1 / (1 + exp(-(s + CASE WHEN dir = 1 THEN {_loss('side', 'sa')} + {_loss('down', 'se')} ELSE 0 END + 92.5) * 0.2)) AS dom, radians(CASE WHEN dir = 1 THEN az ELSE 90 END) AS ra FROM an),
li AS (SELECT *, (tx - cx) * sin(ra) + (ty - cy) * cos(ra) AS along, abs((tx - cx) * cos(ra) - (ty - cy) * sin(ra)) AS across FROM ad),
ln AS (SELECT *, CASE WHEN along >= 0 OR dir = 0 THEN 'front' ELSE 'back' END AS fb FROM li WHERE across <= 50 AND (dir = 1 OR along >= 0)),
pt AS (SELECT cell_id, dir, cx, cy, fb, coalesce(arg_max(struct_pack(x := tx, y := ty), struct_pack(d := distance, g := -grid_id)) FILTER (dom > 0.01), arg_min(struct_pack(x := tx, y := ty), struct_pack(d := distance, g := grid_id))) AS p FROM ln GROUP BY ALL),
en AS (SELECT cell_id, dir, cx, cy, max(CASE WHEN fb = 'front' THEN p END) AS f, max(CASE WHEN fb = 'back' THEN p END) AS b FROM pt GROUP BY ALL),
ce AS (SELECT cell_id, f, CASE WHEN dir = 0 THEN cx ELSE (f.x + coalesce(b.x, cx)) / 2 END AS x, CASE WHEN dir = 0 THEN cy ELSE (f.y + coalesce(b.y, cy)) / 2 END AS y FROM en WHERE f IS NOT NULL)"""
)
ANGULAR_SQL = f"WITH {_ANGULAR} SELECT cell_id, round(x, 6) AS centre_x, round(y, 6) AS centre_y, round(sqrt(power(x - f.x, 2) + power(y - f.y, 2)), 6) AS effective_range, round(total, 6) AS total_dominance FROM ce JOIN (SELECT cell_id, sum(dom) AS total FROM ad GROUP BY cell_id) USING (cell_id)"


def _points(spark):
    return population.time_points(spark, "2024-01-02 00:00:00", "2024-01-06 12:00:00", 43200)


def _devices(spark, sf):
    return population.devices_per_cell(demo.events(spark, sf), _points(spark), 21600)


def devices_per_cell(spark, sf):
    return _devices(spark, sf).select(F.unix_timestamp("time_point").alias("time_point"), "cell_id", "device_count")


_DEV = EV + """, tp AS (SELECT epoch_ms(ms)::TIMESTAMP AS time_point, ms // 1000 AS p FROM (SELECT 1704153600000 + i * 43200000 AS ms FROM range(10) r(i))),
nr AS (SELECT p, user_id, cell_id, row_number() OVER (PARTITION BY p, user_id ORDER BY abs(t - p), t, cell_id) AS rn FROM tp JOIN ev ON abs(t - p) <= 21600), dv AS (SELECT p, cell_id, count(*) AS n FROM nr WHERE rn = 1 GROUP BY p, cell_id)"""


def _population_sql(steps: int) -> str:
    out = _DEV + ", " + CONN + ", u0 AS (SELECT p, grid_id, n / 100.0::DOUBLE AS u FROM (SELECT p, sum(n) AS n FROM dv GROUP BY p), tl)"
    for i in range(steps):
        out += f", w{i} AS (SELECT u.p, c.cell_id, c.grid_id, u.u * c.p AS w FROM u{i} u JOIN cp c USING (grid_id)), s{i} AS (SELECT p, cell_id, sum(w) AS s FROM w{i} GROUP BY p, cell_id), u{i + 1} AS (SELECT w.p, w.grid_id, sum(d.n * w.w / s.s) AS u FROM w{i} w JOIN s{i} s USING (p, cell_id) JOIN dv d USING (p, cell_id) GROUP BY w.p, w.grid_id)"
    return out


def _population(spark, sf):
    return population.fixed_iterations(_devices(spark, sf), _lattice_connection(spark), demo.lattice(spark), 3)


def present_population(spark, sf):
    return _population(spark, sf).select(F.unix_timestamp("time_point").alias("time_point"), "grid_id", F.round("population", 6).alias("population"))


def present_population_dated(spark, sf):
    """Events only of the dates that the points touch, and the probabilities of one network day out of two."""
    start, end = "2024-01-02 00:00:00", "2024-01-06 12:00:00"
    days = _lattice_connection(spark).withColumn("date", F.explode(F.array(F.lit("2024-01-02").cast("date"), F.lit("2024-01-03").cast("date"))))
    days = days.withColumn("cell_connection_probability", F.when(F.dayofmonth("date") == 2, F.col("cell_connection_probability")).otherwise(0.5))
    events = demo.events(spark, sf).where(population.dates_near(F.col("timestamp"), start, end, 21600))
    devices = population.devices_per_cell(events, _points(spark), 21600)
    out = population.fixed_iterations(devices, population.at_date(days, "2024-01-02"), demo.lattice(spark), 2)
    return out.select(F.unix_timestamp("time_point").alias("time_point"), "grid_id", F.round("population", 6).alias("population"))


def present_population_converged(spark, sf):
    """Iterated until the change is small, eight times at most."""
    out = population.converged_together(_devices(spark, sf), _lattice_connection(spark), demo.lattice(spark), 8, 1.0)
    return out.select(F.unix_timestamp("time_point").alias("time_point"), "grid_id", F.round("population", 4).alias("population"))


def _converged_sql(steps: int, tolerance: float) -> str:
    """The first step whose change is below the tolerance, or the last."""
    out = _population_sql(steps)
    for i in range(1, steps + 1):
        out += f", d{i} AS (SELECT sum(abs(coalesce(a.u, 0) - coalesce(b.u, 0))) AS d FROM u{i} a FULL JOIN u{i - 1} b USING (p, grid_id))"
    out += ", st AS (SELECT coalesce(min(i), " + str(steps) + ") AS i FROM (" + " UNION ALL ".join(f"SELECT {i} AS i, d FROM d{i}" for i in range(1, steps + 1)) + f") WHERE d < {tolerance} OR d IS NULL)"
    return out + ", fi AS (" + " UNION ALL ".join(f"SELECT {i} AS i, p, grid_id, u FROM u{i}" for i in range(1, steps + 1)) + ")"


def present_population_zone(spark, sf):
    rolled = export.hierarchy_rollup(_population(spark, sf), demo.zones(spark, sf), [1, 2], "population", ["time_point"])
    scaled = export.scale(export.scale(rolled, ["population"], 0.95), ["population"], 5.4)
    return export.obfuscate(scaled, ["population"], 15).select(F.unix_timestamp("time_point").alias("time_point"), "level", "zone_id", F.round("population", 6).alias("population"))


_ZONED = "SELECT p AS time_point, l AS level, split_part(hid, '|', l) AS zone_id, sum(u) * 0.95::DOUBLE * 5.4::DOUBLE AS v FROM u3 JOIN zn USING (grid_id), (VALUES (1), (2)) q(l) GROUP BY ALL"
QUERIES = {
    "cell_heights": (cell_heights, f"WITH {FOOT_GROUND} SELECT 'cell' AS kind, cell_id AS name, u AS over_ground, CASE WHEN u THEN z ELSE cast(30 + k % 20 AS DOUBLE) END AS z FROM cl, (VALUES (true), (false)) v(u) UNION ALL SELECT 'tile', cast(grid_id AS VARCHAR), u, CASE WHEN u THEN z ELSE 0 END FROM tl, (VALUES (true), (false)) v(u)"),
    "cell_defaults": (cell_defaults, f"WITH {FOOT_GROUND} SELECT cell_id, power, ple AS path_loss_exponent, 65.0::DOUBLE AS horizontal_beam_width, round(10 * log10(power) + 30, 6) AS dbm FROM ci"),
    "footprint_dominance": (footprint_dominance, f"WITH {FOOT_GROUND} SELECT cell_id, grid_id, round(distance, 6) AS distance, round(s, 6) AS signal_strength, round(sd, 9) AS signal_dominance FROM sd"),
    "footprint_topn": (footprint_topn, f"WITH {FOOT_GROUND} SELECT cell_id, grid_id FROM (SELECT *, row_number() OVER (PARTITION BY grid_id ORDER BY sd DESC, cell_id) AS rn FROM sd WHERE sd > 0.05) WHERE rn <= 3"),
    "footprint_pct_best": (footprint_pct_best, f"WITH {FOOT_GROUND} SELECT cell_id, grid_id FROM (SELECT *, max(sd) OVER (PARTITION BY grid_id) AS best FROM sd) WHERE sd * 100 >= best * 70.0"),
    "footprint_groups": (footprint_groups, f"WITH {_GRP} SELECT group_id, cells, grid_ids FROM gr"),
    "group_members": (group_tiles, f"WITH {_GRP} SELECT group_id, 'tile' AS kind, unnest(string_split(grid_ids, ',')) AS member FROM gr WHERE NOT regexp_matches(group_id, '[a-f]$') UNION ALL SELECT DISTINCT group_id, 'cell', unnest(string_split(cells, ',')) FROM gr"),
    "cell_distance": (cell_distance, f"WITH {_PAIR} SELECT cell_id_a, cell_id_b, round(distance, 6) AS distance FROM pr"),
    "cell_overlap_groups": (cell_overlap_groups, f"WITH {_PAIR} SELECT c.cell_id, coalesce(string_agg(cell_id_b, ',' ORDER BY cell_id_b), '') AS overlapping FROM (SELECT DISTINCT cell_id FROM pb) c LEFT JOIN pr ON cell_id_a = c.cell_id AND distance <= 0 GROUP BY c.cell_id"),
    "connection_probability": (connection_probability, f"WITH {CONN_GROUND} SELECT cell_id, grid_id, round(p, 9) AS p, round(post, 9) AS posterior FROM po"),
    "angular_model": (angular_model, ANGULAR_SQL),
    "devices_per_cell": (devices_per_cell, f"WITH {_DEV} SELECT p AS time_point, cell_id, n AS device_count FROM dv"),
    "present_population": (present_population, f"WITH {_population_sql(3)} SELECT p AS time_point, grid_id, round(u, 6) AS population FROM u3"),
    "present_population_dated": (present_population_dated, f"WITH {_population_sql(2)} SELECT p AS time_point, grid_id, round(u, 6) AS population FROM u2"),
    "present_population_converged": (present_population_converged, f"WITH {_converged_sql(8, 1.0)} SELECT p AS time_point, grid_id, round(u, 4) AS population FROM fi JOIN st USING (i)"),
    "present_population_zone": (present_population_zone, f"WITH {_population_sql(3)}, {ZONES}, r AS ({_ZONED}) SELECT time_point, level, zone_id, round(CASE WHEN v < 15 THEN -1.0 ELSE v END, 6) AS population FROM r"),
}
