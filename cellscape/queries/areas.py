"""Polygons, lines and outlines over tiles from tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, grid, polygons
from ..operators import areas, coverage, zoning
from ..plans.iterate import shared_path
from ..sources import demo, tables, wkb
from .coverage import _footprint
from .views import CONN_GROUND, GROUND, _strewn

ORIGIN = (3_999_000, 2_999_000)
WEIGHTS = {"residential": 1.0, "forest": 0.1, "open_area": 0.2}
WIDTHS = {"residential": 60.0, "forest": 145.0, "unknown": 0.0}
_DART = ((0.0, 0.0), (3.0, 0.6), (1.2, 1.1), (0.8, 2.9))
_HOLE = ((0.7, 0.55), (1.1, 0.75), (0.85, 1.0))


def _shapes(spark, sf):
    """A dart for each supplier, of three sizes of side and three categories; every fourth has a hole."""
    s = F.col("s_suppkey").cast("long")
    e, n = demo._strewn(s * 15)
    x, y, u = demo.ORIGIN[0] + F.col("e") * 100 + 3.5, demo.ORIGIN[1] + F.col("n") * 100 + 7.25, 40.0 + F.col("s") % 5 * 35
    ring = lambda points: F.array(*[polygons.point(x + u * a, y + u * b) for a, b in points])
    name = F.element_at(F.array(F.lit("residential"), F.lit("forest"), F.lit("water")), (F.col("s") % 3 + 1).cast("int"))
    return demo.load(spark, sf, "supplier").select(s.alias("s"), e.alias("e"), n.alias("n")).select(
        "s", name.alias("category"), (F.col("s") % 3).cast("int").alias("priority"), ring(_DART).alias("ring"), F.when(F.col("s") % 4 == 0, F.array(ring(_HOLE))).otherwise(F.array().cast(areas.RINGS)).alias("holes")
    )


def _edges_sql() -> str:
    """Sides in metres from the lattice's corner; holes turn the other way."""
    sides = lambda points: [(*a, *b) for a, b in zip(points, points[1:] + points[:1])]
    rows = [(*s, "true") for s in sides(_DART)] + [(*s, "s % 4 = 0") for s in sides(_HOLE[::-1])]
    union = " UNION ALL ".join(f"SELECT s, category, u, x, y, x + u * {a} AS ax, y + u * {b} AS ay, x + u * {c} AS bx, y + u * {d} AS by_ FROM su WHERE {when}" for a, b, c, d, when in rows)
    return f"""su AS (SELECT s_suppkey AS s, CASE s_suppkey % 3 WHEN 0 THEN 'residential' WHEN 1 THEN 'forest' ELSE 'water' END AS category, 40.0::DOUBLE + s_suppkey % 5 * 35 AS u, {_strewn('s_suppkey * 15', 0)} * 100 + 3.5::DOUBLE AS x, {_strewn('s_suppkey * 15', 1)} * 100 + 7.25::DOUBLE AS y FROM supplier),
ed AS ({union})"""


def _landuse(spark, sf):
    tiles = demo.ground(spark, sf)
    return zoning.ratio_map(tiles, areas.landuse_areas(tiles, _shapes(spark, sf), 500.0))


def landuse_polygons(spark, sf):
    """Shares of land use by polygons with holes, a row for each category of a tile."""
    out = _landuse(spark, sf).select("grid_id", "main_landuse_category", F.explode("landuse_area_ratios").alias("category", "ratio"))
    return out.withColumn("ratio", F.round("ratio", 6)).where("ratio > 0")


_G = lambda v: f"CASE WHEN {v} <= ty - 50 THEN 0 WHEN {v} <= ty + 50 THEN power({v} - ty + 50, 2) / 2 ELSE 5000 + 100 * ({v} - ty - 50) END"
#: The area of a polygon in a tile without clipping it: under each side, what lies in the tile, signed by the side's direction.
_AREAS = f"""{_edges_sql()}, tr AS (SELECT grid_id, x - 4000000 AS tx, y - 3000000 AS ty FROM tl),
te AS (SELECT grid_id, s, category, tx, ty, ax, ay, bx, by_, (by_ - ay) / (bx - ax) AS m, greatest(least(ax, bx), tx - 50) AS lo, least(greatest(ax, bx), tx + 50) AS hi FROM tr JOIN ed ON tx BETWEEN x - 50 AND x + 3 * u + 50 AND ty BETWEEN y - 50 AND y + 3 * u + 50 AND ax <> bx),
tf AS (SELECT *, ay + (lo - ax) * m AS fl, ay + (hi - ax) * m AS fh FROM te WHERE hi > lo),
ap AS (SELECT grid_id, s, category, sum(CASE WHEN bx > ax THEN -1 ELSE 1 END * ({_G('fh')} - {_G('fl')}) / m) AS area FROM tf GROUP BY ALL),
ac AS (SELECT grid_id, category, sum(area) / 10000 AS ratio FROM ap WHERE area > 1e-6 GROUP BY ALL),
ar AS (SELECT grid_id, category, ratio / greatest(1.0, sum(ratio) OVER (PARTITION BY grid_id)) AS ratio FROM ac),
mn AS (SELECT grid_id, CASE WHEN max(ratio) > 0.05 THEN arg_max(category, struct_pack(r := ratio, c := category)) ELSE 'open_area' END AS main FROM ar GROUP BY grid_id),
lu AS (SELECT grid_id, coalesce(main, 'open_area') AS main, coalesce(category, 'open_area') AS category, coalesce(ratio, 1.0) AS ratio FROM tl LEFT JOIN ar USING (grid_id) LEFT JOIN mn USING (grid_id))"""


def connection_probability_landuse(spark, sf):
    """The posterior of tiles given cells with a prior from land use."""
    prior = coverage.landuse_prior(_landuse(spark, sf), WEIGHTS)
    out = coverage.posterior_probability(coverage.connection_probability(_footprint(spark, sf)), prior)
    return out.select("cell_id", "grid_id", F.round("posterior_probability", 7).alias("posterior"))


def polygon_cover(spark, sf):
    """Tiles of polygons: by their centroids, by centroids within 130 metres, and all that they touch."""
    kinds = (("inside", "centroids", 0.0), ("near", "centroids", 130.0), ("met", "tiles", 0.0))
    out = None
    for name, by, buffer in kinds:
        own = areas.cover(_shapes(spark, sf), ["s"], ORIGIN, by, buffer).select("s", F.lit(name).alias("kind"), "grid_id", "origin", "tile_x", "tile_y")
        out = own if out is None else out.unionByName(own)
    return out


COVER_SQL = f"""WITH {_edges_sql()}, ce AS (SELECT s, unnest(range(cast(floor((x - 200) / 100) AS BIGINT), cast(ceil((x + 3 * u + 200) / 100) AS BIGINT))) AS e, y, u FROM su),
cn AS (SELECT s, e, unnest(range(cast(floor((y - 200) / 100) AS BIGINT), cast(ceil((y + 3 * u + 200) / 100) AS BIGINT))) AS n FROM ce), ct AS (SELECT *, e * 100 + 50.0::DOUBLE AS px, n * 100 + 50.0::DOUBLE AS py FROM cn),
cs AS (SELECT ct.*, ax, ay, bx, by_, greatest(0, least(1, ((px - ax) * (bx - ax) + (py - ay) * (by_ - ay)) / (power(bx - ax, 2) + power(by_ - ay, 2)))) AS w,
  (ay > py) <> (by_ > py) AND px < (bx - ax) * (py - ay) / (by_ - ay) + ax AS c, greatest(0, least((px - 50 - ax) / (bx - ax), (px + 50 - ax) / (bx - ax)), least((py - 50 - ay) / (by_ - ay), (py + 50 - ay) / (by_ - ay))) AS t0,
  least(1, greatest((px - 50 - ax) / (bx - ax), (px + 50 - ax) / (bx - ax)), greatest((py - 50 - ay) / (by_ - ay), (py + 50 - ay) / (by_ - ay))) AS t1 FROM ct JOIN ed USING (s)),
cg AS (SELECT s, e, n, px, py, sum(cast(c AS INTEGER)) % 2 = 1 AS inside, min(sqrt(power(px - ax - w * (bx - ax), 2) + power(py - ay - w * (by_ - ay), 2))) <= 130 AS near, bool_or(t0 <= t1) AS met FROM cs GROUP BY ALL)
SELECT s, kind, cast(((e + 10) << 16) + n + 10 AS INTEGER) AS grid_id, (cast(39990 AS BIGINT) << 32) + 29990 AS origin, px + 4000000 AS tile_x, py + 3000000 AS tile_y FROM cg, (VALUES ('inside'), ('near'), ('met')) v(kind) WHERE inside OR (kind = 'near' AND near) OR (kind = 'met' AND met)"""


def wkb_polygons(spark, sf):
    """Darts and their holes written as well-known binary, in either byte order, and read again; every seventh loses its last byte."""
    part = F.concat(F.array("ring"), "holes")
    shape = F.struct(F.lit("polygon").alias("kind"), F.array(part).alias("parts"))
    data = wkb.with_wkb(_shapes(spark, sf).select("s", shape.alias("made")), "made", "geometry", F.col("s") % 2 == 1)
    data = data.select("s", F.when(F.col("s") % 7 == 0, F.expr("substring(geometry, 1, length(geometry) - 1)")).otherwise(F.col("geometry")).alias("geometry"))
    read = wkb.with_geometry(data)
    area = F.aggregate(F.transform("holes", polygons.area), polygons.area(F.col("ring")), lambda a, h: a - h)
    whole = wkb.polygons_of(read).select("s", F.length("geometry").alias("bytes"), F.size("holes").alias("holes"), F.round(area, 4).alias("area"))
    none = F.lit(None)
    return whole.unionByName(read.where("shape is null").select("s", F.length("geometry").alias("bytes"), none.cast("int").alias("holes"), none.cast("double").alias("area")))


def zones_from_geojson(spark, sf):
    """Zones written as features and read again, with the parents that their ids tell."""
    name = F.when(F.col("s") % 6 == 0, F.lit("ES")).otherwise(F.concat(F.lit("ES"), (F.col("s") % 1000).cast("string")))
    path = shared_path(spark, "zones")
    tables.write_geojson(_shapes(spark, sf).select("s", name.alias("zone_id"), "ring", "holes"), path)
    read = tables.read_geojson(spark, path, "s bigint, zone_id string", lines=True)
    return read.select("s", "zone_id", zoning.nuts_parent(F.col("zone_id")).alias("parent_id"), F.size("ring").alias("corners"), F.size("holes").alias("holes"), F.round(polygons.area(F.col("ring")), 4).alias("area"))


def _roads(spark, sf):
    """A road for each supplier, through the corners of its dart."""
    return _shapes(spark, sf).select("s", "category", F.slice("ring", 2, 3).alias("line"))


def line_tiles(spark, sf):
    """Tiles within their category's width of a road; water has none."""
    return areas.near_lines(demo.ground(spark, sf), _roads(spark, sf), WIDTHS)


LINES_SQL = f"""WITH {GROUND}, {_edges_sql()}, ro AS (SELECT *, CASE category WHEN 'residential' THEN 60 WHEN 'forest' THEN 145 END AS d FROM ed WHERE ax = x + u * 3.0 OR (ax = x + u * 1.2 AND ay = y + u * 1.1)),
rt AS (SELECT grid_id, category, d, x4 - ax AS px, y4 - ay AS py, bx - ax AS vx, by_ - ay AS vy FROM (SELECT grid_id, x - 4000000 AS x4, y - 3000000 AS y4 FROM tl) t JOIN ro ON x4 BETWEEN least(ax, bx) - d AND greatest(ax, bx) + d AND y4 BETWEEN least(ay, by_) - d AND greatest(ay, by_) + d),
rd AS (SELECT *, greatest(0, least(1, (px * vx + py * vy) / (vx * vx + vy * vy))) AS w FROM rt)
SELECT DISTINCT grid_id, category FROM rd WHERE sqrt(power(px - w * vx, 2) + power(py - w * vy, 2)) <= d"""


def landuse_overlay(spark, sf):
    """Areas by category where polygons overlap: residential before forest before water, the rest open."""
    out = areas.overlay(demo.ground(spark, sf), _shapes(spark, sf), bin_size=500.0).withColumn("area", F.round("area", 2))
    return out.where("area > 0")


#: Rows between all heights at which something changes, swept along the line midway; sides aren't clipped but spans are.
OVERLAY_SQL = f"""WITH {GROUND}, {_edges_sql()}, te AS (SELECT grid_id, s, s % 3 AS pr, ax - tx AS ax, ay - ty AS ay, bx - tx AS bx, by_ - ty AS by_ FROM (SELECT grid_id, x - 4000050 AS tx, y - 3000050 AS ty FROM tl) t JOIN ed ON tx BETWEEN x - 100 AND x + 3 * u AND ty BETWEEN y - 100 AND y + 3 * u),
cy AS (SELECT DISTINCT grid_id, y FROM (SELECT grid_id, unnest([ay, by_, 0, 100, ay + (0 - ax) * (by_ - ay) / (bx - ax), ay + (100 - ax) * (by_ - ay) / (bx - ax)]) AS y FROM te
  UNION ALL SELECT grid_id, ay + (ox - ax + (ay - oy) * om) / (m - om) FROM (SELECT a.grid_id, a.ax, a.ay, (a.bx - a.ax) / (a.by_ - a.ay) AS m, b.ax AS ox, b.ay AS oy, (b.bx - b.ax) / (b.by_ - b.ay) AS om FROM te a JOIN te b USING (grid_id)) WHERE m <> om) WHERE y BETWEEN 0 AND 100),
sl AS (SELECT * FROM (SELECT grid_id, y AS y0, lead(y) OVER (PARTITION BY grid_id ORDER BY y) AS y1 FROM cy) WHERE y1 > y0),
cx AS (SELECT grid_id, y0, y1, s, pr, greatest(0, least(100, ax + ((y0 + y1) / 2 - ay) * (bx - ax) / (by_ - ay))) AS v, row_number() OVER (PARTITION BY grid_id, y0, s ORDER BY ax + ((y0 + y1) / 2 - ay) * (bx - ax) / (by_ - ay)) AS i FROM sl JOIN te USING (grid_id) WHERE (ay < (y0 + y1) / 2) <> (by_ < (y0 + y1) / 2)),
sp AS (SELECT a.grid_id, a.y0, a.y1, a.pr, a.v AS x0, b.v AS x1 FROM cx a JOIN cx b ON a.grid_id = b.grid_id AND a.y0 = b.y0 AND a.s = b.s AND a.i % 2 = 1 AND b.i = a.i + 1 WHERE b.v > a.v),
px AS (SELECT * FROM (SELECT grid_id, y0, y1, v, lead(v) OVER (PARTITION BY grid_id, y0 ORDER BY v) AS w FROM (SELECT DISTINCT grid_id, y0, y1, unnest([x0, x1]) AS v FROM sp)) WHERE w > v),
wi AS (SELECT px.grid_id, px.y0, px.y1, v, w, min(pr) AS pr FROM px JOIN sp ON px.grid_id = sp.grid_id AND px.y0 = sp.y0 AND x0 < (v + w) / 2 AND x1 > (v + w) / 2 GROUP BY ALL),
ov AS (SELECT grid_id, CASE pr WHEN 0 THEN 'residential' WHEN 1 THEN 'forest' ELSE 'water' END AS category, sum((w - v) * (y1 - y0)) AS area FROM wi GROUP BY ALL),
al AS (SELECT * FROM ov UNION ALL SELECT tl.grid_id, 'open_area', 10000 - coalesce(sum(area), 0) FROM tl LEFT JOIN ov ON ov.grid_id = tl.grid_id GROUP BY tl.grid_id)
SELECT grid_id, category, round(area, 2) AS area FROM al WHERE round(area, 2) > 0"""


def _zoned(spark, sf):
    """Zones of five by seven tiles, some of several parts, with holes."""
    e, n = grid.easting_index(F.col("grid_id")), grid.northing_index(F.col("grid_id"))
    zone = (F.floor(e / 5) * 3 + F.floor(n / 7)) % 9
    return demo.ground(spark, sf).where("k % 11 <> 0").select(zone.alias("zone"), "tile_x", "tile_y")


def zone_outlines(spark, sf):
    """Outlines of zones, a row for each ring."""
    r = areas.outlines(_zoned(spark, sf), "zone")
    least = lambda c: F.array_min(F.transform("ring", lambda p: p[c]))
    return r.select("zone", "area", F.size("ring").alias("corners"), least("x").alias("x0"), least("y").alias("y0"))


OUTLINES_SQL = f"""WITH RECURSIVE {GROUND}, zt AS (SELECT (e // 5 * 3 + n // 7) % 9 AS zone, e, n FROM (SELECT k, (grid_id >> 16) & 65535 AS e, grid_id & 65535 AS n FROM tl) WHERE k % 11 <> 0),
un AS (SELECT zone, e AS ax, n AS ay, e + 1 AS bx, n AS by_, 0 AS d FROM zt WHERE (zone, e, n - 1) NOT IN (SELECT zone, e, n FROM zt) UNION ALL SELECT zone, e + 1, n, e + 1, n + 1, 1 FROM zt WHERE (zone, e + 1, n) NOT IN (SELECT zone, e, n FROM zt)
  UNION ALL SELECT zone, e + 1, n + 1, e, n + 1, 2 FROM zt WHERE (zone, e, n + 1) NOT IN (SELECT zone, e, n FROM zt) UNION ALL SELECT zone, e, n + 1, e, n, 3 FROM zt WHERE (zone, e - 1, n) NOT IN (SELECT zone, e, n FROM zt)),
ui AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY zone, ax, ay, d) AS id FROM un),
nx AS MATERIALIZED (SELECT a.id, arg_min(b.id, CASE (b.d - a.d + 4) % 4 WHEN 1 THEN 0 WHEN 0 THEN 1 ELSE 2 END) AS next, arg_min(b.d, CASE (b.d - a.d + 4) % 4 WHEN 1 THEN 0 WHEN 0 THEN 1 ELSE 2 END) <> any_value(a.d) AS turns FROM ui a JOIN ui b ON a.zone = b.zone AND a.bx = b.ax AND a.by_ = b.ay GROUP BY a.id),
r AS (SELECT id AS s, id AS cur FROM ui UNION ALL SELECT r.s, nx.next FROM r JOIN nx ON nx.id = r.cur WHERE nx.next > r.s),
fu AS (SELECT r.s, max(CASE WHEN nx.next = r.s THEN 1 ELSE 0 END) AS closed FROM r JOIN nx ON nx.id = r.cur GROUP BY r.s HAVING closed = 1)
SELECT any_value(zone) AS zone, sum(ax * by_ - bx * ay) * 5000.0::DOUBLE AS area, cast(sum(cast(turns AS INTEGER)) AS INTEGER) AS corners, 4000000 + min(ax) * 100.0::DOUBLE AS x0, 3000000 + min(ay) * 100.0::DOUBLE AS y0 FROM fu JOIN r USING (s) JOIN ui ON ui.id = r.cur JOIN nx ON nx.id = r.cur GROUP BY s"""


def _boxes(spark, sf):
    s = F.col("s_suppkey").cast("double")
    lon, lat = -10 + s % 30, 36 + s % 20
    return demo.load(spark, sf, "supplier").select("s_suppkey", zoning.extent_box(lon, lat, lon + 0.011, lat + 0.007, 2, 3).alias("box"))


def grid_cover(spark, sf):
    """Tiles of an extent for each supplier, projected and snapped out to tiles, each with the box's own origin."""
    t = zoning.box_tiles(_boxes(spark, sf), "box")
    return t.select("s_suppkey", grid.pack(F.col("e"), F.col("n")).alias("grid_id"), grid.origin(F.col("box.x0"), F.col("box.y0")).alias("origin"), F.col("tile_x").cast("double"), F.col("tile_y").cast("double"))


def grid_blueprint(spark, sf):
    """The same extents in three by three sub-rasters."""
    return zoning.sub_rasters(_boxes(spark, sf), "box", 3).select("s_suppkey", "part", "box.*")


def _box_sql() -> str:
    q = "((1 - {e2}) * (s / (1 - {e2} * s * s) - ln((1 - {e} * s) / (1 + {e} * s)) / (2 * {e})))".format(e2=repr(geo._E2), e=repr(geo._E))
    sb, cb = repr(geo.math.sin(geo._B0)), repr(geo.math.cos(geo._B0))
    return f"""c AS (SELECT s_suppkey, sin(radians(36 + s_suppkey % 20 + 0.0035::DOUBLE * i)) AS s, radians(-10 + s_suppkey % 30 + 0.0055::DOUBLE * j) - {geo._LON0!r} AS dl FROM supplier, range(3) a(i), range(3) b(j)),
b AS (SELECT *, asin({q} / {geo._QP!r}) AS b FROM c), k AS (SELECT *, {geo._RQ!r} * sqrt(2 / (1 + {sb} * sin(b) + {cb} * cos(b) * cos(dl))) AS k FROM b),
p AS (SELECT s_suppkey, 4321000 + k * {geo._D!r} * cos(b) * sin(dl) AS x, 3210000 + k / {geo._D!r} * ({cb} * sin(b) - {sb} * cos(b) * cos(dl)) AS y FROM k),
m AS (SELECT s_suppkey, cast(floor(min(x) / 100) AS BIGINT) - 2 AS x0, cast(floor(min(y) / 100) AS BIGINT) - 2 AS y0, cast(ceil(max(x) / 100) AS BIGINT) + 2 AS x1, cast(ceil(max(y) / 100) AS BIGINT) + 2 AS y1 FROM p GROUP BY s_suppkey),
n AS (SELECT s_suppkey, x0, y0, (x1 - x0 + 2) // 3 AS w, (y1 - y0 + 2) // 3 AS h FROM m)"""


def _shoelace(points) -> float:
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:] + points[:1]))) / 2


QUERIES = {
    "wkb_polygons": (wkb_polygons, f"SELECT s, cast(9 + 4 + 64 + h * 52 - CASE WHEN s % 7 = 0 THEN 1 ELSE 0 END AS INTEGER) AS bytes, CASE WHEN s % 7 <> 0 THEN cast(h AS INTEGER) END AS holes, CASE WHEN s % 7 <> 0 THEN round(u * u * ({_shoelace(_DART)!r} - h * {_shoelace(_HOLE)!r}), 4) END AS area FROM (SELECT s_suppkey AS s, CASE WHEN s_suppkey % 4 = 0 THEN 1 ELSE 0 END AS h, 40.0::DOUBLE + s_suppkey % 5 * 35 AS u FROM supplier)"),
    "landuse_polygons": (landuse_polygons, f"WITH {GROUND}, {_AREAS} SELECT grid_id, main AS main_landuse_category, category, round(ratio, 6) AS ratio FROM lu WHERE round(ratio, 6) > 0"),
    "connection_probability_landuse": (connection_probability_landuse, f"WITH {CONN_GROUND}, {_AREAS}, pw AS (SELECT grid_id, sum(ratio * CASE category WHEN 'residential' THEN 1.0 WHEN 'forest' THEN 0.1 WHEN 'open_area' THEN 0.2 ELSE 0 END) AS w FROM lu GROUP BY grid_id), jo AS (SELECT cell_id, grid_id, p * w AS j, sum(p * w) OVER (PARTITION BY cell_id) AS t FROM cp JOIN pw USING (grid_id)) SELECT cell_id, grid_id, round(CASE WHEN t > 0 THEN j / t ELSE 0 END, 7) AS posterior FROM jo"),
    "zones_from_geojson": (zones_from_geojson, f"SELECT s, z AS zone_id, CASE WHEN length(z) > 2 THEN substr(z, 1, length(z) - 1) END AS parent_id, 4 AS corners, CASE WHEN s % 4 = 0 THEN 1 ELSE 0 END AS holes, round(u * u * {_shoelace(_DART)!r}, 4) AS area FROM (SELECT s_suppkey AS s, 'ES' || CASE WHEN s_suppkey % 6 = 0 THEN '' ELSE cast(s_suppkey % 1000 AS VARCHAR) END AS z, 40.0::DOUBLE + s_suppkey % 5 * 35 AS u FROM supplier)"),
    "polygon_cover": (polygon_cover, COVER_SQL),
    "line_tiles": (line_tiles, LINES_SQL),
    "landuse_overlay": (landuse_overlay, OVERLAY_SQL),
    "zone_outlines": (zone_outlines, OUTLINES_SQL),
    "grid_cover": (grid_cover, f"WITH {_box_sql()} SELECT s_suppkey, cast((e << 16) + f AS INTEGER) AS grid_id, (x0 << 32) + y0 AS origin, (x0 + e) * 100 + 50.0::DOUBLE AS tile_x, (y0 + f) * 100 + 50.0::DOUBLE AS tile_y FROM (SELECT *, unnest(range(h * 3)) AS f FROM (SELECT *, unnest(range(w * 3)) AS e FROM n))"),
    "grid_blueprint": (grid_blueprint, f"WITH {_box_sql()} SELECT s_suppkey, cast(i AS INTEGER) AS part, (x0 + i % 3 * w) * 100 AS x0, (y0 + i // 3 * h) * 100 AS y0, (x0 + (i % 3 + 1) * w) * 100 AS x1, (y0 + (i // 3 + 1) * h) * 100 AS y1 FROM n, range(9) r(i)"),
}
