"""Grid, quadkey, projection and zoning queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, grid
from ..operators import coverage, zoning
from ..sources import demo
from . import views

X0, Y0 = 1_000_000, 2_000_000


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    e, n = p * 219 % 65536, p * 37 % 65536
    return demo.load(spark, sf_dir, "part").select("p_partkey", e.alias("e"), n.alias("n"), grid.pack(e, n).alias("grid_id"), grid.origin(F.lit(X0), F.lit(Y0)).alias("origin"))


T = f"t AS (SELECT p_partkey, p_partkey * 219 % 65536 AS e, p_partkey * 37 % 65536 AS n, (cast({X0 // 100} AS BIGINT) << 32) + {Y0 // 100} AS origin FROM part)"
PACK = "cast(CASE WHEN (({e}) << 16) + ({n}) >= 2147483648 THEN (({e}) << 16) + ({n}) - 4294967296 ELSE (({e}) << 16) + ({n}) END AS INTEGER)"


def pack_sql(e: str = "e", n: str = "n") -> str:
    return PACK.format(e=e, n=n)


def grid_pack(spark, sf):
    g = F.col("grid_id")
    x, y = grid.centroid(g, F.col("origin"))
    return tiles(spark, sf).select("p_partkey", "grid_id", "origin", grid.easting_index(g).alias("e"), grid.northing_index(g).alias("n"), x.alias("x"), y.alias("y"))


def grid_inspire_id(spark, sf):
    g, o = F.col("grid_id"), F.col("origin")
    b = grid.inspire_bounds(grid.inspire_id(g, o, 1000))
    return tiles(spark, sf).select("p_partkey", grid.inspire_id(g, o).alias("id_100m"), grid.inspire_id(g, o, 1000).alias("id_1km"), b["x0"].alias("x0"), b["y1"].alias("y1"))


def grid_coarsen(spark, sf):
    b = grid.tile_bounds(grid.coarsen(F.col("grid_id"), 10), F.col("origin"), 10)
    return tiles(spark, sf).select("p_partkey", grid.coarsen(F.col("grid_id"), 2).alias("g200"), grid.coarsen(F.col("grid_id"), 10).alias("g1000"), b["x0"].alias("x0"), b["y1"].alias("y1"))


def grid_refine(spark, sf):
    coarse = tiles(spark, sf).select(grid.coarsen(F.col("grid_id"), 2).alias("coarse_id")).distinct()
    return grid.refine(coarse, 2, "coarse_id").select("coarse_id", "grid_id")


def quadkey_assign(spark, sf):
    c = demo.load(spark, sf, "customer")
    lat, lon = F.col("c_custkey") * 7 % 170 - 85.0, F.col("c_custkey") * 13 % 360 - 180.0
    q = grid.quadkey(lat, lon, 12)
    t, x = grid.quadkey_tile(q), grid.quadkey_extent(q)
    return c.select("c_custkey", q.alias("quadkey"), t["x"].alias("x"), t["y"].alias("y"), F.round(x["lon_min"], 6).alias("lon_min"), F.round(x["lat_max"], 6).alias("lat_max"))


_DIGITS = " || ".join(f"cast(((x >> {i}) & 1) + 2 * ((y >> {i}) & 1) AS VARCHAR)" for i in range(11, -1, -1))
QUADKEY_SQL = f"""WITH c AS (SELECT c_custkey, c_custkey * 7 % 170 - 85.0::DOUBLE AS lat, c_custkey * 13 % 360 - 180.0::DOUBLE AS lon FROM customer),
s AS (SELECT *, sin(radians(greatest(least(lat, 85.05112878), -85.05112878))) AS s FROM c),
x AS (SELECT c_custkey, greatest(0, least(cast(floor((lon + 180) / 360 * 4096) AS INTEGER), 4095)) AS x, greatest(0, least(cast(floor((0.5 - ln((1 + s) / (1 - s)) / (4 * pi())) * 4096) AS INTEGER), 4095)) AS y FROM s)
SELECT c_custkey, {_DIGITS} AS quadkey, x, y, round(x / 4096.0::DOUBLE * 360 - 180, 6) AS lon_min, round(degrees(atan((exp(pi() * (1 - 2 * y / 4096.0::DOUBLE)) - exp(-pi() * (1 - 2 * y / 4096.0::DOUBLE))) / 2)), 6) AS lat_max FROM x"""


def quadkey_children(spark, sf):
    n = demo.load(spark, sf, "nation").select("n_nationkey", grid.quadkey(F.col("n_nationkey") * 3.0 - 40, F.col("n_nationkey") * 7.0 - 90, 5).alias("quadkey"))
    return grid.quadkey_children(n, 2)


CHILDREN_SQL = (
    "WITH s AS (SELECT n_nationkey, sin(radians(n_nationkey * 3.0::DOUBLE - 40)) AS s, n_nationkey * 7.0::DOUBLE - 90 AS lon FROM nation), x AS (SELECT n_nationkey, cast(floor((lon + 180) / 360 * 32) AS INTEGER) AS x, cast(floor((0.5 - ln((1 + s) / (1 - s)) / (4 * pi())) * 32) AS INTEGER) AS y FROM s) "
    "SELECT n_nationkey, " + " || ".join(f"cast(((x >> {i}) & 1) + 2 * ((y >> {i}) & 1) AS VARCHAR)" for i in range(4, -1, -1)) + " || cast(a AS VARCHAR) || cast(b AS VARCHAR) AS quadkey FROM x, range(4) p(a), range(4) q(b)"
)


def quadkeys_of_box(spark, sf):
    n = demo.load(spark, sf, "nation").select("n_nationkey", F.struct((F.col("n_nationkey") * 2.0 - 20).alias("lon_min"), (F.col("n_nationkey") * 1.0).alias("lat_min"), (F.col("n_nationkey") * 2.0 - 17).alias("lon_max"), (F.col("n_nationkey") + 2.0).alias("lat_max")).alias("box"))
    return grid.quadkeys_of_box(n, 8).groupBy("n_nationkey").agg(F.count("*").alias("quadkeys"), F.min("quadkey").alias("first"), F.max("quadkey").alias("last"))


def _ytile(lat: str, n: int) -> str:
    return f"cast(floor((0.5 - ln((1 + sin(radians({lat}))) / (1 - sin(radians({lat})))) / (4 * pi())) * {n}) AS INTEGER)"


_D8 = " || ".join(f"cast(((x >> {i}) & 1) + 2 * ((y >> {i}) & 1) AS VARCHAR)" for i in range(7, -1, -1))
BOX_SQL = f"""WITH a AS (SELECT n_nationkey, cast(floor((n_nationkey * 2.0::DOUBLE - 20 + 180) / 360 * 256) AS INTEGER) AS xa, cast(floor((n_nationkey * 2.0::DOUBLE - 17 + 180) / 360 * 256) AS INTEGER) AS xb, {_ytile('n_nationkey + 2.0::DOUBLE', 256)} AS ya, {_ytile('n_nationkey * 1.0::DOUBLE', 256)} AS yb FROM nation),
q AS (SELECT n_nationkey, x, y FROM (SELECT n_nationkey, ya, yb, unnest(range(xa, xb + 1)) AS x FROM a), LATERAL (SELECT unnest(range(ya, yb + 1)) AS y))
SELECT n_nationkey, count(*) AS quadkeys, min({_D8}) AS first, max({_D8}) AS last FROM q GROUP BY n_nationkey"""


def user_modulo(spark, sf):
    c = demo.load(spark, sf, "customer")
    return c.select("c_custkey", grid.user_bucket(F.sha2(F.col("c_custkey").cast("string").cast("binary"), 256), 8).alias("user_id_modulo"))


def zone_hierarchy(spark, sf):
    n, r = demo.load(spark, sf, "nation"), demo.load(spark, sf, "region")
    root = r.select(F.concat(F.lit("R"), "r_regionkey").alias("zone_id"), F.lit(None).cast("string").alias("parent_id"), F.lit(1).alias("level"))
    mid = n.select(F.concat(F.lit("N"), "n_nationkey").alias("zone_id"), F.concat(F.lit("R"), "n_regionkey").alias("parent_id"), F.lit(2).alias("level"))
    leaf = demo.load(spark, sf, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("zone_id"), F.concat(F.lit("N"), "s_nationkey").alias("parent_id"), F.lit(3).alias("level"))
    return zoning.hierarchy(root.unionByName(mid).unionByName(leaf), 3)


def zones_of_tiles(spark, sf):
    """Nation rectangles over the lattice; tiles outside are undefined."""
    x, y = demo.ORIGIN[0] + F.col("n_nationkey") % 5 * 180.0, demo.ORIGIN[1] + F.floor(F.col("n_nationkey") / 5) * 180.0
    p = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    z = demo.load(spark, sf, "nation").select(F.col("n_name").alias("zone_id"), F.array(p(0, 0), p(180, 0), p(180, 180), p(0, 180), p(0, 0)).alias("ring"))
    return zoning.map_zones(demo.lattice(spark), z, 500.0)


def landuse_tiles(spark, sf):
    """The lattice's tiles with the shares and the main category of the suppliers' rectangles."""
    s = F.col("s_suppkey")
    x, y = demo.ORIGIN[0] + s * 83 % 950, demo.ORIGIN[1] + s * 47 % 950
    rect = demo.load(spark, sf, "supplier").select(F.element_at(F.array(F.lit("residential"), F.lit("forest"), F.lit("water")), (s % 3 + 1).cast("int")).alias("category"), x.cast("double").alias("x0"), y.cast("double").alias("y0"), (x + 20 + s % 60).cast("double").alias("x1"), (y + 120.0).alias("y1"))
    return zoning.landuse_ratios(demo.lattice(spark), rect, 300.0)


def landuse(spark, sf):
    out = landuse_tiles(spark, sf)
    entries = F.transform(F.array_sort(F.map_entries("landuse_area_ratios")), lambda e: F.concat_ws("=", e["key"], F.format_number(e["value"], 4)))
    prior = coverage.landuse_prior(out, {"residential": 1.0, "forest": 0.1, "open_area": 0.2})
    return out.join(prior, "grid_id").select("grid_id", F.array_join(entries, ",").alias("ratios"), F.col("main_landuse_category").alias("main"), F.round("prior", 8).alias("prior"))


LANDUSE_SQL = f"""WITH {views.TILES}, r AS (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'residential' WHEN 1 THEN 'forest' ELSE 'water' END AS category, 4000000 + s_suppkey * 83 % 950 AS x0, 3000000 + s_suppkey * 47 % 950 AS y0, 4000000 + s_suppkey * 83 % 950 + 20 + s_suppkey % 60 AS x1, 3000000 + s_suppkey * 47 % 950 + 120 AS y1 FROM supplier),
rd AS (SELECT DISTINCT category, x0, y0, x1, y1 FROM r),
a AS (SELECT grid_id, category, sum(greatest(0, least(x + 50, x1) - greatest(x - 50, x0)) * greatest(0, least(y + 50, y1) - greatest(y - 50, y0))) / 10000.0::DOUBLE AS ratio FROM tl, rd GROUP BY ALL HAVING ratio > 0),
b AS (SELECT grid_id, category, ratio / greatest(sum(ratio) OVER (PARTITION BY grid_id), 1.0) AS ratio FROM a),
c AS (SELECT grid_id, string_agg(category || '=' || format('{{:.4f}}', ratio), ',' ORDER BY category) AS ratios, max(CASE WHEN ratio > 0.05 THEN ratio END) AS m, arg_max(category, struct_pack(a := ratio, b := category)) AS best, max(ratio) AS mr, sum(ratio * CASE category WHEN 'residential' THEN 1.0 WHEN 'forest' THEN 0.1 ELSE 0 END) AS w FROM b GROUP BY grid_id),
d AS (SELECT t.grid_id, coalesce(ratios, 'open_area=1.0000') AS ratios, CASE WHEN mr > 0.05 THEN best ELSE 'open_area' END AS main, CASE WHEN c.grid_id IS NULL THEN 0.2 ELSE w END AS w FROM tl t LEFT JOIN c ON c.grid_id = t.grid_id)
SELECT grid_id, ratios, main, round(w / sum(w) OVER (), 8) AS prior FROM d"""


def projected(spark, sf):
    c = demo.load(spark, sf, "customer").select("c_custkey", (F.col("c_custkey") % 30 + 35.0).alias("lat"), (F.col("c_custkey") % 40 - 10.0).alias("lon"))
    x, y = geo.to_grid(F.col("lat"), F.col("lon"))
    return c.select("c_custkey", F.round(x, 3).alias("easting"), F.round(y, 3).alias("northing"))


def _projection_sql() -> str:
    q = "((1 - {e2}) * (s / (1 - {e2} * s * s) - ln((1 - {e} * s) / (1 + {e} * s)) / (2 * {e})))".format(e2=repr(geo._E2), e=repr(geo._E))
    sb, cb = repr(geo.math.sin(geo._B0)), repr(geo.math.cos(geo._B0))
    return f"""WITH c AS (SELECT c_custkey, sin(radians(c_custkey % 30 + 35.0::DOUBLE)) AS s, radians(c_custkey % 40 - 10.0::DOUBLE) - {geo._LON0!r} AS dl FROM customer),
b AS (SELECT *, asin({q} / {geo._QP!r}) AS b FROM c), k AS (SELECT *, {geo._RQ!r} * sqrt(2 / (1 + {sb} * sin(b) + {cb} * cos(b) * cos(dl))) AS k FROM b)
SELECT c_custkey, round(4321000 + k * {geo._D!r} * cos(b) * sin(dl), 3) AS easting, round(3210000 + k / {geo._D!r} * ({cb} * sin(b) - {sb} * cos(b) * cos(dl)), 3) AS northing FROM k"""


QUERIES = {
    "grid_pack": (grid_pack, f"WITH {T} SELECT p_partkey, {pack_sql()} AS grid_id, origin, cast(e AS INTEGER) AS e, cast(n AS INTEGER) AS n, {X0} + e * 100 + 50.0::DOUBLE AS x, {Y0} + n * 100 + 50.0::DOUBLE AS y FROM t"),
    "grid_inspire_id": (grid_inspire_id, f"WITH {T} SELECT p_partkey, '100mN' || ({Y0 // 100} + n) || 'E' || ({X0 // 100} + e) AS id_100m, '1kmN' || (({Y0 // 100} + n) // 10) || 'E' || (({X0 // 100} + e) // 10) AS id_1km, ({X0 // 100} + e) // 10 * 1000 AS x0, ({Y0 // 100} + n) // 10 * 1000 + 1000 AS y1 FROM t"),
    "grid_coarsen": (grid_coarsen, f"WITH {T} SELECT p_partkey, {pack_sql('e - e % 2', 'n - n % 2')} AS g200, {pack_sql('e - e % 10', 'n - n % 10')} AS g1000, {X0} + (e - e % 10) * 100 AS x0, {Y0} + (n - n % 10) * 100 + 1000 AS y1 FROM t"),
    "grid_refine": (grid_refine, f"WITH {T}, d AS (SELECT DISTINCT e - e % 2 AS e, n - n % 2 AS n FROM t) SELECT {pack_sql()} AS coarse_id, {pack_sql('e + a', 'n + b')} AS grid_id FROM d, range(2) p(a), range(2) q(b)"),
    "quadkey_assign": (quadkey_assign, QUADKEY_SQL),
    "quadkey_children": (quadkey_children, CHILDREN_SQL),
    "quadkeys_of_box": (quadkeys_of_box, BOX_SQL),
    "user_modulo": (user_modulo, "SELECT c_custkey, cast(('0x' || substr(sha256(cast(c_custkey AS VARCHAR)), 1, 14))::BIGINT % 8 AS INTEGER) AS user_id_modulo FROM customer"),
    "zone_hierarchy": (zone_hierarchy, "SELECT 'S' || s_suppkey AS zone_id, 'R' || n_regionkey || '|N' || n_nationkey || '|S' || s_suppkey AS hierarchical_id FROM supplier JOIN nation ON n_nationkey = s_nationkey"),
    "zones_of_tiles": (zones_of_tiles, f"WITH {views.TILES}, z AS (SELECT n_name, 4000000 + n_nationkey % 5 * 180 AS x0, 3000000 + n_nationkey // 5 * 180 AS y0 FROM nation) SELECT grid_id, coalesce(min(n_name), 'undefined') AS zone_id FROM tl LEFT JOIN z ON x > x0 AND x < x0 + 180 AND y > y0 AND y < y0 + 180 GROUP BY grid_id"),
    "landuse_enrichment": (landuse, LANDUSE_SQL),
    "equal_area_projection": (projected, _projection_sql()),
}
