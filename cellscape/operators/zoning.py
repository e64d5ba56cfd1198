"""Grid generation, tile enrichment and the mapping of tiles to zones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grid
from ..functions.geo import inside, project, to_grid


def snapped_extent(lon_min: float, lat_min: float, lon_max: float, lat_max: float, margin: int = 5, sub_rasters: int = 1) -> tuple[int, int, int, int]:
    """The extent's bounding box on the plane, snapped out to tiles, widened by ``margin``, its sides divisible by ``sub_rasters``."""
    corners = [project(la, lo) for la in (lat_min, (lat_min + lat_max) / 2, lat_max) for lo in (lon_min, (lon_min + lon_max) / 2, lon_max)]
    xs, ys = [c[0] for c in corners], [c[1] for c in corners]
    x0, y0 = (int(min(v) // grid.TILE - margin) for v in (xs, ys))
    x1, y1 = (int(-(-max(v) // grid.TILE) + margin) for v in (xs, ys))
    x1, y1 = x1 + (x0 - x1) % sub_rasters, y1 + (y0 - y1) % sub_rasters
    return x0 * grid.TILE, y0 * grid.TILE, x1 * grid.TILE, y1 * grid.TILE


def blueprint(spark: SparkSession, box: tuple[int, int, int, int], parts: int) -> DataFrame:
    """(x0, y0, columns, rows) of the parts x parts sub-rasters of a box."""
    w, h = (box[2] - box[0]) // grid.TILE // parts, (box[3] - box[1]) // grid.TILE // parts
    i, j = (F.col("id") % parts), F.floor(F.col("id") / parts)
    return spark.range(parts * parts).select((i * w * grid.TILE + box[0]).alias("x0"), (j * h * grid.TILE + box[1]).alias("y0"), F.lit(w).alias("columns"), F.lit(h).alias("rows"))


def cover(spark: SparkSession, box: tuple[int, int, int, int], quadkey_zoom: int | None = None, partitions: int | None = None) -> DataFrame:
    """(grid_id, origin, easting, northing of the centroid) of each tile of a snapped box, made where it is used."""
    columns, rows = (box[2] - box[0]) // grid.TILE, (box[3] - box[1]) // grid.TILE
    if max(columns, rows) > 1 << 16:
        raise ValueError("a grid has at most 65536 tiles a side")
    e, n = (F.col("id") % columns).cast("int"), F.floor(F.col("id") / columns).cast("int")
    return spark.range(0, columns * rows, 1, partitions).select(
        grid.pack(e, n).alias("grid_id"),
        grid.origin(F.lit(box[0]), F.lit(box[1])).alias("origin"),
        (F.lit(box[0]) + e * grid.TILE + grid.TILE / 2).alias("tile_x"),
        (F.lit(box[1]) + n * grid.TILE + grid.TILE / 2).alias("tile_y"),
    )


def extent_box(lon_min: Column, lat_min: Column, lon_max: Column, lat_max: Column, margin: int = 5, parts: int = 1) -> Column:
    """``snapped_extent`` of columns: struct (x0, y0, x1, y1) in metres, sides divisible by ``parts`` tiles."""
    corners = F.array(*[F.struct(*[v.alias(c) for c, v in zip("xy", to_grid(la, lo))]) for la in (lat_min, (lat_min + lat_max) / 2, lat_max) for lo in (lon_min, (lon_min + lon_max) / 2, lon_max)])
    low = lambda c: F.floor(F.array_min(F.transform(corners, lambda p: p[c])) / grid.TILE) - margin
    high = lambda c: F.ceil(F.array_max(F.transform(corners, lambda p: p[c])) / grid.TILE) + margin
    even = lambda c: high(c) + F.pmod(low(c) - high(c), F.lit(parts))
    return F.struct(*[(v * grid.TILE).alias(n) for n, v in (("x0", low("x")), ("y0", low("y")), ("x1", even("x")), ("y1", even("y")))])


def sub_rasters(df: DataFrame, box: str, parts: int) -> DataFrame:
    """``df`` with one row for each of the parts x parts sub-rasters of its box (of sides that they divide): ``part`` and its ``box``."""
    b, i = F.col(box), F.col("part")
    w, h = (F.floor((b[f"{c}1"] - b[f"{c}0"]) / (grid.TILE * parts)) * grid.TILE for c in "xy")
    x, y = b["x0"] + i % parts * w, b["y0"] + F.floor(i / parts) * h
    out = df.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts * parts - 1))))
    return out.withColumn(box, F.struct(x.alias("x0"), y.alias("y0"), (x + w).alias("x1"), (y + h).alias("y1")))


def box_tiles(df: DataFrame, box: str) -> DataFrame:
    """``df`` with a row for each tile of its box: e and n from the box's corner, and the centroid."""
    b = F.col(box)
    steps = lambda c: F.sequence(F.lit(0).cast("long"), F.floor((b[f"{c}1"] - b[f"{c}0"]) / grid.TILE) - 1)
    out = df.withColumn("e", F.explode(steps("x"))).withColumn("n", F.explode(steps("y")))
    half = grid.TILE / 2
    return out.withColumns({"tile_x": b["x0"] + F.col("e") * grid.TILE + half, "tile_y": b["y0"] + F.col("n") * grid.TILE + half})


def ring_extent(ring: Column) -> Column:
    """Struct (x0, y0, x1, y1) of an array of points."""
    pick = lambda f, c: f(F.transform(ring, lambda p: p[c]))
    return F.struct(pick(F.array_min, "x").alias("x0"), pick(F.array_min, "y").alias("y0"), pick(F.array_max, "x").alias("x1"), pick(F.array_max, "y").alias("y1"))


def in_polygons(points: DataFrame, polygons: DataFrame, bin_size: float, x: str = "tile_x", y: str = "tile_y", ring: str = "ring") -> DataFrame:
    """Pairs of point and polygon that holds it: polygons are spread over the bins that their extent meets."""
    b = polygons.withColumn("_box", ring_extent(F.col(ring)))
    steps = lambda lo, hi: F.sequence(F.floor(lo / bin_size), F.floor(hi / bin_size))
    b = b.withColumn("_px", F.explode(steps(F.col("_box.x0"), F.col("_box.x1")))).withColumn("_py", F.explode(steps(F.col("_box.y0"), F.col("_box.y1"))))
    p = points.withColumns({"_tx": F.floor(F.col(x) / bin_size), "_ty": F.floor(F.col(y) / bin_size)})
    return p.join(b, (F.col("_tx") == F.col("_px")) & (F.col("_ty") == F.col("_py"))).where(inside(F.col(x), F.col(y), F.col(ring))).drop("_tx", "_ty", "_px", "_py", "_box")


def mask(tiles: DataFrame, polygons: DataFrame, bin_size: float = 10_000.0) -> DataFrame:
    """Tiles whose centroid lies in some polygon."""
    return in_polygons(tiles, polygons.select("ring"), bin_size).drop("ring").distinct()


def map_zones(tiles: DataFrame, zones: DataFrame, bin_size: float = 10_000.0) -> DataFrame:
    """(grid_id, zone_id): the leaf zone that holds the tile's centroid (the first by id), or ``undefined``."""
    hits = in_polygons(tiles, zones.select("zone_id", "ring"), bin_size).groupBy("grid_id").agg(F.min("zone_id").alias("_zone"))
    return tiles.join(hits, "grid_id", "left").select("grid_id", F.coalesce("_zone", F.lit("undefined")).alias("zone_id"))


def hierarchy(zones: DataFrame, levels: int) -> DataFrame:
    """(zone_id, hierarchical_id) of the zones of the deepest level: ids from the root down, joined by a bar."""
    up = zones.select(F.col("zone_id").alias("_id"), F.col("parent_id").alias("_parent"))
    out = zones.where(F.col("level") == levels).select("zone_id", F.col("parent_id").alias("_at"), F.col("zone_id").alias("hierarchical_id"))
    for _ in range(levels - 1):
        out = out.join(up, F.col("_at") == F.col("_id"), "left").select("zone_id", F.col("_parent").alias("_at"), F.concat_ws("|", "_at", "hierarchical_id").alias("hierarchical_id"))
    return out.select("zone_id", "hierarchical_id")


def zone_at_level(path: Column, level: Column | int) -> Column:
    """The id at ``level`` (1: the root), or null where the path is shorter."""
    return F.try_element_at(F.split(path, r"\|"), F.lit(level) if isinstance(level, int) else level)


def landuse_ratios(tiles: DataFrame, landuse: DataFrame, bin_size: float = 1000.0, default: str = "open_area", least: float = 0.05) -> DataFrame:
    """(grid_id, landuse_area_ratios, main_landuse_category) from rectangles (category, x0, y0, x1, y1).

    Ratios are shares of the tile's area, scaled down where they sum to more than 1; the main category is the
    largest of over ``least``, else ``default``; tiles without land use are all ``default``.
    """
    half = grid.TILE / 2
    steps = lambda lo, hi: F.sequence(F.floor(lo / bin_size), F.floor(hi / bin_size))
    spread = landuse.withColumn("_lx", F.explode(steps(F.col("x0"), F.col("x1")))).withColumn("_ly", F.explode(steps(F.col("y0"), F.col("y1"))))
    t = tiles.select("grid_id", "tile_x", "tile_y")
    t = t.withColumn("_tx", F.explode(F.array_distinct(F.array(F.floor((F.col("tile_x") - half) / bin_size), F.floor((F.col("tile_x") + half) / bin_size)))))
    t = t.withColumn("_ty", F.explode(F.array_distinct(F.array(F.floor((F.col("tile_y") - half) / bin_size), F.floor((F.col("tile_y") + half) / bin_size)))))
    side = lambda v, lo, hi: F.greatest(F.lit(0.0), F.least(F.col(v) + half, F.col(hi)) - F.greatest(F.col(v) - half, F.col(lo)))
    pairs = t.join(spread, (F.col("_tx") == F.col("_lx")) & (F.col("_ty") == F.col("_ly"))).withColumn("area", side("tile_x", "x0", "x1") * side("tile_y", "y0", "y1"))
    pairs = pairs.where("area > 0").dropDuplicates(["grid_id", "category", "x0", "y0", "x1", "y1"])
    return ratio_map(tiles, pairs.groupBy("grid_id", "category").agg(F.sum("area").alias("area")), default, least)


def ratio_map(tiles: DataFrame, areas: DataFrame, default: str = "open_area", least: float = 0.05) -> DataFrame:
    """(grid_id, landuse_area_ratios, main_landuse_category) from (grid_id, category, area), as ``landuse_ratios`` tells them."""
    shares = areas.select("grid_id", "category", (F.col("area") / (grid.TILE * grid.TILE)).alias("ratio"))
    by_tile = shares.groupBy("grid_id").agg(F.array_sort(F.collect_list(F.struct("category", "ratio"))).alias("r"), F.sum("ratio").alias("all"))
    scale = F.greatest(F.col("all"), F.lit(1.0))
    ratios = F.map_from_entries(F.transform("r", lambda e: F.struct(e["category"], e["ratio"] / scale)))
    best = F.array_max(F.transform("r", lambda e: F.struct((e["ratio"] / scale).alias("ratio"), e["category"].alias("category"))))
    known = by_tile.select("grid_id", ratios.alias("_ratios"), F.when(best["ratio"] > least, best["category"]).otherwise(default).alias("_main"))
    empty = F.create_map(F.lit(default), F.lit(1.0))
    return tiles.join(known, "grid_id", "left").select("grid_id", F.coalesce("_ratios", empty).alias("landuse_area_ratios"), F.coalesce("_main", F.lit(default)).alias("main_landuse_category"))


def reclassify(category: Column, mapping: Mapping[str, str], missing: str | None = None) -> Column:
    out = F.lit(missing)
    for k, v in mapping.items():
        out = F.when(category == k, v).otherwise(out)
    return out


def buffered(lines: DataFrame, widths: Mapping[str, float]) -> DataFrame:
    """Rectangles (category, x0, y0, x1, y1) around axis-aligned extents of transport lines, as wide as their category asks."""
    w = F.lit(0.0)
    for k, v in widths.items():
        w = F.when(F.col("category") == k, float(v)).otherwise(w)
    return lines.select("category", (F.col("x0") - w).alias("x0"), (F.col("y0") - w).alias("y0"), (F.col("x1") + w).alias("x1"), (F.col("y1") + w).alias("y1"))


def nuts_parent(zone_id: Column) -> Column:
    """A statistical region's parent: its id less the last character; countries (two characters) have none."""
    return F.when(F.length(zone_id) > 2, F.substring(zone_id, F.lit(1), F.length(zone_id) - 1))
