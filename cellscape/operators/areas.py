"""Polygons and lines on the lattice of tiles: cover, land use shares, distances to lines, priority overlay, outlines.

A polygon is a ring and its holes (``holes``: an array of rings, or no such column); a line is an array of points. Everything is
rows, columns of a lattice and exact arithmetic on them: a shape is first dealt to the bins or rows of tiles that it meets, so a
large one is many small tasks, and no two shapes meet anywhere but in a bin.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import grid, polygons
from ..plans.iterate import cut
from ..plans.joins import dealt

RINGS = f"array<{polygons.RING}>"


def rings(shapes: DataFrame) -> Column:
    """The outer ring and the holes as one array."""
    ring = F.array(F.col("ring").cast(polygons.RING))
    return F.concat(ring, F.coalesce(F.col("holes").cast(RINGS), F.array().cast(RINGS))) if "holes" in shapes.columns else ring


def _extent(points: Column, axis: str) -> tuple[Column, Column]:
    values = F.transform(points, lambda p: p[axis])
    return F.array_min(values), F.array_max(values)


def binned(shapes: DataFrame, bin_size: float) -> DataFrame:
    """``shapes`` as one row for each bin (bx, by) that their outer ring's extent meets, with ``parts``: their rings cut to the bin."""
    cell = lambda v: F.floor(v / bin_size)
    out = dealt(shapes).withColumn("_rings", rings(shapes))  # a small file of keys is one task, whose rows are much work
    for axis, name in (("x", "bx"), ("y", "by")):
        low, high = _extent(F.col("ring"), axis)
        out = out.withColumn(name, F.explode(F.sequence(cell(low), cell(high))))
    x, y = F.col("bx") * bin_size, F.col("by") * bin_size
    parts = F.filter(F.transform("_rings", lambda r: polygons.clip(r, x, y, x + bin_size, y + bin_size)), lambda r: F.size(r) > 2)
    return out.withColumn("parts", parts).where(F.size("parts") > 0).drop("_rings")


def tile_pieces(tiles: DataFrame, shapes: DataFrame, bin_size: float = 1000.0) -> DataFrame:
    """Each tile beside each shape that shares area with it: the shape's columns, ``pieces`` (its rings in the tile) and ``area``.

    ``bin_size`` is a multiple of a tile's side, so a tile is in one bin.
    """
    if bin_size % grid.TILE:
        raise ValueError("bins are made of whole tiles")
    half = grid.TILE / 2
    t = tiles.select("grid_id", "tile_x", "tile_y", F.floor(F.col("tile_x") / bin_size).alias("bx"), F.floor(F.col("tile_y") / bin_size).alias("by"))
    met = dealt(t, "bx", "by").join(dealt(binned(shapes, bin_size), "bx", "by").hint("merge"), ["bx", "by"])  # else what is few bytes is cut in few tasks
    x, y = F.col("tile_x"), F.col("tile_y")
    met = met.withColumn("pieces", F.transform("parts", lambda r: polygons.clip(r, x - half, y - half, x + half, y + half)))
    outer = F.transform("pieces", polygons.signed_area)
    size = F.aggregate(outer, F.lit(0.0), lambda s, a: s + F.abs(a))
    first = F.coalesce(F.abs(F.get(outer, F.lit(0))), F.lit(0.0))  # a hole is taken off whichever way it turns
    return met.withColumn("area", 2 * first - size).where("area > 0").drop("parts", "bx", "by")


def landuse_areas(tiles: DataFrame, landuse: DataFrame, bin_size: float = 1000.0) -> DataFrame:
    """(grid_id, category, area): square metres of each category's polygons in each tile."""
    return tile_pieces(tiles, landuse, bin_size).groupBy("grid_id", "category").agg(F.sum("area").alias("area"))


def _lattice(e: Column, n: Column, origin: tuple[int, int]) -> list[Column]:
    x, y = e * grid.TILE, n * grid.TILE
    own = grid.pack(e - origin[0] // grid.TILE, n - origin[1] // grid.TILE)
    return [own.alias("grid_id"), grid.origin(F.lit(origin[0]), F.lit(origin[1])).alias("origin"), (x + grid.TILE / 2).cast("double").alias("tile_x"), (y + grid.TILE / 2).cast("double").alias("tile_y")]


def _row_of(n: Column) -> Column:
    return (n + 0.5) * grid.TILE


def _columns(low: Column, high: Column) -> Column:
    """The columns of tiles whose centroids lie from ``low`` to ``high``; none where there is none."""
    first, last = F.ceil(low / grid.TILE - 0.5), F.floor(high / grid.TILE - 0.5)
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))


def _inner(shapes: DataFrame, key: list[str]) -> DataFrame:
    """(key, e, n): tiles whose centroids are inside, row by row: between a row's odd crossings of sides and the next even ones."""
    sides = _sides(shapes, key)
    a, b = F.col("_side.a"), F.col("_side.b")
    low, high = F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"])
    first, last = F.ceil(low / grid.TILE - 0.5), F.ceil(high / grid.TILE - 0.5) - 1  # of two sides that meet on a row's line one counts
    rows = sides.where(first <= last).withColumn("n", F.explode(F.sequence(first, last)))
    x = a["x"] + (b["x"] - a["x"]) * (_row_of(F.col("n")) - a["y"]) / (b["y"] - a["y"])
    crossed = rows.groupBy(*key, "n").agg(F.array_sort(F.collect_list(x)).alias("x"))
    pairs = F.filter(F.transform("x", lambda v, i: F.when(i % 2 == 1, _columns(F.get("x", i - 1), v))), lambda c: c.isNotNull())
    return crossed.select(*key, F.explode(F.flatten(pairs)).alias("e"), "n").distinct()


def _around(lines: DataFrame, key: list[str], reach: Column) -> DataFrame:
    """(key, e, n): tiles whose centroids are within ``reach`` of one of the segments ``_side`` (a, b): on each row of tiles a span, as
    what is within a distance of a segment is convex.
    """
    d, a, b = F.col("_reach"), F.col("_side.a"), F.col("_side.b")
    rows = lines.withColumn("_reach", reach.cast("double")).where("_reach > 0")
    first, last = F.ceil((F.least(a["y"], b["y"]) - d) / grid.TILE - 0.5), F.floor((F.greatest(a["y"], b["y"]) + d) / grid.TILE - 0.5)
    rows = rows.where(first <= last).withColumn("n", F.explode(F.sequence(first, last)))
    y = _row_of(F.col("n"))
    length = F.sqrt(F.pow(b["x"] - a["x"], 2) + F.pow(b["y"] - a["y"], 2))
    ox, oy = F.coalesce(F.try_divide(-(b["y"] - a["y"]) * d, length), F.lit(0.0)), F.coalesce(F.try_divide((b["x"] - a["x"]) * d, length), F.lit(0.0))
    corner = lambda p, sign: (p["x"] + sign * ox, p["y"] + sign * oy)
    corners = [corner(a, 1), corner(b, 1), corner(b, -1), corner(a, -1)]
    at = []
    for p in (a, b):  # the ends' circles
        half = F.sqrt(F.pow(d, 2) - F.pow(y - p["y"], 2))
        at += [F.when(F.abs(y - p["y"]) <= d, p["x"] - half), F.when(F.abs(y - p["y"]) <= d, p["x"] + half)]
    for (px, py), (qx, qy) in zip(corners, corners[1:] + corners[:1]):  # the strip between them
        at.append(F.when((F.least(py, qy) <= y) & (y <= F.greatest(py, qy)), px + (qx - px) * F.coalesce(F.try_divide(y - py, qy - py), F.lit(0.0))))
    spans = rows.withColumn("_at", F.array_compact(F.array(*at))).where(F.size("_at") > 0)
    return spans.select(*key, F.explode(_columns(F.array_min("_at"), F.array_max("_at"))).alias("e"), "n").distinct()


def _sides(shapes: DataFrame, key: list[str]) -> DataFrame:
    return shapes.select(*key, F.explode(F.flatten(F.transform(rings(shapes), polygons.edges))).alias("_side"))


def cover(shapes: DataFrame, key: list[str], origin: tuple[int, int], by: str = "centroids", buffer: float = 0.0) -> DataFrame:
    """(key, grid_id, origin, tile_x, tile_y): the tiles of a lattice that cover polygons, made where they are used.

    ``centroids``: those whose centroid lies inside, or within ``buffer`` metres of the polygon. ``tiles``: those that share a
    point with it: their centroid is inside, or a side passes them. Polygons are in the plane; rows that share a key are one.
    """
    found = _inner(shapes, key)
    if by == "tiles":
        if buffer:
            raise ValueError("a buffer goes with centroids")
        walked = _sides(shapes, key).select(*key, F.explode(polygons.rows_met(F.col("_side"), float(grid.TILE))).alias("_tile"))
        found = found.unionByName(walked.select(*key, "_tile.e", "_tile.n")).distinct()
    elif buffer:
        found = found.unionByName(_around(_sides(shapes, key), key, F.lit(buffer))).distinct()
    return found.select(*key, *_lattice(F.col("e"), F.col("n"), origin))


def reach_of(category: Column, widths: Mapping[str, float]) -> Column:
    """Metres by category; a category that isn't there has that of ``unknown``, or none."""
    out = F.lit(float(widths.get("unknown", 0.0)))
    for k, v in widths.items():
        out = F.when(category == k, float(v)).otherwise(out)
    return out


def near_lines(tiles: DataFrame, lines: DataFrame, widths: Mapping[str, float]) -> DataFrame:
    """(grid_id, category): tiles whose centroid lies within the category's width of a line (category, line: array of points).

    Lines are cut to segments and these to rows of tiles. A category of width 0 is left out.
    """
    pieces = lines.select("category", F.explode(polygons.path(F.col("line").cast(polygons.RING))).alias("_side"))
    met = _around(pieces, ["category"], reach_of(F.col("category"), widths))
    t = tiles.select("grid_id", F.floor(F.col("tile_x") / grid.TILE).alias("e"), F.floor(F.col("tile_y") / grid.TILE).alias("n"))
    return t.join(met, ["e", "n"]).select("grid_id", "category")


def overlay(tiles: DataFrame, layers: DataFrame, default: str = "open_area", bin_size: float = 1000.0) -> DataFrame:
    """(grid_id, category, area): each tile's area dealt out, every point to the layer of least ``priority`` that covers it.

    ``layers``: category, priority (one category each) and polygons. What no layer covers is ``default``, so a tile's areas sum to
    the tile's. A tile is swept exactly: between the heights at which sides begin, end or cross one another, sides run straight and
    in one order, so widths on the line midway times the height are areas.
    """
    side = float(grid.TILE)
    pieces = tile_pieces(tiles, layers.withColumn("_id", F.monotonically_increasing_id()), bin_size)
    left, low = F.col("tile_x") - side / 2, F.col("tile_y") - side / 2
    edge = F.explode(F.flatten(F.transform("pieces", polygons.edges)))
    s = pieces.select("grid_id", left.alias("left"), low.alias("low"), "priority", "_id", edge.alias("s")).select(
        "grid_id", "left", "low", "priority", "_id", *[(F.col(f"s.{p}.{c}") - F.col(o)).alias(f"{p}{c}") for p in "ab" for c, o in (("x", "left"), ("y", "low"))]
    )  # from the tile's corner, so that sums keep their digits
    s = cut(s.where("ay <> by"))
    other = s.select("grid_id", *[F.col(c).alias(f"o{c}") for c in ("ax", "ay", "bx", "by")])
    met = s.join(other, "grid_id").where((F.least("ay", "by") < F.greatest("oay", "oby")) & (F.least("oay", "oby") < F.greatest("ay", "by")))
    slope = lambda p: (F.col(f"{p}bx") - F.col(f"{p}ax")) / (F.col(f"{p}by") - F.col(f"{p}ay"))
    y = F.col("ay") + F.try_divide(F.col("oax") + (F.col("ay") - F.col("oay")) * slope("o") - F.col("ax"), slope("") - slope("o"))
    inside = (y > F.least("ay", "by")) & (y < F.greatest("ay", "by")) & (y > F.least("oay", "oby")) & (y < F.greatest("oay", "oby"))
    breaks = s.select("grid_id", F.explode(F.array("ay", "by")).alias("y")).unionByName(met.select("grid_id", y.alias("y")).where(inside)).distinct()
    slabs = breaks.withColumn("top", F.lead("y").over(Window.partitionBy("grid_id").orderBy("y"))).where("top > y").withColumnRenamed("y", "base")
    mid = (F.col("base") + F.col("top")) / 2
    on = s.join(slabs, "grid_id").where((F.least("ay", "by") <= F.col("base")) & (F.greatest("ay", "by") >= F.col("top")))
    crossed = on.groupBy("grid_id", "base", "top", "priority", "_id").agg(F.array_sort(F.collect_list(F.col("ax") + (mid - F.col("ay")) * slope(""))).alias("x"))
    spans = F.filter(F.transform("x", lambda v, i: F.when(i % 2 == 1, F.struct(F.get("x", i - 1).alias("x"), v.alias("end")))), lambda p: p.isNotNull())
    span = crossed.select("grid_id", "base", "top", "priority", F.explode(spans).alias("p"))
    ends = span.select("grid_id", "base", "top", "priority", F.explode(F.array(F.struct(F.col("p.x").alias("x"), F.lit(1).alias("d")), F.struct(F.col("p.end").alias("x"), F.lit(-1).alias("d")))).alias("t"))
    ends = ends.groupBy("grid_id", "base", "top", F.col("t.x").alias("x"), "priority").agg(F.sum("t.d").alias("d"))
    row = Window.partitionBy("grid_id", "base").orderBy("x")
    ranks = [r[0] for r in layers.select("priority").distinct().orderBy("priority").collect()]  # a value for each category
    at = ends.groupBy("grid_id", "base", "top", "x").agg(*[F.sum(F.when(F.col("priority") == p, F.col("d")).otherwise(0)).alias(f"p{i}") for i, p in enumerate(ranks)])
    swept = at.withColumn("width", F.lead("x").over(row) - F.col("x")).withColumns({f"p{i}": F.sum(f"p{i}").over(row) for i in range(len(ranks))})
    over = F.lit(None)
    for i in reversed(range(len(ranks))):
        over = F.when(F.col(f"p{i}") > 0, ranks[i]).otherwise(over)
    won = swept.withColumn("priority", over).where("priority is not null and width > 0").groupBy("grid_id", "priority").agg(F.sum(F.col("width") * (F.col("top") - F.col("base"))).alias("area"))
    names = layers.select("priority", "category").distinct()
    dealt = won.join(names, "priority").groupBy("grid_id", "category").agg(F.sum("area").alias("area"))
    rest = tiles.select("grid_id").join(dealt.groupBy("grid_id").agg(F.sum("area").alias("used")), "grid_id", "left")
    rest = rest.select("grid_id", F.lit(default).alias("category"), (F.lit(side * side) - F.coalesce("used", F.lit(0.0))).alias("area")).where("area > 1e-6")
    return dealt.unionByName(rest).groupBy("grid_id", "category").agg(F.sum("area").alias("area"))


def outlines(tiles: DataFrame, key: str, most: int = 40) -> DataFrame:
    """(key, ring, area): the outlines of sets of tiles (key, tile_x, tile_y) as rings of corners; a hole's area is negative.

    Sides that two tiles of a set share cancel out. What is left is joined to straight runs, and each run is linked to the one
    that begins where it ends (where two do, as tiles touch at a corner, to the one on the left, which keeps rings simple).
    Rings are found by doubling: every run learns the least run within 2, 4, 8... of itself until nothing changes, then in the
    same way how far it is from the end of its ring; so rounds grow with the logarithm of the longest ring. A round is a table.
    """
    t = tiles.select(F.col(key).alias("z"), F.floor(F.col("tile_x") / grid.TILE).alias("e"), F.floor(F.col("tile_y") / grid.TILE).alias("n")).distinct()
    e, n = F.col("e"), F.col("n")
    unit = lambda way, axis, line, at: F.struct(F.lit(way).alias("way"), F.lit(axis).alias("axis"), line.alias("line"), at.alias("at"))
    sides = t.select("z", F.explode(F.array(unit(1, "x", n, e), unit(1, "y", e + 1, n), unit(-1, "x", n + 1, e), unit(-1, "y", e, n))).alias("s")).select("z", "s.*")
    alone = sides.groupBy("z", "axis", "line", "at").agg(F.count("*").alias("c"), F.first("way").alias("way")).where("c = 1")
    run = F.col("at") - F.row_number().over(Window.partitionBy("z", "axis", "line", "way").orderBy("at"))
    runs = alone.withColumn("run", run).groupBy("z", "axis", "line", "way", "run").agg(F.min("at").alias("low"), (F.max("at") + 1).alias("high"))
    ahead = F.col("way") == 1
    begin, end = F.when(ahead, F.col("low")).otherwise(F.col("high")), F.when(ahead, F.col("high")).otherwise(F.col("low"))
    flat = F.col("axis") == "x"
    corner = lambda v: (F.when(flat, v).otherwise(F.col("line")), F.when(flat, F.col("line")).otherwise(v))
    (bx, by), (ex, ey) = corner(begin), corner(end)
    runs = cut(runs.select("z", "axis", "way", bx.alias("bx"), by.alias("by"), ex.alias("ex"), ey.alias("ey")).withColumn("id", F.monotonically_increasing_id()))
    after = runs.select("z", F.col("axis").alias("next_axis"), F.col("way").alias("next_way"), F.col("bx").alias("ex"), F.col("by").alias("ey"), F.col("id").alias("next"))
    left = F.when(flat, F.col("next_way") == F.col("way")).otherwise(F.col("next_way") == -F.col("way"))
    linked = runs.join(after, ["z", "ex", "ey"]).where(F.col("axis") != F.col("next_axis"))
    linked = cut(linked.groupBy("id").agg(F.max_by("next", F.struct(left.alias("left"), "next")).alias("next")))

    def doubled(state: DataFrame, value: Column) -> DataFrame:
        """Each run's pointer and value joined to those of the run that it points to."""
        for _ in range(most):
            there = state.select(F.col("id").alias("to"), F.col("next").alias("far"), F.col("v").alias("w"))
            new = cut(state.join(there, F.col("next") == F.col("to"), "left").select("id", F.col("far").alias("next"), value.alias("v"), (~value.eqNullSafe(F.col("v"))).alias("changed")))
            state = new.select("id", "next", "v")
            if new.where("changed").isEmpty():
                return state
        raise RuntimeError(f"outlines did not settle in {most} rounds")

    rounds = doubled(linked.select("id", "next", F.col("id").alias("v")), F.least("v", "w"))
    home = rounds.select("id", F.col("v").alias("home"))
    line = linked.join(home, "id").select("id", F.when(F.col("next") != F.col("home"), F.col("next")).alias("next"), F.lit(1).cast("long").alias("v"))
    place = doubled(cut(line), F.col("v") + F.coalesce("w", F.lit(0).cast("long"))).select("id", F.col("v").alias("left"))
    spot = F.struct(-F.col("left"), polygons.point(F.col("bx") * grid.TILE, F.col("by") * grid.TILE).alias("p"))
    made = runs.join(home, "id").join(place, "id").groupBy("z", "home").agg(F.transform(F.array_sort(F.collect_list(spot)), lambda s: s["p"]).alias("ring"))
    return made.select(F.col("z").alias(key), "ring", polygons.signed_area(F.col("ring")).alias("area"))
