"""The 100 m lattice: packed tile ids, INSPIRE names, coarser and finer resolutions, quadkeys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TILE = 100


def pack(easting_index: Column, northing_index: Column) -> Column:
    """32-bit id: easting index in the high half, northing index in the low; unsigned, so it may read negative."""
    return F.shiftleft(easting_index.cast("int"), 16).bitwiseOR(northing_index.cast("int"))


def origin(easting: Column, northing: Column) -> Column:
    """64-bit id of the point that indices count from."""
    return F.shiftleft((easting / TILE).cast("long"), 32) + (northing / TILE).cast("long")


def easting_index(grid_id: Column) -> Column:
    return F.shiftrightunsigned(grid_id, 16)


def northing_index(grid_id: Column) -> Column:
    return grid_id.bitwiseAND(0xFFFF)


def origin_easting(origin_id: Column) -> Column:
    return F.shiftright(origin_id, 32) * TILE


def origin_northing(origin_id: Column) -> Column:
    return origin_id.bitwiseAND(0xFFFFFFFF) * TILE


def centroid(grid_id: Column, origin_id: Column) -> tuple[Column, Column]:
    half = TILE / 2
    return origin_easting(origin_id) + easting_index(grid_id) * TILE + half, origin_northing(origin_id) + northing_index(grid_id) * TILE + half


def tile_bounds(grid_id: Column, origin_id: Column, factor: int = 1) -> Column:
    """Struct (x0, y0, x1, y1) of a tile that is ``factor`` base tiles wide."""
    x, y = origin_easting(origin_id) + easting_index(grid_id) * TILE, origin_northing(origin_id) + northing_index(grid_id) * TILE
    return F.struct(x.alias("x0"), y.alias("y0"), (x + TILE * factor).alias("x1"), (y + TILE * factor).alias("y1"))


def coarsen(grid_id: Column, factor: int) -> Column:
    """The id of the lower left base tile of the coarser tile that holds this one."""
    floor = lambda c: c - c % factor
    return pack(floor(easting_index(grid_id)), floor(northing_index(grid_id)))


def refine(df: DataFrame, factor: int, column: str = "grid_id", into: str = "grid_id") -> DataFrame:
    """One row for each of the ``factor``**2 base tiles of a coarser tile."""
    steps = F.array(*[F.struct(F.lit(e).alias("e"), F.lit(n).alias("n")) for e in range(factor) for n in range(factor)])
    return (
        df.withColumn("_step", F.explode(steps))
        .withColumn(into, pack(easting_index(F.col(column)) + F.col("_step.e"), northing_index(F.col(column)) + F.col("_step.n")))
        .drop("_step")
    )


def inspire_id(grid_id: Column, origin_id: Column, resolution: int = 100) -> Column:
    """100mN{n}E{e} or 1kmN{n}E{e}: the tile's lower left corner in units of its size."""
    if resolution not in (100, 1000):
        raise ValueError("resolution is 100 or 1000 metres")
    n = F.floor((origin_northing(origin_id) + northing_index(grid_id) * TILE) / resolution)
    e = F.floor((origin_easting(origin_id) + easting_index(grid_id) * TILE) / resolution)
    return F.concat(F.lit("100mN" if resolution == 100 else "1kmN"), n.cast("string"), F.lit("E"), e.cast("string"))


def inspire_bounds(name: Column) -> Column:
    """Struct (x0, y0, x1, y1) of an INSPIRE name."""
    size = F.when(name.startswith("1km"), 1000).otherwise(100)
    x = F.regexp_extract(name, r"E(\d+)", 1).cast("long") * size
    y = F.regexp_extract(name, r"N(\d+)", 1).cast("long") * size
    return F.struct(x.alias("x0"), y.alias("y0"), (x + size).alias("x1"), (y + size).alias("y1"))


def inspire_centroid(name: Column) -> tuple[Column, Column]:
    b = inspire_bounds(name)
    return (b["x0"] + b["x1"]) / 2, (b["y0"] + b["y1"]) / 2


def quadkey(lat: Column, lon: Column, zoom: int) -> Column:
    """Base-4 name of the Web Mercator tile at ``zoom``."""
    limit, n = 85.05112878, 2**zoom
    s = F.sin(F.radians(F.greatest(F.least(lat, F.lit(limit)), F.lit(-limit))))
    clip = lambda v: F.greatest(F.lit(0), F.least(F.floor(v).cast("int"), F.lit(n - 1)))
    return quadkey_of(clip((lon + 180) / 360 * n), clip((0.5 - F.ln((1 + s) / (1 - s)) / (4 * 3.141592653589793)) * n), zoom)


def quadkey_of(x: Column, y: Column, zoom: int) -> Column:
    """Digits from the highest bit: 1 for x, 2 for y."""
    bit = lambda v, i: F.shiftright(v, i).bitwiseAND(1)
    return F.concat(*[(bit(x, i) + 2 * bit(y, i)).cast("string") for i in range(zoom - 1, -1, -1)]) if zoom else F.lit("")


def quadkey_tile(key: Column) -> Column:
    """Struct (x, y, zoom) of a quadkey."""
    digits = F.transform(F.filter(F.split(key, ""), lambda c: c != ""), lambda c: c.cast("int"))
    fold = lambda mask: F.aggregate(digits, F.lit(0), lambda a, d: a * 2 + F.when(d.bitwiseAND(mask) > 0, 1).otherwise(0))
    return F.struct(fold(1).alias("x"), fold(2).alias("y"), F.length(key).alias("zoom"))


def quadkey_extent(key: Column) -> Column:
    """Struct (lon_min, lat_min, lon_max, lat_max) of a quadkey."""
    t = quadkey_tile(key)
    n = F.pow(F.lit(2.0), t["zoom"])
    lon = lambda x: x / n * 360 - 180
    lat = lambda y: F.degrees(F.atan(F.sinh(3.141592653589793 * (1 - 2 * y / n))))
    return F.struct(lon(t["x"]).alias("lon_min"), lat(t["y"] + 1).alias("lat_min"), lon(t["x"] + 1).alias("lon_max"), lat(t["y"]).alias("lat_max"))


def quadkey_children(df: DataFrame, levels: int, column: str = "quadkey") -> DataFrame:
    """One row for each descendant ``levels`` below."""
    out = df
    for _ in range(levels):
        out = out.withColumn(column, F.explode(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda d: F.concat(F.col(column), d.cast("string")))))
    return out


def quadkeys_of_box(df: DataFrame, zoom: int, box: str = "box") -> DataFrame:
    """One row for each quadkey that meets the struct (lon_min, lat_min, lon_max, lat_max)."""
    low = quadkey_tile(quadkey(F.col(f"{box}.lat_max"), F.col(f"{box}.lon_min"), zoom))
    high = quadkey_tile(quadkey(F.col(f"{box}.lat_min"), F.col(f"{box}.lon_max"), zoom))
    span = df.withColumns({"_low": low, "_high": high}).withColumn("_x", F.explode(F.sequence("_low.x", "_high.x"))).withColumn("_y", F.explode(F.sequence("_low.y", "_high.y")))
    return span.withColumn("quadkey", quadkey_of(F.col("_x"), F.col("_y"), zoom)).drop("_low", "_high", "_x", "_y")


def user_bucket(hex_id: Column, buckets: int, digits: int = 14) -> Column:
    """The bucket of a user: leading hex digits of the id, modulo."""
    return (F.conv(F.substring(hex_id, 1, digits), 16, 10).cast("long") % buckets).cast("int")
