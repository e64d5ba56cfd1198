"""Signal model and network coverage on the tile lattice."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions import polygons
from ..functions.geo import planar
from ..functions.hulls import boxed, within
from ..plans.iterate import cut
from ..plans.joins import boxes_near, lattice_range_join

# Physical properties by cell type where a cell states none.
DEFAULTS: Mapping[str, Mapping[str, float]] = {
    "macrocell": {"power": 10, "range": 10000, "path_loss_exponent": 3.75, "antenna_height": 30, "elevation_angle": 5, "vertical_beam_width": 9, "horizontal_beam_width": 65, "azimuth_back_loss": -30, "elevation_back_loss": -30},
    "microcell": {"power": 5, "range": 1000, "path_loss_exponent": 6.0, "antenna_height": 8, "elevation_angle": 5, "vertical_beam_width": 9, "horizontal_beam_width": 65, "azimuth_back_loss": -30, "elevation_back_loss": -30},
    "default": {"power": 5, "range": 5000, "path_loss_exponent": 3.75, "antenna_height": 8, "elevation_angle": 5, "vertical_beam_width": 9, "horizontal_beam_width": 65, "azimuth_back_loss": -30, "elevation_back_loss": -30},
}


@dataclass(frozen=True)
class Params:
    steepness: float = 0.2
    midpoint: float = -92.5
    min_dominance: float = 0.01
    best_percent: float = 90.0
    cells_per_tile: int = 10
    bin_size: float = 1000.0
    line_buffer: float = 50.0
    defaults: Mapping[str, Mapping[str, float]] = field(default_factory=lambda: DEFAULTS)


def impute_defaults(cells: DataFrame, defaults: Mapping[str, Mapping[str, float]] = DEFAULTS) -> DataFrame:
    """Nulls and absent properties from the cell type's defaults; unknown types count as ``default``."""
    names = sorted({k for d in defaults.values() for k in d})
    kind = F.when(F.col("cell_type").isin(*[k for k in defaults if k != "default"]), F.col("cell_type")).otherwise("default")

    def of(name: str) -> Column:
        out = F.lit(float(defaults["default"][name]))
        for k, d in defaults.items():
            out = F.when(kind == k, float(d[name])).otherwise(out)
        return out

    return cells.withColumns({n: F.coalesce(F.col(n).cast("double"), of(n)) if n in cells.columns else of(n) for n in names})


def watt_to_dbm(power: Column) -> Column:
    return 10 * F.log10(power) + 30


def cell_height(use_elevation: bool = False) -> Column:
    return F.coalesce("altitude", F.lit(0.0)) + F.col("antenna_height") if use_elevation else F.col("antenna_height")


def place_cells(cells: DataFrame, use_elevation: bool = False) -> DataFrame:
    """``cells`` with ``cell_z``: the antenna's height, over the ground's altitude where asked."""
    return cells.withColumn("cell_z", cell_height(use_elevation).cast("double"))


def place_tiles(tiles: DataFrame, use_elevation: bool = False) -> DataFrame:
    """``tiles`` with ``tile_z``: their elevation where asked and known, else 0."""
    return tiles.withColumn("tile_z", F.coalesce(F.col("elevation").cast("double"), F.lit(0.0)) if use_elevation else F.lit(0.0))


def normal_density(x: Column | float, sd: Column) -> Column:
    x = x if isinstance(x, Column) else F.lit(float(x))
    return F.exp(-0.5 * F.pow(x / sd, 2)) / (math.sqrt(2 * math.pi) * sd)


def angular_loss(angle: Column, sd: Column, back_loss: Column) -> Column:
    """dB at ``angle`` off the main direction: 0 on it, ``back_loss`` opposite, a normal curve between."""
    a = F.pmod(angle + 180, F.lit(360.0)) - 180
    front, back = normal_density(0, sd), normal_density(180, sd)
    return (normal_density(a, sd) - front) * -back_loss / (front - back)


def beam_table(spark: SparkSession, back_losses: list[float], steps: int = 1000, points: int = 720) -> DataFrame:
    """(beam_degree, back_loss, sd): for each half beam width of 1 to 180 degrees the curve that loses 3 dB there.

    Bounded by 180 rows for each back loss that the network uses, so it is made on the driver.
    """
    angles, rows = np.linspace(0, 180, points), []
    for loss in back_losses:
        sds = np.arange(1, steps) * 180 / steps
        density = np.exp(-0.5 * (angles[None, :] / sds[:, None]) ** 2) / (math.sqrt(2 * math.pi) * sds[:, None])
        with np.errstate(invalid="ignore", divide="ignore"):
            db = (density - density[:, :1]) * -loss / (density[:, :1] - density[:, -1:])
        three = angles[np.nanargmin(np.abs(-3 - np.where(np.isfinite(db), db, np.inf)), axis=1)]
        rows += [(d, float(loss), float(sds[int(np.argmin(np.abs(three - d)))])) for d in range(1, 181)]
    return spark.createDataFrame(rows, "beam_degree int, back_loss double, sd double")


def with_beam_sd(cells: DataFrame, table: DataFrame, width: str, loss: str, into: str) -> DataFrame:
    """The nearest whole half beam width's curve; halves go down, as the first of equals."""
    half = F.greatest(F.lit(1), F.least(F.lit(180), F.ceil(F.col(width) / 2 - 0.5))).cast("int")
    own = table.select(F.col("beam_degree").alias("_deg"), F.col("back_loss").alias("_loss"), F.col("sd").alias(into))
    return cells.join(F.broadcast(own), (half == F.col("_deg")) & (F.col(loss) == F.col("_loss")), "left").drop("_deg", "_loss")  # 180 rows a back loss


def tiles_in_range(cells: DataFrame, tiles: DataFrame, params: Params = Params()) -> DataFrame:
    """Tiles whose centroid lies within a cell's range, with planar and spatial distance.

    ``cells``: cell_x, cell_y, cell_z, range ...; ``tiles``: tile_x, tile_y, tile_z, grid_id.
    """
    pairs = lattice_range_join(cells, tiles, F.col("range"), params.bin_size, "cell_x", "cell_y", "tile_x", "tile_y")
    return pairs.withColumn("distance_3d", planar(F.col("cell_x"), F.col("cell_y"), F.col("tile_x"), F.col("tile_y"), F.col("cell_z"), F.col("tile_z")))


def signal_strength(pairs: DataFrame) -> DataFrame:
    """Power in dBm less the path loss, ``n * 10 * log10(distance)``."""
    return pairs.withColumn("signal_strength", watt_to_dbm(F.col("power")) - F.col("path_loss_exponent") * 10 * F.log10("distance_3d"))


def azimuth_loss(pairs: DataFrame) -> DataFrame:
    """Loss off the azimuth: the way to the tile, turned by the antenna's tilt, is measured against the boresight."""
    bearing = F.degrees(F.atan2(F.col("tile_x") - F.col("cell_x"), F.col("tile_y") - F.col("cell_y")))
    turn, tilt = F.radians(bearing - F.col("azimuth_angle")), F.radians(F.col("elevation_angle"))
    ahead, aside, below = F.cos(turn) * F.col("distance"), F.sin(turn) * F.col("distance"), F.col("cell_z") - F.col("tile_z")
    boresight = ahead * F.cos(tilt) + below * F.sin(tilt)
    loss = angular_loss(F.degrees(F.atan2(aside, boresight)), F.col("sd_azimuth"), F.col("azimuth_back_loss"))
    return pairs.withColumn("signal_strength", F.col("signal_strength") + F.when(F.col("directionality") == 1, loss).otherwise(0.0))


def elevation_loss(pairs: DataFrame) -> DataFrame:
    """Loss off the antenna's tilt."""
    down = F.degrees(F.atan2(F.col("cell_z") - F.col("tile_z"), F.col("distance")))
    loss = angular_loss(down - F.col("elevation_angle"), F.col("sd_elevation"), F.col("elevation_back_loss"))
    return pairs.withColumn("signal_strength", F.col("signal_strength") + F.when(F.col("directionality") == 1, loss).otherwise(0.0))


def dominance(pairs: DataFrame, params: Params = Params(), azimuth: bool = False, elevation: bool = False) -> DataFrame:
    """``signal_dominance`` by a logistic curve of the signal strength; directional and omni cells in one pass."""
    out = signal_strength(pairs)
    out = azimuth_loss(out) if azimuth else out
    out = elevation_loss(out) if elevation else out
    return out.withColumn("signal_dominance", 1 / (1 + F.exp(-(F.col("signal_strength") - params.midpoint) * params.steepness)))


def effective_coverage(pairs: DataFrame, params: Params = Params()) -> DataFrame:
    """(cell_id, centre_x, centre_y, effective_range) from the dominance of the tiles along each cell's range lines.

    On each line (the boresight and its opposite; for an omni cell the east) the farthest tile over the dominance
    threshold counts, or the nearest where none is. A directional cell's centre is midway between its two.
    """
    dx, dy = F.col("tile_x") - F.col("cell_x"), F.col("tile_y") - F.col("cell_y")
    azimuth = F.radians(F.when(F.col("directionality") == 1, F.col("azimuth_angle")).otherwise(90.0))
    along, across = dx * F.sin(azimuth) + dy * F.cos(azimuth), F.abs(dx * F.cos(azimuth) - dy * F.sin(azimuth))
    end = F.when((along >= 0) | (F.col("directionality") == 0), "front").otherwise("back")
    line = pairs.withColumns({"_along": along, "_across": across, "_end": end}).where((F.col("_across") <= params.line_buffer) & ((F.col("directionality") == 1) | (F.col("_along") >= 0)))
    over = F.when(F.col("signal_dominance") > params.min_dominance, F.struct(F.col("distance"), -F.col("grid_id")))
    points = line.groupBy("cell_id", "directionality", "cell_x", "cell_y", "_end").agg(
        F.max_by(F.struct("tile_x", "tile_y"), over).alias("far"), F.min_by(F.struct("tile_x", "tile_y"), F.struct("distance", "grid_id")).alias("near")
    )
    points = points.withColumn("p", F.coalesce("far", "near"))
    ends = points.groupBy("cell_id", "directionality", "cell_x", "cell_y").agg(F.max(F.when(F.col("_end") == "front", F.col("p"))).alias("front"), F.max(F.when(F.col("_end") == "back", F.col("p"))).alias("back"))
    other = F.coalesce("back", F.struct(F.col("cell_x").alias("tile_x"), F.col("cell_y").alias("tile_y")))
    omni = F.col("directionality") == 0
    x = F.when(omni, F.col("cell_x")).otherwise((F.col("front.tile_x") + other["tile_x"]) / 2)
    y = F.when(omni, F.col("cell_y")).otherwise((F.col("front.tile_y") + other["tile_y"]) / 2)
    out = ends.where("front is not null").withColumns({"centre_x": x, "centre_y": y})
    return out.select("cell_id", "centre_x", "centre_y", planar(F.col("centre_x"), F.col("centre_y"), F.col("front.tile_x"), F.col("front.tile_y")).alias("effective_range"))


def prune_small(pairs: DataFrame, params: Params = Params()) -> DataFrame:
    return pairs.where(F.col("signal_dominance") > params.min_dominance)


def prune_top(pairs: DataFrame, params: Params = Params(), by: tuple[str, ...] = ()) -> DataFrame:
    """The strongest cells of each tile; ties by cell id."""
    w = Window.partitionBy(*by, "grid_id").orderBy(F.desc("signal_dominance"), "cell_id")
    return pairs.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= params.cells_per_tile).drop("_rank")


def prune_share_of_best(pairs: DataFrame, params: Params = Params(), by: tuple[str, ...] = ()) -> DataFrame:
    """Cells of at least the given share of the tile's best; the best stays."""
    best = F.max("signal_dominance").over(Window.partitionBy(*by, "grid_id"))
    return pairs.withColumn("_best", best).where(F.col("signal_dominance") * 100 >= F.col("_best") * params.best_percent).drop("_best")


def footprint_groups(footprint: DataFrame) -> DataFrame:
    """(group_id, cells, grid_ids): tiles that the same set of cells covers; the id is the md5 of the tiles, sorted and comma-joined."""
    sets = footprint.groupBy("grid_id").agg(F.array_sort(F.collect_set("cell_id")).alias("cells"))
    groups = sets.groupBy("cells").agg(F.array_sort(F.collect_list("grid_id")).alias("grid_ids"))
    return groups.withColumn("group_id", F.md5(F.array_join("grid_ids", ",").cast("binary")))


def group_tiles(groups: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(group_id, grid_id) of the groups that ``known`` lacks."""
    new = groups if known is None else groups.join(known.select("group_id").distinct().hint("merge"), "group_id", "left_anti")
    return new.select("group_id", F.explode("grid_ids").alias("grid_id"))


def cell_groups(groups: DataFrame) -> DataFrame:
    return groups.select(F.explode("cells").alias("cell_id"), "group_id").distinct()


def connection_probability(footprint: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The share of a cell in its tile's dominance."""
    total = F.sum("signal_dominance").over(Window.partitionBy(*by, "grid_id"))
    return footprint.withColumn("cell_connection_probability", F.try_divide(F.col("signal_dominance"), total))


def posterior_probability(connection: DataFrame, prior: DataFrame | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Probability of the tile given the cell, by a uniform prior or one (grid_id, prior); nothing over nothing is 0."""
    df = connection.withColumn("prior", F.lit(1.0)) if prior is None else connection.join(prior.select("grid_id", "prior").hint("merge"), "grid_id", "left")
    joint = F.col("cell_connection_probability") * F.coalesce("prior", F.lit(0.0))
    total = F.sum(joint).over(Window.partitionBy(*by, "cell_id"))
    return df.withColumn("posterior_probability", F.coalesce(F.try_divide(joint, total), F.lit(0.0))).drop("prior")


def landuse_prior(enriched: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """(grid_id, prior) from the tile's area ratios by land use, weighted and scaled to 1 over all tiles."""
    ratio = F.aggregate(F.map_entries("landuse_area_ratios"), F.lit(0.0), lambda a, e: a + e["value"] * _lookup(e["key"], weights))
    tiles = enriched.select("grid_id", F.coalesce(ratio, F.lit(0.0)).alias("w"))
    total = tiles.agg(F.sum("w").alias("total"))
    return tiles.crossJoin(F.broadcast(total)).select("grid_id", F.coalesce(F.try_divide("w", "total"), F.lit(0.0)).alias("prior"))  # one row


def _lookup(key: Column, values: Mapping[str, float], missing: float = 0.0) -> Column:
    out = F.lit(missing)
    for k, v in values.items():
        out = F.when(key == k, float(v)).otherwise(out)
    return out


def nearby_cells(footprint: DataFrame, tiles: DataFrame, distance: float, by: tuple[str, ...] = ()) -> DataFrame:
    """(cell_id_a, cell_id_b, distance) of cells whose footprints come within ``distance`` metres, by their nearest tiles.

    ``tiles``: grid_id, tile_x, tile_y. Each cell pairs with itself as (cell, null, 0). Tiles meet tiles, each once, and
    only their nearest distance between sets of cells is expanded to the pairs of cells in them.
    """
    held = footprint.groupBy(*by, "grid_id").agg(F.array_sort(F.collect_set("cell_id")).alias("cells"))
    held = held.withColumn("set", F.md5(F.array_join("cells", "\x1f").cast("binary")))
    sets = held.dropDuplicates([*by, "set"])
    placed = held.join(tiles.select("grid_id", "tile_x", "tile_y").hint("merge"), "grid_id")
    a = placed.select(*by, F.col("set").alias("set_a"), F.col("tile_x").alias("x"), F.col("tile_y").alias("y"))
    b = placed.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("set").alias("set_b"), F.col("tile_x").alias("other_x"), F.col("tile_y").alias("other_y"))
    met = lattice_range_join(a, b, distance, max(distance, 100.0))
    for c in by:
        met = met.where(F.col(c) == F.col(f"_{c}"))
    met = met.groupBy(*by, "set_a", "set_b").agg(F.min("distance").alias("distance"))
    for side in "ab":
        met = met.join(sets.select(*by, F.col("set").alias(f"set_{side}"), F.col("cells").alias(f"cells_{side}")).hint("merge"), [*by, f"set_{side}"])
    pairs = met.withColumn("cell_id_a", F.explode("cells_a")).withColumn("cell_id_b", F.explode("cells_b")).where("cell_id_a <> cell_id_b")
    near = pairs.groupBy(*by, "cell_id_a", "cell_id_b").agg(F.min("distance").alias("distance"))
    return near.unionByName(footprint.select(*by, F.col("cell_id").alias("cell_id_a")).distinct().withColumns({"cell_id_b": F.lit(None).cast("string"), "distance": F.lit(0.0)}))


def cell_hulls(footprint: DataFrame, tiles: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(cell_id, hull): the convex hull of the centroids of each cell's tiles.

    Rows of tiles are cut to their two ends first, which a hull is made of, so that a row of a hull is short.
    """
    placed = footprint.select(*by, "cell_id", "grid_id").join(tiles.select("grid_id", "tile_x", "tile_y").hint("merge"), "grid_id")
    ends = placed.groupBy(*by, "cell_id", "tile_y").agg(F.min("tile_x").alias("a"), F.max("tile_x").alias("b"))
    points = F.flatten(F.collect_list(F.array(polygons.point(F.col("a"), F.col("tile_y")), polygons.point(F.col("b"), F.col("tile_y")))))
    return ends.groupBy(*by, "cell_id").agg(points.alias("points")).select(*by, "cell_id", polygons.hull(F.col("points")).alias("hull"))


def nearby_hulls(hulls: DataFrame, distance: float, buffer: float = 0.0, by: tuple[str, ...] = ()) -> DataFrame:
    """(cell_id_a, cell_id_b, distance) of cells whose hulls, widened by ``buffer`` all round, come within ``distance`` metres.

    Hulls meet by their boxes, each pair once; each cell pairs with itself as (cell, null, 0).
    """
    for key, most in (("Records", 10_000), ("Bytes", 16 << 20)):  # of a batch; other operators set them lower
        hulls.sparkSession.conf.set(f"spark.sql.execution.arrow.max{key}PerBatch", str(most))
    named = hulls.select(*by, "cell_id", F.col("hull").cast(polygons.RING).alias("hull"))
    fields = lambda df, **more: StructType([*df.schema, *[StructField(c, t) for c, t in more.items()]])
    sides = {c: DoubleType() for c in ("x0", "y0", "x1", "y1")}
    rows = cut(named.mapInArrow(boxed("hull"), fields(named.withColumn("hull", F.lit(None).cast("binary")), **sides)))  # read by both sides
    met = boxes_near(rows, "cell_id", distance + 2 * buffer, max(distance + 2 * buffer, 500.0), by)
    both = met.select(*by, F.col("a.cell_id").alias("p"), F.col("b.cell_id").alias("q"), F.col("a.hull").alias("a_hull"), F.col("b.hull").alias("b_hull"))
    once = both.mapInArrow(within("a_hull", "b_hull", distance, buffer), fields(both.drop("a_hull", "b_hull"), distance=DoubleType()))
    pair = lambda a, b: F.struct(F.col(a).alias("cell_id_a"), F.col(b).alias("cell_id_b"))
    both = once.select(*by, F.explode(F.array(pair("p", "q"), pair("q", "p"))).alias("pair"), "distance").select(*by, "pair.*", "distance")
    return both.unionByName(rows.select(*by, F.col("cell_id").alias("cell_id_a")).withColumns({"cell_id_b": F.lit(None).cast("string"), "distance": F.lit(0.0)}))


def overlap_groups(pairs: DataFrame, buffer: float, by: tuple[str, ...] = ()) -> DataFrame:
    """(cell_id, overlapping_cell_ids): cells whose buffered footprints meet, sorted; a cell alone has an empty list.

    ``pairs`` hold each cell with itself, as ``nearby_cells`` and ``nearby_hulls`` give them; others too far apart aren't shuffled.
    """
    met = pairs.where(F.col("cell_id_b").isNull() | (F.col("distance") <= 2 * buffer))
    return met.groupBy(*by, F.col("cell_id_a").alias("cell_id")).agg(F.array_sort(F.collect_set("cell_id_b")).alias("overlapping_cell_ids"))


def cell_distances(pairs: DataFrame) -> DataFrame:
    return pairs.where("cell_id_b is not null")
