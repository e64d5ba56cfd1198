"""Usual environment: rules over long-term scores label tiles; labels are then summed by tile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..codes import ID_GRID, ID_OBSERVATION
from ..functions import grid
from ..plans.iterate import cut
from .coverage import _lookup
from .permanence import MidTermParams


@dataclass(frozen=True)
class Rule:
    """A tile is labelled if ``metric`` (lps or total_frequency) in the period reaches ``percent`` of the device's."""

    code: str
    day_type: str
    time_interval: str
    metric: str
    percent: float


# The cascades, in order.
UE_RULES = (Rule("ue_1", "all", "all", "lps", 70), Rule("ue_2", "all", "night_time", "lps", 70), Rule("ue_2", "workdays", "working_hours", "lps", 70), Rule("ue_3", "all", "all", "total_frequency", 70))
HOME_RULES = (Rule("h_1", "all", "all", "lps", 80), Rule("h_2", "all", "night_time", "lps", 80), Rule("h_3", "all", "night_time", "total_frequency", 80))
WORK_RULES = (Rule("w_1", "workdays", "working_hours", "lps", 80), Rule("w_2", "workdays", "working_hours", "total_frequency", 80))


def periods_read(params: MidTermParams, *cascades: Sequence[Rule]) -> MidTermParams:
    """``params`` with only the day types and intervals that the rules read, and the whole period: mid-term scores of others
    needn't be made for labels, and it is they that are expanded to tiles.
    """
    kinds = {"all"} | {r.day_type for c in cascades for r in c}
    names = {"all"} | {r.time_interval for c in cascades for r in c}
    return replace(params, day_types=tuple(t for t in params.day_types if t in kinds), intervals=tuple(i for i in params.intervals if i[0] in names))


def discard_devices(scores: DataFrame, total_ps: int = 2, total_days: int = 1) -> DataFrame:
    """Scores without the devices that were observed too little or on too few days."""
    seen = scores.where((F.col("id_type") == ID_OBSERVATION) & (F.col("day_type") == "all") & (F.col("time_interval") == "all"))
    rare = seen.where((F.col("lps") < total_ps) | (F.col("total_frequency") < total_days)).select("user_id", "season").distinct()
    return scores.join(rare.hint("merge"), ["user_id", "season"], "left_anti")  # what grows with devices is shuffled, however small its file


def cut_at_gap(scores: DataFrame, gap: float, percent: bool) -> DataFrame:
    """Tiles of the whole period by falling lps, up to the first drop of at least ``gap`` (or of that share of the largest)."""
    tiles = scores.where((F.col("id_type") == ID_GRID) & (F.col("day_type") == "all") & (F.col("time_interval") == "all"))
    by = ["user_id", "season"]
    w = Window.partitionBy(*by).orderBy(F.desc("lps"), "location")
    bound = F.max("lps").over(Window.partitionBy(*by)) * (gap / 100) if percent else F.lit(gap)
    drop = F.coalesce(F.lag("lps").over(w) - F.col("lps"), F.lit(0))
    opens = tiles.withColumn("_cut", F.when(drop >= bound, 1).otherwise(0) if not percent else F.when((drop >= bound) & (drop > 0), 1).otherwise(0))
    return opens.withColumn("_cuts", F.sum("_cut").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("_cuts = 0").select(*by, "location", "lps")


def apply_rules(tiles: DataFrame, scores: DataFrame, rules: Sequence[Rule], label: str, stop_at_first: bool, global_stop: bool = False) -> DataFrame:
    """(user_id, season, location, label, label_rule): the first rule that a tile meets.

    ``stop_at_first``: only the first rule that labels anything counts, for each device, or over all (``global_stop``).
    All metrics are pivoted at once and joined once; no rule rereads the scores.
    """
    by = ["user_id", "season"]
    pick = lambda r, agg_of: agg_of(F.when((F.col("day_type") == r.day_type) & (F.col("time_interval") == r.time_interval), F.col(r.metric)))
    own = scores.where(F.col("id_type") == ID_GRID).groupBy(*by, "location").agg(*[pick(r, F.max).alias(f"_own{i}") for i, r in enumerate(rules)])
    total = scores.where(F.col("id_type") == ID_OBSERVATION).groupBy(*by).agg(*[pick(r, F.max).alias(f"_all{i}") for i, r in enumerate(rules)])
    df = tiles.join(own.hint("merge"), [*by, "location"], "left").join(total.hint("merge"), by, "left")
    met = [F.coalesce(F.coalesce(f"_own{i}", F.lit(0)) >= F.col(f"_all{i}") * (r.percent / 100), F.lit(False)) for i, r in enumerate(rules)]
    first: Column = F.lit(None).cast("int")
    for i in reversed(range(len(rules))):
        first = F.when(met[i], i).otherwise(first)
    df = df.withColumn("_rule", first).where("_rule is not null")
    if stop_at_first and global_stop:
        df = df.crossJoin(F.broadcast(df.agg(F.min("_rule").alias("_best")))).where("_rule = _best")  # one row
    elif stop_at_first:
        df = df.withColumn("_best", F.min("_rule").over(Window.partitionBy(*by))).where("_rule = _best")
    code = F.element_at(F.array(*[F.lit(r.code) for r in rules]), F.col("_rule") + 1)
    return df.select(*by, "location", F.lit(label).alias("label"), code.alias("label_rule"))


def label_tiles(scores: DataFrame, total_ps: int = 2, total_days: int = 1, ue_gap: float = 20, home_gap: float = 1, work_gap: float = 1, global_stop: bool = False, cascades: Sequence[Sequence[Rule]] = (UE_RULES, HOME_RULES, WORK_RULES)) -> DataFrame:
    """Usual environment, home and work labels; home and work only within the usual environment."""
    ue_rules, home_rules, work_rules = cascades
    kept = cut(discard_devices(scores, total_ps, total_days))  # read by each label's cut and rules
    ue = cut(apply_rules(cut_at_gap(kept, ue_gap, True), kept, ue_rules, "ue", False))
    inside = ue.select("user_id", "season", "location").hint("merge")
    tiles = lambda gap: cut_at_gap(kept, gap, False).join(inside, ["user_id", "season", "location"])
    home = apply_rules(tiles(home_gap), kept, home_rules, "home", True, global_stop)
    work = apply_rules(tiles(work_gap), kept, work_rules, "work", True, global_stop)
    return ue.unionByName(home).unionByName(work)


def at_base_tiles(labels: DataFrame, factor: int = 2) -> DataFrame:
    """Labels of coarser tiles (``factor`` base tiles wide; ``location``: a tile's id as text) as labels of each base tile in them."""
    coarse = labels.withColumn("_coarse", F.col("location").cast("int"))
    return grid.refine(coarse, factor, "_coarse", "_fine").withColumn("location", F.col("_fine").cast("string")).select(*labels.columns)


def quality_metrics(scores: DataFrame, labels: DataFrame, total_ps: int = 2, total_days: int = 1) -> DataFrame:
    """(metric, count, min, max, avg): devices seen and discarded, and tiles a device by label and rule."""
    seen = scores.where((F.col("id_type") == ID_OBSERVATION) & (F.col("day_type") == "all") & (F.col("time_interval") == "all"))
    stats = lambda c: [F.count("*").alias("count"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"), F.avg(c).alias("avg")]
    rare = (F.col("lps") < total_ps) | (F.col("total_frequency") < total_days)
    devices = seen.groupBy(F.when(rare, "devices_discarded").otherwise("devices_kept").alias("metric")).agg(*stats("lps"))
    tiles = labels.groupBy("user_id", "season", "label", "label_rule").agg(F.count("*").alias("n")).groupBy(F.concat_ws("_", "label", "label_rule").alias("metric")).agg(*stats("n"))
    return devices.unionByName(tiles)


def tile_weights(tiles: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """(grid_id, weight): 1, or by the main land use category (0 where it has none)."""
    return tiles.select("grid_id", F.lit(1.0).alias("weight") if weights is None else _lookup(F.col("main_landuse_category"), weights).alias("weight"))


def aggregate_labels(labels: DataFrame, weights: DataFrame, missing: float = 0.001) -> DataFrame:
    """(label, location, weighted_device_count): each device spreads one over its tiles of a label, by weight."""
    w = weights.select(F.col("grid_id").cast("string").alias("location"), "weight")
    df = labels.join(w, "location", "left").withColumn("w", F.coalesce("weight", F.lit(missing)))
    share = F.coalesce(F.try_divide(F.col("w"), F.sum("w").over(Window.partitionBy("user_id", "season", "label"))), F.lit(0.0))
    return df.withColumn("share", share).groupBy("season", "label", "location").agg(F.sum("share").alias("weighted_device_count"))
