"""Internal migration between two periods, from home tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .zoning import zone_at_level


def migrating_users(before: DataFrame, after: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(user_id, overlap) of devices whose home tiles overlap by less than ``threshold``: twice the common over all."""
    a, b = before.select("user_id", "grid_id").distinct().withColumn("in_a", F.lit(1)), after.select("user_id", "grid_id").distinct().withColumn("in_b", F.lit(1))
    both = a.join(b, ["user_id", "grid_id"], "full_outer").groupBy("user_id")
    counts = both.agg(F.count("in_a").alias("a"), F.count("in_b").alias("b"), F.count(F.col("in_a") + F.col("in_b")).alias("common"))
    return counts.select("user_id", (2 * F.col("common") / (F.col("a") + F.col("b"))).alias("overlap")).where(F.col("overlap") < threshold)


def zone_weights(home: DataFrame, zones: DataFrame, levels: list[int], weights: DataFrame | None = None) -> DataFrame:
    """(user_id, level, zone_id, weight): shares of a device's home tiles, uniform or by ``weights`` (grid_id, weight)."""
    df = home.select("user_id", "grid_id").distinct()
    df = df.withColumn("weight", F.lit(1.0)) if weights is None else df.join(weights, "grid_id", "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    df = df.join(zones.select("grid_id", "hierarchical_id"), "grid_id")
    share = F.coalesce(F.try_divide(F.col("weight"), F.sum("weight").over(Window.partitionBy("user_id"))), F.lit(0.0))
    df = df.withColumn("share", share).withColumn("level", F.explode(F.array(*[F.lit(x) for x in levels])))
    return df.groupBy("user_id", "level", zone_at_level(F.col("hierarchical_id"), F.col("level")).alias("zone_id")).agg(F.sum("share").alias("weight"))


def migration_matrix(before: DataFrame, after: DataFrame, migrating: DataFrame) -> DataFrame:
    """(level, previous_zone, new_zone, migration): products of weights over migrating devices, between different zones."""
    movers = migrating.select("user_id")
    a = before.join(movers, "user_id", "left_semi").select("user_id", "level", F.col("zone_id").alias("previous_zone"), F.col("weight").alias("w1"))
    b = after.join(movers, "user_id", "left_semi").select("user_id", "level", F.col("zone_id").alias("new_zone"), F.col("weight").alias("w2"))
    pairs = a.join(b, ["user_id", "level"]).where("previous_zone <> new_zone")
    return pairs.groupBy("level", "previous_zone", "new_zone").agg(F.sum(F.col("w1") * F.col("w2")).alias("migration"))


def quality_metrics(before: DataFrame, after: DataFrame, migrating: DataFrame) -> DataFrame:
    """One row: devices with a home before, after, in both, and migrating ones among these."""
    a, b = before.select("user_id").distinct().withColumn("in_a", F.lit(1)), after.select("user_id").distinct().withColumn("in_b", F.lit(1))
    m = migrating.select("user_id").withColumn("moved", F.lit(1))
    return a.join(b, "user_id", "full_outer").join(m, "user_id", "left").agg(
        F.count("in_a").alias("previous_home_users"), F.count("in_b").alias("new_home_users"),
        F.count(F.col("in_a") + F.col("in_b")).alias("common_home_users"), F.count(F.col("in_a") + F.col("in_b") + F.col("moved")).alias("migrating_users"),
    )
