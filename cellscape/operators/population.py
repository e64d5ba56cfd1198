"""Present population: devices near a time point, spread over tiles by iterated Bayesian redistribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.iterate import cut, iterate_until
from ..plans.joins import nearest_in_time


def time_points(spark: SparkSession, start: str, end: str, step_seconds: int) -> DataFrame:
    """(time_point): from start to end, both inclusive."""
    return spark.sql("SELECT explode(sequence(cast(:a as timestamp), cast(:b as timestamp), make_interval(0, 0, 0, 0, 0, 0, :s))) AS time_point", args={"a": start, "b": end, "s": step_seconds})


def dates_near(timestamp: Column, start: str, end: str, tolerance: int) -> Column:
    """Predicate for partition pruning: dates that a window around the time points touches."""
    lo, hi = (F.to_date(F.timestamp_seconds(F.unix_timestamp(F.lit(x).cast("timestamp")) + d)) for x, d in ((start, -tolerance), (end, tolerance)))
    return F.to_date(timestamp).between(lo, hi)


def devices_per_cell(events: DataFrame, points: DataFrame, tolerance: int = 3600) -> DataFrame:
    """(time_point, cell_id, device_count): each user counts in the cell of the event nearest to the point."""
    ev = events.select("user_id", "cell_id", F.unix_timestamp("timestamp").alias("_t"))
    near = nearest_in_time(points.withColumn("_p", F.unix_timestamp("time_point")), ev, ["user_id"], "_p", "_t", tolerance, ["cell_id"])
    return near.groupBy("time_point", "cell_id").agg(F.count("*").alias("device_count"))


def connected(devices: DataFrame, probabilities: DataFrame) -> DataFrame:
    """(time_point, cell_id, grid_id, device_count, p): the tiles that a cell with devices can have them in. No other tile ever counts."""
    p = probabilities.select("cell_id", "grid_id", F.col("cell_connection_probability").alias("p"))
    return devices.select("time_point", "cell_id", "device_count").join(p, "cell_id").where("p > 0")


def population_step(state: DataFrame, links: DataFrame) -> DataFrame:
    """One redistribution: each cell's devices go to its tiles in proportion to population times connection probability."""
    cell = Window.partitionBy("time_point", "cell_id")  # a cell has as many rows as its footprint has tiles
    joint = links.join(state.select("time_point", "grid_id", "population"), ["time_point", "grid_id"]).withColumn("w", F.col("population") * F.col("p"))
    share = F.col("device_count") * F.coalesce(F.try_divide("w", F.sum("w").over(cell)), F.lit(0.0))
    return joint.withColumn("population", share).groupBy("time_point", "grid_id").agg(F.sum("population").alias("population"))


def at_date(probabilities: DataFrame, date: str, date_col: str = "date") -> DataFrame:
    """The probabilities of one network day."""
    return probabilities.where(F.col(date_col) == F.lit(date).cast("date"))


def start_population(links: DataFrame, devices: DataFrame, tiles: DataFrame) -> DataFrame:
    """Each point's devices over all tiles, uniformly; rows are only the tiles that are connected."""
    n = tiles.agg(F.count("*").alias("tiles"))
    total = devices.groupBy("time_point").agg(F.sum("device_count").alias("n")).crossJoin(F.broadcast(n))  # a row a point
    each = total.select("time_point", (F.col("n") / F.col("tiles")).alias("population"))
    return links.select("time_point", "grid_id").distinct().join(each, "time_point")


def present_population(devices: DataFrame, probabilities: DataFrame, tiles: DataFrame, max_iterations: int = 20, tolerance: float = 10_000.0) -> DataFrame:
    """(time_point, grid_id, population). Points without devices give no rows.

    Each point goes on until its own L1 change is below ``tolerance``, or ``max_iterations`` times; a point that has settled
    is read no more. What a point reads is written once, and every step is a table.
    """
    links = cut(connected(devices, probabilities))
    state, done = start_population(links, devices, tiles), None
    for i in range(max_iterations):
        old = state.select("time_point", "grid_id", F.col("population").alias("_old"))
        step = cut(population_step(state, links).join(old, ["time_point", "grid_id"]))
        change = step.groupBy("time_point").agg(F.sum(F.abs(F.col("population") - F.col("_old"))).alias("change"))
        moving = change.where(F.col("change") >= tolerance).select("time_point")
        if i + 1 == max_iterations or moving.isEmpty():
            rest = step
        else:
            rest = step.join(moving, "time_point", "left_anti")
            state, links = step.join(moving, "time_point", "left_semi").drop("_old"), links.join(moving, "time_point", "left_semi")
        done = rest if done is None else done.unionByName(rest)
        if rest is step:
            break
    return (start_population(links, devices, tiles) if done is None else done).select("time_point", "grid_id", "population")


def converged_together(devices: DataFrame, probabilities: DataFrame, tiles: DataFrame, max_iterations: int = 20, tolerance: float = 10_000.0) -> DataFrame:
    """The same where all points go on until their L1 changes, also of tiles without connection, add up to less than ``tolerance``."""
    devices = cut(devices)
    links = cut(connected(devices, probabilities))
    start = start_population(tiles.select("grid_id").crossJoin(devices.select("time_point").distinct()), devices, tiles)
    return iterate_until(start, lambda s: population_step(s, links), ["time_point", "grid_id"], "population", tolerance, max_iterations)


def fixed_iterations(devices: DataFrame, probabilities: DataFrame, tiles: DataFrame, iterations: int) -> DataFrame:
    """The same with a set number of iterations in one plan."""
    links = cut(connected(devices, probabilities))
    state = start_population(links, devices, tiles)
    for _ in range(iterations):
        state = population_step(state, links)
    return state
