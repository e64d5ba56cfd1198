"""Activity statistics of devices by local day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import haversine


def preprocess(events: DataFrame, cells: DataFrame, timezone: str = "UTC") -> DataFrame:
    """Events with their local day, coordinates filled from the cell, gap seconds and metres to the user's next event of the day.

    ``cells``: (cell_id, date, cell_latitude, cell_longitude).
    """
    net = cells.select(F.col("cell_id").alias("_cell"), F.col("date").alias("_date"), "cell_latitude", "cell_longitude")
    local = events.withColumn("local_ts", F.from_utc_timestamp("timestamp", timezone)).withColumn("local_date", F.to_date("local_ts"))
    df = local.join(net, (F.col("cell_id") == F.col("_cell")) & (F.col("date") == F.col("_date")), "left")
    df = df.withColumns({"lat": F.coalesce("latitude", "cell_latitude"), "lon": F.coalesce("longitude", "cell_longitude")})
    w = Window.partitionBy("user_id", "local_date").orderBy("timestamp", "cell_id")
    df = df.withColumn("_next", F.lead(F.struct("timestamp", "lat", "lon")).over(w))
    return df.withColumns(
        {
            "gap_seconds": F.unix_timestamp("_next.timestamp") - F.unix_timestamp("timestamp"),
            "next_distance": haversine(F.col("lat"), F.col("lon"), F.col("_next.lat"), F.col("_next.lon")),
        }
    ).drop("_next", "_cell", "_date", "cell_latitude", "cell_longitude")


def statistics(prepared: DataFrame) -> DataFrame:
    """Events, distinct cells, places and hours, metres moved, mean and spread of gaps, by user and local day."""
    return prepared.groupBy("user_id", "local_date").agg(
        F.count("*").alias("event_cnt"),
        F.count_distinct("cell_id").alias("unique_cell_cnt"),
        F.count_distinct("lat", "lon").alias("unique_location_cnt"),
        F.coalesce(F.sum("next_distance"), F.lit(0.0)).alias("sum_distance_m"),
        F.count_distinct(F.hour("local_ts")).alias("unique_hour_cnt"),
        F.avg("gap_seconds").alias("mean_time_gap"),
        F.stddev_samp("gap_seconds").alias("stdev_time_gap"),
    )
