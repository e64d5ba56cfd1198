"""Extraction of an area's cells, events and devices, and deterministic samples of devices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import inside


def cells_in_box(cells: DataFrame, lon_min: float, lat_min: float, lon_max: float, lat_max: float) -> DataFrame:
    return cells.where(F.col("cell_latitude").between(lat_min, lat_max) & F.col("cell_longitude").between(lon_min, lon_max))


def cells_in_polygon(cells: DataFrame, ring: list[tuple[float, float]]) -> DataFrame:
    """``ring``: closed list of (longitude, latitude)."""
    points = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ring])
    return cells.where(inside(F.col("cell_longitude"), F.col("cell_latitude"), points))


def events_of_cells(events: DataFrame, cells: DataFrame) -> DataFrame:
    return events.join(cells.select("cell_id").distinct(), "cell_id", "left_semi")


def events_of_devices_seen(events: DataFrame, cells: DataFrame) -> DataFrame:
    """All events of the devices that were seen at one of the cells."""
    seen = events_of_cells(events, cells).select("user_id").distinct()
    return events.join(seen, "user_id", "left_semi")


def sample_devices(events: DataFrame, share: float, buckets: int = 10_000) -> DataFrame:
    """Events of about ``share`` of the devices, always the same ones: those whose md5 falls low."""
    h = F.conv(F.substring(F.md5(F.col("user_id").cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    return events.where(h % buckets < int(share * buckets))
