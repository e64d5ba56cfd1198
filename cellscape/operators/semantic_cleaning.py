"""Semantic cleaning: events against the network, and against the user's events before and after."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..codes import CELL_NOT_VALID, CELL_UNKNOWN, DIFFERENT_LOCATION_DUPLICATE, INCORRECT_LOCATION, NO_ERROR, OUTBOUND, SEMANTIC_CODES, SUSPICIOUS_LOCATION
from ..functions.geo import haversine

#: Cells up to this many rows are broadcast; a larger network is joined by shuffle.
BROADCAST_CELLS = 200_000


@dataclass(frozen=True)
class Params:
    """Both bounds are exceeded strictly."""

    min_distance: float = 10_000.0
    max_speed: float = 55.0
    different_location_duplicates: bool = True


def flag_events(events: DataFrame, network: DataFrame, params: Params = Params(), cells: int | None = None) -> DataFrame:
    """``events`` plus ``error_flag``. ``network``: (cell_id, date, cell_latitude, cell_longitude, valid_date_start, valid_date_end).

    The first flag wins: outbound (no error), unknown cell, out of validity, location; a time that the user
    spends at two places overrides them. ``cells`` is the network's row count where it is known.
    """
    net = network.select(
        F.col("cell_id").alias("_cell"), F.col("date").alias("_date"), F.col("cell_latitude").alias("_lat"), F.col("cell_longitude").alias("_lon"),
        F.col("valid_date_start").alias("_from"), F.col("valid_date_end").alias("_to"),
    )
    net = F.broadcast(net) if cells is not None and cells <= BROADCAST_CELLS else net
    df = events.join(net, (F.col("cell_id") == F.col("_cell")) & (F.col("date") == F.col("_date")), "left")
    stale = (F.col("timestamp") < F.col("_from")) | (F.col("timestamp") > F.col("_to"))
    df = df.withColumn(
        "error_flag",
        F.when(F.col("domain") == OUTBOUND, NO_ERROR).when(F.col("_cell").isNull(), CELL_UNKNOWN).when(F.coalesce(stale, F.lit(False)), CELL_NOT_VALID),
    )
    day = Window.partitionBy("user_id", "date").orderBy("timestamp", "cell_id")
    if params.different_location_duplicates:
        place = F.struct("cell_id", "latitude", "longitude")
        twice = F.lit(False)
        for side in (F.lag, F.lead):
            twice = twice | F.coalesce((side("timestamp").over(day) == F.col("timestamp")) & ~side(place).over(day).eqNullSafe(place), F.lit(False))
        df = df.withColumn("_twice", twice & (F.col("domain") != OUTBOUND))
    else:
        df = df.withColumn("_twice", F.lit(False))
    df = df.withColumn("error_flag", F.when(F.col("_twice"), DIFFERENT_LOCATION_DUPLICATE).otherwise(F.col("error_flag")))
    lat, lon = F.coalesce("latitude", "_lat"), F.coalesce("longitude", "_lon")
    spot = F.when(F.col("error_flag").isNull(), F.struct(F.col("timestamp").alias("t"), lat.alias("lat"), lon.alias("lon")))
    df = df.withColumn("_spot", spot)
    df = df.withColumns(
        {
            "_before": F.last("_spot", ignorenulls=True).over(day.rowsBetween(Window.unboundedPreceding, -1)),
            "_after": F.first("_spot", ignorenulls=True).over(day.rowsBetween(1, Window.unboundedFollowing)),
        }
    )

    def far(other: str):
        d = haversine(F.col("_spot.lat"), F.col("_spot.lon"), F.col(f"{other}.lat"), F.col(f"{other}.lon"))
        seconds = F.abs(F.unix_timestamp("_spot.t") - F.unix_timestamp(f"{other}.t"))
        return F.coalesce((F.try_divide(d, seconds) > params.max_speed) & (d > params.min_distance), F.lit(False))

    df = df.withColumns({"_far_before": far("_before"), "_far_after": far("_after")})
    location = F.when(F.col("_far_before") & F.col("_far_after"), INCORRECT_LOCATION).when(F.col("_far_before") | F.col("_far_after"), SUSPICIOUS_LOCATION)
    df = df.withColumn("error_flag", F.coalesce("error_flag", location, F.lit(NO_ERROR)))
    return df.drop("_cell", "_date", "_lat", "_lon", "_from", "_to", "_twice", "_spot", "_before", "_after", "_far_before", "_far_after")


def metrics(flagged: DataFrame) -> DataFrame:
    """(date, type_of_error, value), every code of every day, absent ones as 0."""
    counts = flagged.groupBy("date").agg(*[F.count_if(F.col("error_flag") == c).alias(str(c)) for c in SEMANTIC_CODES])
    return counts.unpivot(["date"], [str(c) for c in SEMANTIC_CODES], "type_of_error", "value").withColumn("type_of_error", F.col("type_of_error").cast("int"))


def event_cache(flagged: DataFrame) -> DataFrame:
    """The first and the last valid event of each user-day; an only event takes both roles."""
    day = Window.partitionBy("user_id", "date")
    up, down = day.orderBy("timestamp", "cell_id"), day.orderBy(F.desc("timestamp"), F.desc("cell_id"))
    ranked = flagged.where(F.col("error_flag") == NO_ERROR).withColumns({"_first": F.row_number().over(up) == 1, "_last": F.row_number().over(down) == 1})
    roles = F.array_compact(F.array(F.when(F.col("_first"), F.lit(False)), F.when(F.col("_last"), F.lit(True))))
    return ranked.where("_first or _last").withColumn("is_last_event", F.explode(roles)).drop("_first", "_last")


def with_cached(events: DataFrame, cache: DataFrame, since: str, until: str) -> DataFrame:
    """The events of the dates from ``since`` to ``until``, and from an ``event_cache`` each user's last event of the day before
    and first of the day after; ``own`` tells the former. So a run over some days sees its neighbours without reading them.
    """
    day = lambda d, k: F.date_add(F.lit(d).cast("date"), k)
    before = (F.col("date") == day(since, -1)) & F.col("is_last_event")
    after = (F.col("date") == day(until, 1)) & ~F.col("is_last_event")
    own = events.where(F.col("date").between(day(since, 0), day(until, 0))).withColumn("own", F.lit(True))
    return own.unionByName(cache.where(before | after).select(*events.columns).withColumn("own", F.lit(False)))
