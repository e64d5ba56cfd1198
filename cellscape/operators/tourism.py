"""Tourism: stays of inbound visitors, trips and visits by gaps, and their statistics; nights abroad of residents."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..codes import ABROAD, STAY
from ..plans.joins import dealt
from ..plans.windows import gaps_and_islands
from .zoning import zone_at_level


@dataclass(frozen=True)
class Params:
    """Hours and minutes. Segments carry epoch seconds start_s, end_s."""

    min_stay_minutes: int = 180
    midnight_hour: int = 4
    min_night_minutes: int = 300
    trip_gap_hours: int = 24
    visit_gap_hours: int = 24
    outbound_trip_gap_hours: int = 72
    outbound_min_minutes: int = 180
    outbound_night_minutes: int = 200
    local_mcc: int = 214


def inbound_stays(segments: DataFrame, params: Params = Params(), residents: DataFrame | None = None) -> DataFrame:
    """Long stays of foreign SIMs, without ``residents`` (user_id)."""
    long = (F.col("end_s") - F.col("start_s")) >= params.min_stay_minutes * 60
    stays = segments.where((F.col("state") == STAY) & long & (F.col("mcc") != params.local_mcc))
    return stays if residents is None else stays.join(residents.select("user_id").distinct(), "user_id", "left_anti")


def cell_set_zones(stays: DataFrame, posterior: DataFrame, zones: DataFrame) -> DataFrame:
    """(cells, zones): for each distinct set of cells its zones with weights: the cells' posteriors over tiles, over their number."""
    sets = stays.select("cells").distinct().withColumns({"cell_id": F.explode("cells"), "n": F.size("cells")})
    tiles = sets.join(posterior.select("cell_id", "grid_id", "posterior_probability"), "cell_id").join(zones.select("grid_id", F.col("hierarchical_id").alias("zone_id")), "grid_id")
    weights = tiles.groupBy("cells", "zone_id").agg((F.sum(F.col("posterior_probability") / F.col("n"))).alias("weight"))
    return weights.groupBy("cells").agg(F.array_sort(F.collect_list(F.struct("zone_id", "weight"))).alias("zones"))


def overnight(start_s: Column, end_s: Column, params: Params = Params()) -> Column:
    """The stay, which lies in one day as segments do, is across the functional midnight and long enough for a night."""
    hour = lambda t: F.floor(t % 86400 / 3600)
    return (hour(start_s) <= params.midnight_hour) & (hour(end_s) > params.midnight_hour) & (end_s - start_s >= params.min_night_minutes * 60)


def tourism_stays(segments: DataFrame, posterior: DataFrame, zones: DataFrame, params: Params = Params(), residents: DataFrame | None = None) -> DataFrame:
    """Inbound stays with their zones (array of zone_id, weight) and ``is_overnight``."""
    stays = inbound_stays(segments, params, residents)
    return stays.join(cell_set_zones(stays, posterior, zones), "cells").withColumn("is_overnight", overnight(F.col("start_s"), F.col("end_s"), params))


def trips(stays: DataFrame, gap_hours: int, key: tuple[str, ...] = ("user_id",)) -> DataFrame:
    """``trip_start`` and ``trip_id``: a trip ends where the next stay starts more than the gap after it. All history in one plan.

    Stays are dealt out by ``key`` once; what is told of trips, their zones and visits then stays where it is.
    """
    out = gaps_and_islands(dealt(stays, *key), list(key), ["start_s", "end_s"], F.col("start_s"), F.col("end_s"), gap_hours * 3600, "trip_start")
    parts = [F.col(k).cast("string") for k in key]
    return out.withColumn("trip_id", F.md5(F.concat(*parts, F.lit("|"), F.col("trip_start").cast("string")).cast("binary")))


def month_bounds(start_month: str, end_month: str) -> list[tuple[str, int, int]]:
    """(month, since, until) of every month from one to the other, both as yyyy-MM: epoch seconds of its first second and the next month's."""
    first = [datetime.strptime(m, "%Y-%m").replace(tzinfo=timezone.utc) for m in (start_month, end_month)]
    if first[1] < first[0]:
        raise ValueError(f"{end_month} is before {start_month}")
    at = lambda k: datetime(k // 12, k % 12 + 1, 1, tzinfo=timezone.utc)
    months = range(first[0].year * 12 + first[0].month - 1, first[1].year * 12 + first[1].month)
    return [(f"{at(k):%Y-%m}", int(at(k).timestamp()), int(at(k + 1).timestamp())) for k in months]


def month_trips(stays: DataFrame, since: int, until: int, gap_hours: int, held: DataFrame | None = None, key: tuple[str, ...] = ("user_id",)) -> DataFrame:
    """Trips of one run, as ``trips`` tells them, from the stays that start from ``since`` to before ``until``, and ``open``.

    A trip is open if a stay from ``until`` on could still go on with it. ``held``: the open rows of the run before, which
    go on here; so only the period's stays are read. Rows that aren't open are final: those of all runs, and the last
    run's open ones, are the trips of one run over everything.
    """
    own = stays.where((F.col("start_s") >= since) & (F.col("start_s") < until))
    rows = own if held is None else own.unionByName(held.select(*stays.columns))
    reach = F.max("end_s").over(Window.partitionBy(*key, "trip_id")) + gap_hours * 3600
    return trips(rows, gap_hours, key).withColumn("open", reach >= until)


def by_zone(trip_stays: DataFrame, level: int, countries: DataFrame) -> DataFrame:
    """A row for each stay and zone at ``level``, with the country of the SIM ('XX' if unknown). ``countries``: mcc, iso2."""
    iso = countries.select(F.col("mcc").alias("_mcc"), "iso2")
    rows = trip_stays.withColumn("z", F.explode("zones")).withColumns({"zone_id": zone_at_level(F.col("z.zone_id"), level), "zone_weight": F.col("z.weight")}).drop("z", "zones")
    keys = [c for c in rows.columns if c not in ("zone_weight", "cells")]
    merged = rows.drop("cells").groupBy(*keys).agg(F.sum("zone_weight").alias("zone_weight"))
    return merged.join(iso, F.col("mcc") == F.col("_mcc"), "left").withColumn("country_of_origin", F.coalesce("iso2", F.lit("XX"))).drop("_mcc", "iso2")


def visits(zone_stays: DataFrame, gap_hours: int) -> DataFrame:
    """``visit_start`` in each trip and zone; a visit goes on over stays elsewhere, until the gap."""
    return gaps_and_islands(zone_stays, ["user_id", "trip_id", "zone_id"], ["start_s", "end_s"], F.col("start_s"), F.col("end_s"), gap_hours * 3600, "visit_start")


def finished(df: DataFrame, key: list[str], until_s: Column | int, into: str) -> DataFrame:
    """Whether the island's last stay ends before ``until_s``, such as the end of the month."""
    return df.withColumn(into, F.max("end_s").over(Window.partitionBy(*key)) < (F.lit(until_s) if isinstance(until_s, int) else until_s))


def zone_departures(visit_stays: DataFrame, until_s: int) -> DataFrame:
    """(country, is_overnight, zone_id, nights_spent, departures) of finished visits and trips."""
    df = finished(finished(visit_stays, ["user_id", "trip_id"], until_s, "trip_finished"), ["user_id", "trip_id", "zone_id", "visit_start"], until_s, "visit_finished")
    stayed = F.max(F.col("is_overnight").cast("int")).over(Window.partitionBy("user_id", "trip_id")) == 1
    df = df.withColumn("overnight_trip", stayed)
    return df.groupBy("country_of_origin", F.col("overnight_trip").alias("is_overnight"), "zone_id").agg(
        F.sum(F.when(F.col("visit_finished") & F.col("is_overnight"), F.col("zone_weight")).otherwise(0.0)).alias("nights_spent"),
        F.count_distinct(F.when(F.col("trip_finished"), F.col("trip_id"))).alias("departures"),
    )


def averages(visit_stays: DataFrame, until_s: int) -> DataFrame:
    """(country, avg_destinations, avg_nights_spent_per_destination) of finished trips."""
    df = finished(visit_stays, ["user_id", "trip_id"], until_s, "trip_finished").where("trip_finished")
    zones = df.groupBy("user_id", "country_of_origin", "trip_id", "zone_id").agg(F.sum(F.when(F.col("is_overnight"), F.col("zone_weight")).otherwise(0.0)).alias("nights"))
    per_trip = zones.groupBy("user_id", "country_of_origin", "trip_id").agg(F.count("*").alias("destinations"))
    a = per_trip.groupBy("country_of_origin").agg(F.avg("destinations").alias("avg_destinations"))
    b = zones.groupBy("country_of_origin").agg(F.avg("nights").alias("avg_nights_spent_per_destination"))
    return a.join(b, "country_of_origin")


def trip_table(trip_stays: DataFrame, until_s: int) -> DataFrame:
    return trip_stays.groupBy("user_id", "trip_id", "trip_start").agg(F.array_sort(F.collect_list("time_segment_id")).alias("time_segment_ids"), F.max("end_s").alias("trip_end"), (F.max("end_s") < until_s).alias("is_trip_finished"))


def outbound_segments(segments: DataFrame, countries: DataFrame, params: Params = Params(), usual: DataFrame | None = None) -> DataFrame:
    """Long segments abroad with country and time zone, without the countries of a device's usual environment (user_id, iso2)."""
    long = (F.col("end_s") - F.col("start_s")) >= params.outbound_min_minutes * 60
    rows = segments.where((F.col("state") == ABROAD) & long).withColumn("_mcc", F.floor(F.col("plmn") / 100).cast("int"))
    rows = rows.join(countries.select(F.col("mcc").alias("_m"), "iso2", "timezone"), F.col("_mcc") == F.col("_m"), "left").drop("_m", "_mcc")
    rows = rows.withColumns({"iso2": F.coalesce("iso2", F.lit("XX")), "timezone": F.coalesce("timezone", F.lit("UTC"))})
    return rows if usual is None else rows.join(usual.select("user_id", "iso2").distinct(), ["user_id", "iso2"], "left_anti")


def local_overnight(df: DataFrame, params: Params = Params()) -> DataFrame:
    """``is_overnight`` by the clock of the destination: a functional midnight lies in the segment, which is long enough."""
    local = lambda c: F.unix_timestamp(F.from_utc_timestamp(F.timestamp_seconds(c), F.col("timezone"))) - params.midnight_hour * 3600
    crosses = F.floor(local("end_s") / 86400) > F.floor((local("start_s") - 1) / 86400)
    return df.withColumn("is_overnight", crosses & (F.col("end_s") - F.col("start_s") >= params.outbound_night_minutes * 60))


def outbound_nights(segments: DataFrame, until_s: int, params: Params = Params()) -> DataFrame:
    """(iso2, nights_spent): nights of finished visits to each country."""
    t = trips(segments, params.outbound_trip_gap_hours)
    v = gaps_and_islands(t, ["user_id", "trip_id", "iso2"], ["start_s", "end_s"], F.col("start_s"), F.col("end_s"), params.visit_gap_hours * 3600, "visit_start")
    done = finished(v, ["user_id", "trip_id", "iso2", "visit_start"], until_s, "visit_finished")
    return done.groupBy("iso2").agg(F.sum(F.when(F.col("is_overnight") & F.col("visit_finished"), 1.0).otherwise(0.0)).alias("nights_spent"))
