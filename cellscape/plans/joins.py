"""Joins that Spark has no operator for, as equi-joins on a coarse key plus an exact filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dealt(df: DataFrame, *key: str) -> DataFrame:
    """``df`` dealt out over all shuffle partitions, by ``key`` if there is one, where its bytes tell too little of the work to come.

    What is grouped, ordered or joined by the key and more then stays where it is, and adaptive execution doesn't merge the parts.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)


def lattice_range_join(points: DataFrame, others: DataFrame, radius: Column | float, bin_size: float, x: str = "x", y: str = "y", other_x: str = "other_x", other_y: str = "other_y") -> DataFrame:
    """Pairs within ``radius`` (a number, or a column of ``points``): each point goes to the bins that its disc meets.

    ``distance`` is added. Work follows the pairs of neighbouring bins, never the product of the sides. Both sides are shuffled:
    files of keys are small beside their rows, so by their sizes a side of millions would be sent to the driver and to all.
    """
    r = F.lit(radius) if isinstance(radius, (int, float)) else radius
    bins = lambda v, s: F.floor((v + s * r) / bin_size)
    spread = points.withColumn("_bx", F.explode(F.sequence(bins(F.col(x), -1), bins(F.col(x), 1)))).withColumn("_by", F.explode(F.sequence(bins(F.col(y), -1), bins(F.col(y), 1))))
    keyed = others.withColumns({"_ox": F.floor(F.col(other_x) / bin_size), "_oy": F.floor(F.col(other_y) / bin_size)})
    d = F.sqrt(F.pow(F.col(x) - F.col(other_x), 2) + F.pow(F.col(y) - F.col(other_y), 2))
    return (
        spread.join(keyed.hint("merge"), (F.col("_bx") == F.col("_ox")) & (F.col("_by") == F.col("_oy")))
        .withColumn("distance", d)
        .where(F.col("distance") <= r)
        .drop("_bx", "_by", "_ox", "_oy")
    )


def boxes_near(boxes: DataFrame, key: str, distance: float, bin_size: float, by: tuple[str, ...] = ()) -> DataFrame:
    """(a, b): structs of two rows, ``key`` of the first the lesser, whose boxes (x0, y0, x1, y1) are within ``distance`` on both axes.

    Boxes go to the bins that they meet, the first's widened; a pair is taken in the one bin that holds the lower left corner of
    what the widened box and the other share, so none comes twice. The first's rows are dealt over all tasks before: there are
    few of them beside the pairs, on which the work is done.
    """
    cell = lambda v: F.floor(v / bin_size)
    row = F.struct(*boxes.columns)

    def spread(rows: DataFrame, name: str, wide: float) -> DataFrame:
        out = rows.select(*[F.col(c).alias(f"{name}_{c}") for c in by], row.alias(name))
        for axis in "xy":
            out = out.withColumn(f"{name}_b{axis}", F.explode(F.sequence(cell(F.col(f"{name}.{axis}0") - wide), cell(F.col(f"{name}.{axis}1") + wide))))
        return out

    same = [F.col(f"a_{c}") == F.col(f"b_{c}") for c in (*by, "bx", "by")]
    dealt = boxes.repartition(int(boxes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    met = spread(dealt, "a", distance).join(spread(boxes, "b", 0.0).hint("merge"), same).where(F.col(f"a.{key}") < F.col(f"b.{key}"))
    for axis in "xy":
        low = F.greatest(F.col(f"a.{axis}0") - distance, F.col(f"b.{axis}0"))
        met = met.where((F.col(f"a.{axis}0") - distance <= F.col(f"b.{axis}1")) & (F.col(f"b.{axis}0") <= F.col(f"a.{axis}1") + distance) & (cell(low) == F.col(f"a_b{axis}")))
    return met.select(*[F.col(f"a_{c}").alias(c) for c in by], "a", "b")


def slot_overlap(intervals: DataFrame, start: str, end: str, slot_seconds: int) -> DataFrame:
    """Each interval (epoch seconds, half-open) cut at slot borders: ``slot`` start and ``seconds`` inside it."""
    first, last = F.floor(F.col(start) / slot_seconds), F.ceil(F.col(end) / slot_seconds) - 1
    cut = intervals.where(F.col(end) > F.col(start)).withColumn("slot", F.explode(F.transform(F.sequence(first, last), lambda i: i * slot_seconds)))
    return cut.withColumn("seconds", F.least(F.col(end), F.col("slot") + slot_seconds) - F.greatest(F.col(start), F.col("slot")))


def nearest_in_time(points: DataFrame, events: DataFrame, key: list[str], point_ts: str, event_ts: str, tolerance: int, tie_break: list[str], salt: int | None = None) -> DataFrame:
    """For each (point, key) the event nearest in time within ``tolerance`` seconds; ties: the earlier, then ``tie_break``.

    Times are epoch seconds. Both sides meet on buckets as wide as the tolerance and, so that no bucket of all keys is
    one task, on ``salt`` hashes of the key (as many as there are shuffle partitions, unless given), for each of which a point
    is repeated. Points are few beside events.
    """
    salt = salt or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = points.withColumn("_bucket", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(F.col(point_ts) / tolerance) + d)))
    spread = spread.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    keyed = events.withColumns({"_slot": F.floor(F.col(event_ts) / tolerance), "_salt": F.pmod(F.xxhash64(*key), F.lit(salt)).cast("int")})
    gap = F.abs(F.col(event_ts) - F.col(point_ts))
    near = spread.join(keyed, (F.col("_bucket") == F.col("_slot")) & (F.col("_part") == F.col("_salt"))).where(gap <= tolerance)
    order = Window.partitionBy(point_ts, *key).orderBy(gap, event_ts, *tie_break)
    return near.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank", "_bucket", "_slot", "_part", "_salt")
