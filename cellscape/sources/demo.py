"""Views of the domain over the star tables: events become signals in a 10 x 10 lattice of cells and tiles.

Corruptions, roles and places follow from row keys by fixed arithmetic, so SQL can state the same views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..codes import DOMESTIC, INBOUND, OUTBOUND
from ..functions import grid

SIDE = 10
ORIGIN = (4_000_000, 3_000_000)
FIRST_DAY, LAST_DAY = "2024-01-01", "2024-01-30"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, uid, ts to the second, k: 0..99, event_type)."""
    return signals_of(load(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream of the table's files."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return signals_of(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]"))  # a pattern, as a stream's path is a folder or one


def signals_of(e: DataFrame) -> DataFrame:
    return e.select("event_id", F.col("user_id").alias("uid"), F.date_trunc("second", F.col("ts").cast("timestamp")).alias("ts"), F.regexp_extract("props", r"(\d+)", 1).cast("int").alias("k"), "event_type")


def _every(n: int):
    return F.col("event_id") % n == 0


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events with errors of every kind; ``date`` is the day they came for."""
    b = base_events(spark, sf_dir)
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    lone = _every(79)
    b = b.withColumns(
        {
            "date": F.to_date("ts"),
            "user_id": F.when(~_every(101), F.unhex(F.sha2(F.col("uid").cast("string").cast("binary"), 256))),
            "timestamp": F.when(_every(103), None).when(_every(89), "not a time").when(_every(107), stamp(F.col("ts") + F.expr("interval 2 days"))).otherwise(stamp("ts")),
            "mcc": F.when(lone, None).when(_every(83), 5).when(F.col("event_type") == "error", 310).otherwise(214),
            "mnc": F.when(lone, None).when(_every(73), "1").otherwise("01"),
            "plmn": F.when(lone, None).when(_every(71), 999999).when(F.col("event_type") == "signup", 20801),
            "cell_id": F.when(~_every(97), F.concat(F.lit("2140100000"), F.lpad(F.col("k").cast("string"), 4, "0"))),
            "latitude": F.when(~_every(97), F.lit(40.0) + F.floor(F.col("k") / 10) * 0.01),
            "longitude": F.when(~_every(97), F.lit(-4.0) + F.col("k") % 10 * 0.01),
        }
    ).drop("uid", "ts", "k", "event_type")
    return b.unionByName(b.where(_every(61)).withColumn("event_id", F.col("event_id") + 1_000_000_000))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events; odd ones carry no coordinates of their own."""
    b = base_events(spark, sf_dir)
    abroad = F.col("event_type") == "signup"
    mcc = F.when(F.col("event_type") == "error", 310).otherwise(214)
    return b.select(
        "event_id", F.col("uid").alias("user_id"), F.col("ts").alias("timestamp"), F.to_date("ts").alias("date"), mcc.alias("mcc"), F.when(abroad, 20801).alias("plmn"),
        F.when(abroad, OUTBOUND).when(F.col("event_type") == "error", INBOUND).otherwise(DOMESTIC).alias("domain"),
        cell_name(F.col("k")).alias("cell_id"), F.when(_every(2), latitude(F.col("k"))).alias("latitude"), F.when(_every(2), longitude(F.col("k"))).alias("longitude"),
        (F.col("uid") % 8).cast("int").alias("user_id_modulo"),
    )


def cell_name(k):
    return F.concat(F.lit("C"), F.lpad(k.cast("string"), 2, "0"))


def latitude(k):
    return F.floor(k / 10) * 9.0 - 40.0


def longitude(k):
    return k % 10 * 18.0 - 80.0


def lattice(spark: SparkSession) -> DataFrame:
    """(k, grid_id, origin, tile_x, tile_y, tile_z): the tiles."""
    e, n = F.floor(F.col("id") / SIDE), F.col("id") % SIDE
    return spark.range(SIDE * SIDE).select(
        F.col("id").cast("int").alias("k"), grid.pack(e, n).alias("grid_id"), grid.origin(F.lit(ORIGIN[0]), F.lit(ORIGIN[1])).alias("origin"),
        (ORIGIN[0] + e * 100 + 50.0).alias("tile_x"), (ORIGIN[1] + n * 100 + 50.0).alias("tile_y"), F.lit(0.0).alias("tile_z"),
    )


def cells(spark: SparkSession) -> DataFrame:
    """The physical network, one cell a tile; some state no power, some have a type without defaults."""
    k = F.col("k")
    return lattice(spark).select(
        "k", cell_name(k).alias("cell_id"), F.col("tile_x").alias("cell_x"), F.col("tile_y").alias("cell_y"), (30 + k % 20).cast("double").alias("antenna_height"), F.lit(None).cast("double").alias("altitude"),
        (30 + k % 20).cast("double").alias("cell_z"), F.when(k % 7 != 0, (5 + k % 10).cast("double")).alias("power"), (150 + k % 3 * 50).cast("double").alias("range"),
        F.when(k % 2 == 0, "macrocell").when(k % 5 == 1, "microcell").otherwise("other").alias("cell_type"), (k % 2).cast("int").alias("directionality"), (k * 37 % 360).cast("double").alias("azimuth_angle"),
    )


def _strewn(i):
    """(e, n) of the i-th place: its even and its odd binary digits, so that places fill a square of any size."""
    digit = lambda b: F.shiftright(i, b).bitwiseAND(F.lit(1).cast("long"))
    e = n = F.lit(0).cast("long")
    for b in range(16):
        e, n = e + F.shiftleft(digit(2 * b), b), n + F.shiftleft(digit(2 * b + 1), b)
    return e, n


def ground(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, grid_id, origin, tile_x, tile_y, elevation): a tile for each customer, in a square that grows with them; some state no elevation."""
    k = F.col("c_custkey").cast("long")
    e, n = _strewn(k)
    return load(spark, sf_dir, "customer").select(k.alias("k"), e.alias("e"), n.alias("n")).select(
        "k", grid.pack(F.col("e"), F.col("n")).alias("grid_id"), grid.origin(F.lit(ORIGIN[0]), F.lit(ORIGIN[1])).alias("origin"),
        (ORIGIN[0] + F.col("e") * 100 + 50.0).alias("tile_x"), (ORIGIN[1] + F.col("n") * 100 + 50.0).alias("tile_y"), F.when(F.col("k") % 6 != 0, (F.col("k") * 7 % 20).cast("double")).alias("elevation"),
    )


def antennas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A physical network over ``ground``, a cell for each part; some state no power or altitude, some have a type without defaults."""
    k = F.col("k")
    e, n = _strewn(F.floor(F.col("p_partkey") * 3 / 4).cast("long"))
    return load(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("k"), e.alias("e"), n.alias("n")).select(
        "k", F.concat(F.lit("P"), F.lpad(k.cast("string"), 9, "0")).alias("cell_id"), (ORIGIN[0] + F.col("e") * 100 + 50.0).alias("cell_x"), (ORIGIN[1] + F.col("n") * 100 + 50.0).alias("cell_y"),
        (30 + k % 20).cast("double").alias("antenna_height"), F.when(k % 5 != 0, (k % 15).cast("double")).alias("altitude"), F.when(k % 7 != 0, (5 + k % 10).cast("double")).alias("power"), (150 + k % 3 * 50).cast("double").alias("range"),
        F.when(k % 2 == 0, "macrocell").when(k % 5 == 1, "microcell").otherwise("other").alias("cell_type"), (k % 2).cast("int").alias("directionality"), (k * 37 % 360).cast("double").alias("azimuth_angle"),
    )


def network_days(spark: SparkSession) -> DataFrame:
    """(cell_id, date, cell_latitude, cell_longitude, valid_date_start, valid_date_end) for every day; some cells are unknown."""
    k = F.col("id")
    days = F.sequence(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date"))
    start = F.date_add(F.lit(FIRST_DAY).cast("date"), (k % 7).cast("int")).cast("timestamp")
    return spark.range(SIDE * SIDE).where("id % 33 <> 5").select(
        cell_name(k).alias("cell_id"), F.explode(days).alias("date"), latitude(k).alias("cell_latitude"), longitude(k).alias("cell_longitude"), start.alias("valid_date_start"),
        F.when(k % 3 != 0, F.lit("2024-01-25 00:00:00").cast("timestamp")).alias("valid_date_end"),
    )


def raw_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw cell table over the parts, with errors of every kind."""
    p = F.col("p_partkey")
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (p % 10).cast("int"))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    every = lambda n: p % n == 0
    return load(spark, sf_dir, "part").select(
        p.alias("cell_row"), day.alias("date"), F.when(~every(53), F.concat(F.lit("21401"), F.lpad(p.cast("string"), 9, "0"))).alias("cell_id"),
        F.when(every(47), 95.0).otherwise(40 + p % 100 * 0.01).alias("latitude"), F.when(every(43), None).otherwise(-4 + p % 100 * 0.01).alias("longitude"), (p % 700).cast("double").alias("altitude"),
        F.when(every(41), 0.0).otherwise(10.0 + p % 40).alias("antenna_height"), F.when(every(37), 3).otherwise((p % 2).cast("int")).alias("directionality"),
        F.when(every(31), None).when(every(29), 361.0).otherwise((p % 360).cast("double")).alias("azimuth_angle"), F.when(every(23), 91.0).otherwise((p % 10).cast("double")).alias("elevation_angle"),
        F.lit(65.0).alias("horizontal_beam_width"), F.when(every(19), -1.0).otherwise(9.0).alias("vertical_beam_width"), F.when(every(17), -5.0).otherwise((1 + F.col("p_size")).cast("double")).alias("power"),
        (1000.0 + F.col("p_size") * 10).alias("range"), F.lit(1800).alias("frequency"), F.when(every(13), "6G").when(p % 2 == 0, "LTE").otherwise("5G").alias("technology"),
        F.when(every(11), "soon").otherwise(stamp(day)).alias("valid_date_start"), F.when(every(7), stamp(F.date_sub(day, 1))).when(every(5), stamp(F.date_add(day, 90))).alias("valid_date_end"),
        F.when(every(59), None).when(p % 3 == 0, "macrocell").otherwise("microcell").alias("cell_type"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(grid_id, origin, hierarchical_id): region, nation and tile."""
    n, r = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    paths = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)  # five regions
    t = lattice(spark)
    return t.join(F.broadcast(paths), t.k % 25 == paths.n_nationkey).select("k", "grid_id", "origin", F.concat_ws("|", "r_name", "n_name", F.col("k").cast("string")).alias("hierarchical_id"))
