"""Declared table schemas, and the one projection that conforms a frame to them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    """A named table: its schema as DDL, and the columns that partition it on disk."""

    name: str
    ddl: str
    partition_by: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


_DAY = "year smallint, month tinyint, day tinyint"
_BY_DAY = ("year", "month", "day")
_BY_BUCKET = (*_BY_DAY, "user_id_modulo")

BRONZE_EVENTS = Table("bronze_events", f"user_id binary, timestamp string, mcc int, mnc string, plmn int, cell_id string, latitude float, longitude float, loc_error float, {_DAY}", _BY_DAY)
EVENTS = Table("events", f"user_id binary, timestamp timestamp, mcc int, mnc string, plmn int, domain string, cell_id string, latitude float, longitude float, loc_error float, {_DAY}, user_id_modulo int", _BY_BUCKET)
EVENTS_FLAGGED = Table("events_flagged", f"{EVENTS.ddl}, error_flag int", _BY_BUCKET)
NETWORK = Table(
    "network",
    "cell_id string, latitude float, longitude float, altitude float, antenna_height float, directionality int, azimuth_angle float, elevation_angle float, horizontal_beam_width float, "
    f"vertical_beam_width float, power float, range float, frequency int, technology string, valid_date_start timestamp, valid_date_end timestamp, cell_type string, {_DAY}",
    _BY_DAY,
)
GRID = Table("grid", "grid_id int, origin bigint, quadkey string", ("quadkey",))
ZONE_MAP = Table("zone_map", "grid_id int, zone_id string, hierarchical_id string, dataset_id string", ("dataset_id",))
FOOTPRINT = Table("footprint", f"cell_id string, grid_id int, signal_dominance float, {_DAY}", _BY_DAY)
CONNECTION = Table("connection", f"cell_id string, grid_id int, cell_connection_probability float, posterior_probability float, {_DAY}", _BY_DAY)
SEGMENTS = Table(
    "segments",
    f"user_id binary, time_segment_id string, start_timestamp timestamp, end_timestamp timestamp, last_event_timestamp timestamp, mcc int, mnc string, plmn int, cells array<string>, state int, is_last boolean, {_DAY}, user_id_modulo int",
    _BY_BUCKET,
)
DAILY_SCORES = Table("daily_scores", f"user_id binary, dps array<string>, time_slot_initial_time timestamp, time_slot_end_time timestamp, id_type string, {_DAY}, user_id_modulo int", _BY_BUCKET)
POPULATION = Table("population", f"grid_id int, population float, timestamp timestamp, {_DAY}", _BY_DAY)
ZONE_POPULATION = Table("zone_population", f"zone_id string, population float, timestamp timestamp, dataset_id string, level tinyint, {_DAY}", ("dataset_id", "level", *_BY_DAY))


def conform(df: DataFrame, table: Table) -> DataFrame:
    """Exactly the table's columns, in order, cast; missing columns become null."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema])


def audit(df: DataFrame, table: Table, required: tuple[str, ...] = ()) -> DataFrame:
    """(column_name, problem, rows): missing or wrongly typed columns, and nulls in ``required`` ones."""
    spark, want = df.sparkSession, {f.name: f.dataType.simpleString() for f in table.schema}
    have = dict(df.dtypes)
    wrong = [(c, "missing" if c not in have else f"type {have[c]}, not {t}", 0) for c, t in want.items() if have.get(c) != t]
    wrong += [(c, "not declared", 0) for c in have if c not in want]
    out = spark.createDataFrame(wrong, "column_name string, problem string, rows long")
    checked = [c for c in required if c in have]
    if checked:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in checked]).unpivot([], checked, "column_name", "rows")
        out = out.unionByName(nulls.where("rows > 0").select("column_name", F.lit("null").alias("problem"), "rows"))
    return out


def assert_conforms(df: DataFrame, table: Table) -> DataFrame:
    """``df``; raises where its names or types are not the table's."""
    problems = [tuple(r) for r in audit(df, table).collect()]  # one row a column
    if problems:
        raise ValueError(f"{table.name}: {problems}")
    return df
