"""Syntactic cleaning of raw events: one pass of flags, then metrics and the rows to keep."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..codes import CANNOT_PARSE, DOMESTIC, DUPLICATED, INBOUND, NO_LOCATION_INFO, NO_MNO_INFO, NULL_VALUE, OUT_OF_RANGE, OUTBOUND
from ..functions.grid import user_bucket


@dataclass(frozen=True)
class Params:
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss"
    local_mcc: int = 214
    buckets: int = 8
    rehash: bool = False
    timezone: str | None = None
    bbox: tuple[float, float, float, float] | None = None
    check_cell_length: bool = False
    deduplicate: bool = True


def flag(name: str, code: int, condition: Column) -> dict[str, Column]:
    return {f"{name}_flag_{code}": F.coalesce(condition, F.lit(False))}


def null_flags(columns: Sequence[str]) -> dict[str, Column]:
    return reduce(or_, (flag(c, NULL_VALUE, F.col(c).isNull()) for c in columns))


def range_flags(limits: Mapping[str, tuple[float, float]]) -> dict[str, Column]:
    """Non-null values outside of the inclusive range."""
    return reduce(or_, (flag(c, OUT_OF_RANGE, ~F.col(c).between(lo, hi)) for c, (lo, hi) in limits.items()))


def length_flags(limits: Mapping[str, tuple[int, int]]) -> dict[str, Column]:
    return reduce(or_, (flag(c, OUT_OF_RANGE, ~F.length(c).between(lo, hi)) for c, (lo, hi) in limits.items()))


def parse_timestamp(df: DataFrame, fmt: str) -> DataFrame:
    """``timestamp`` parsed (null where it can't be), with the flag for text that can't."""
    parsed = F.try_to_timestamp("timestamp", F.lit(fmt))
    return df.withColumns({"_parsed": parsed}).withColumns(flag("timestamp", CANNOT_PARSE, F.col("timestamp").isNotNull() & F.col("_parsed").isNull())).drop("timestamp").withColumnRenamed("_parsed", "timestamp")


def out_of_day_flag(date: Column) -> dict[str, Column]:
    """Timestamps outside of [date, date + 1 day], both ends inclusive."""
    return flag("timestamp", OUT_OF_RANGE, ~F.col("timestamp").between(date.cast("timestamp"), F.date_add(date, 1).cast("timestamp")))


def missing_mno_flag() -> dict[str, Column]:
    return flag("no_mno_info", NO_MNO_INFO, F.col("mcc").isNull() & F.col("mnc").isNull() & F.col("plmn").isNull())


def domain(local_mcc: int) -> Column:
    """Outbound: a foreign PLMN is seen; else domestic or inbound by the SIM's country."""
    abroad = F.col("plmn").isNotNull() & (F.substring(F.col("plmn").cast("string"), 1, 3) != str(local_mcc))
    return F.when(abroad, OUTBOUND).when(F.col("mcc") == local_mcc, DOMESTIC).otherwise(INBOUND)


def missing_location_flag() -> dict[str, Column]:
    here = F.col("domain").isin(DOMESTIC, INBOUND)
    return flag("no_location", NO_LOCATION_INFO, here & F.col("cell_id").isNull() & F.col("latitude").isNull() & F.col("longitude").isNull())


def same_location_duplicate_flag(tie_break: Sequence[str] = ()) -> dict[str, Column]:
    """The row before of the same user has the same time, cell, coordinates and PLMN, null equal to null."""
    place = F.struct("timestamp", "cell_id", "latitude", "longitude", "plmn")
    spread = F.when(F.col("user_id").isNull(), F.xxhash64("timestamp", "cell_id"))  # rows without a user are never flagged, and may be many
    w = Window.partitionBy("user_id", spread).orderBy("timestamp", "cell_id", "latitude", "longitude", "plmn", *tie_break)
    return flag("duplicated", DUPLICATED, F.lag(place).over(w).eqNullSafe(place) & F.col("user_id").isNotNull())


def flag_events(df: DataFrame, params: Params = Params(), date: Column | None = None, tie_break: Sequence[str] = ()) -> DataFrame:
    """All flags, ``{column}_flag_0`` (no error of a column), ``domain``, ``user_id_modulo`` and ``to_preserve``.

    ``date`` is the day that a row was delivered for; all days go in one plan.
    """
    hexed = F.hex(F.unhex(F.sha2("user_id", 256)) if params.rehash else F.col("user_id"))
    df = df.withColumns(null_flags(["user_id", "timestamp", "mcc", "mnc"]) | {"user_id_modulo": user_bucket(hexed, params.buckets)})
    df = parse_timestamp(df, params.timestamp_format)
    limits: dict[str, tuple[float, float]] = {"mcc": (100, 999), "plmn": (10000, 99999)}
    if params.bbox:
        limits |= {"latitude": (params.bbox[1], params.bbox[3]), "longitude": (params.bbox[0], params.bbox[2])}
    lengths = {"mnc": (2, 3)} | ({"cell_id": (14, 15)} if params.check_cell_length else {})
    flags = range_flags(limits) | length_flags(lengths) | missing_mno_flag()
    if date is not None:
        flags |= out_of_day_flag(date)
    df = df.withColumns(flags | {"domain": domain(params.local_mcc)}).withColumns(missing_location_flag())
    if params.deduplicate:
        df = df.withColumns(same_location_duplicate_flag(tie_break))
    return with_verdict(df)


def flag_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "_flag_" in c]


def with_verdict(df: DataFrame) -> DataFrame:
    by_column: dict[str, list[Column]] = {}
    for c in flag_columns(df):
        by_column.setdefault(c.rpartition("_flag_")[0], []).append(F.col(c))
    clean = {f"{k}_flag_0": ~reduce(or_, v) for k, v in by_column.items()}
    return df.withColumns(clean | {"to_preserve": reduce(and_, clean.values())})


def metrics_by_column(flagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., variable, type_of_error, value): how many rows bear each flag, from one aggregate."""
    names = flag_columns(flagged)
    sums = flagged.groupBy(*by).agg(*[F.count_if(c).alias(c) for c in names])
    long = sums.unpivot(list(by), names, "flag", "value")
    return long.select(
        *by, F.regexp_extract("flag", r"^(.*)_flag_(\d+)$", 1).alias("variable"), F.regexp_extract("flag", r"^(.*)_flag_(\d+)$", 2).cast("int").alias("type_of_error"), "value"
    )


def frequency_metrics(flagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows before and after cleaning by user bucket (-1: none), user and cell."""
    return flagged.groupBy(*by, F.coalesce("user_id_modulo", F.lit(-1)).alias("user_id_modulo"), "user_id", "cell_id").agg(
        F.count("*").alias("initial_frequency"), F.count_if("to_preserve").alias("final_frequency")
    )


def clean_events(flagged: DataFrame, params: Params = Params()) -> DataFrame:
    """The rows to keep, in UTC, with their calendar parts, laid out by user bucket and sorted by user and time."""
    kept = flagged.where("to_preserve").drop(*flag_columns(flagged), "to_preserve")
    if params.timezone:
        kept = kept.withColumn("timestamp", F.to_utc_timestamp("timestamp", params.timezone))
    parts = {"year": F.year("timestamp").cast("smallint"), "month": F.month("timestamp").cast("tinyint"), "day": F.dayofmonth("timestamp").cast("tinyint")}
    return kept.withColumns(parts).repartition("year", "month", "day", "user_id_modulo").sortWithinPartitions("user_id", "timestamp")
