"""Cleaning of the cell table: flags, rows to keep, nulled optional values, metrics and most frequent errors."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..codes import CANNOT_PARSE, FINAL_ROWS, INITIAL_ROWS, NO_ERROR, NULL_VALUE, OUT_OF_RANGE

#: Columns whose nulls are errors, and those that a kept row must have right.
CHECKED = (
    "cell_id", "valid_date_start", "latitude", "longitude", "altitude", "antenna_height", "directionality", "elevation_angle", "horizontal_beam_width",
    "vertical_beam_width", "power", "range", "frequency", "technology", "cell_type",
)
MANDATORY = ("cell_id", "latitude", "longitude", "directionality", "azimuth_angle")


@dataclass(frozen=True)
class Params:
    bbox: tuple[float, float, float, float] = (-180.0, -90.0, 180.0, 90.0)
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss"
    technologies: tuple[str, ...] = ("5G", "LTE", "UMTS", "GSM")
    cell_types: tuple[str, ...] = ("macrocell", "microcell", "picocell")
    check_cell_length: bool = False


def flag_cells(df: DataFrame, params: Params = Params()) -> DataFrame:
    """All flags as ``{column}_flag_{code}``, ``_flag_0`` where a column has none, ``to_preserve``; dates parsed."""
    start, end = (F.try_to_timestamp(c, F.lit(params.timestamp_format)) for c in ("valid_date_start", "valid_date_end"))
    directional = F.col("directionality") == 1
    outside = lambda c, lo, hi: (F.col(c) < lo) | (F.col(c) > hi)
    x0, y0, x1, y1 = params.bbox
    flags: dict[str, Column] = {f"{c}_flag_{NULL_VALUE}": F.col(c).isNull() for c in CHECKED}
    flags |= {
        f"azimuth_angle_flag_{NULL_VALUE}": directional & F.col("azimuth_angle").isNull(),
        f"valid_date_start_flag_{CANNOT_PARSE}": F.col("valid_date_start").isNotNull() & start.isNull(),
        f"valid_date_end_flag_{CANNOT_PARSE}": F.col("valid_date_end").isNotNull() & end.isNull(),
        f"dates_flag_{OUT_OF_RANGE}": start > end,
        f"cell_id_flag_{OUT_OF_RANGE}": ~F.length("cell_id").isin(14, 15) if params.check_cell_length else F.lit(False),
        f"latitude_flag_{OUT_OF_RANGE}": outside("latitude", y0, y1),
        f"longitude_flag_{OUT_OF_RANGE}": outside("longitude", x0, x1),
        f"antenna_height_flag_{OUT_OF_RANGE}": F.col("antenna_height") <= 0,
        f"directionality_flag_{OUT_OF_RANGE}": ~F.col("directionality").isin(0, 1),
        f"azimuth_angle_flag_{OUT_OF_RANGE}": directional & outside("azimuth_angle", 0, 360),
        f"elevation_angle_flag_{OUT_OF_RANGE}": outside("elevation_angle", -90, 90),
        f"horizontal_beam_width_flag_{OUT_OF_RANGE}": outside("horizontal_beam_width", 0, 360),
        f"vertical_beam_width_flag_{OUT_OF_RANGE}": outside("vertical_beam_width", 0, 360),
        **{f"{c}_flag_{OUT_OF_RANGE}": F.col(c) < 0 for c in ("power", "range", "frequency")},
        f"technology_flag_{OUT_OF_RANGE}": ~F.col("technology").isin(*params.technologies),
        f"cell_type_flag_{OUT_OF_RANGE}": ~F.col("cell_type").isin(*params.cell_types),
    }
    df = df.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in flags.items()}).withColumns({"valid_date_start": start, "valid_date_end": end})
    by_column: dict[str, list[Column]] = {}
    for k in flags:
        by_column.setdefault(k.rpartition("_flag_")[0], []).append(F.col(k))
    df = df.withColumns({f"{c}_flag_{NO_ERROR}": ~reduce(or_, v) for c, v in by_column.items()})
    return df.withColumns(
        {
            "to_preserve": reduce(and_, (F.col(f"{c}_flag_{NO_ERROR}") for c in MANDATORY)),
            "some_error": reduce(or_, (F.col(k) for k in flags)),
        }
    )


def row_metrics(flagged: DataFrame) -> DataFrame:
    """(date, variable, value): rows deleted, rows with some error."""
    sums = flagged.groupBy("date").agg(F.count_if(~F.col("to_preserve")).alias("rows_deleted"), F.count_if("some_error").alias("rows_with_some_error"))
    return sums.unpivot(["date"], ["rows_deleted", "rows_with_some_error"], "variable", "value")


def metrics_by_column(flagged: DataFrame) -> DataFrame:
    """(date, field_name, type_code, value), with rows before and after as codes 100 and 101 of no field."""
    names = [c for c in flagged.columns if "_flag_" in c]
    sums = flagged.groupBy("date").agg(
        *[F.count_if(c).alias(c) for c in names], F.count("*").alias(f"_flag_{INITIAL_ROWS}"), F.count_if("to_preserve").alias(f"_flag_{FINAL_ROWS}")
    )
    long = sums.unpivot(["date"], [*names, f"_flag_{INITIAL_ROWS}", f"_flag_{FINAL_ROWS}"], "flag", "value")
    part = lambda i: F.regexp_extract("flag", r"^(.*)_flag_(\d+)$", i)
    return long.select("date", F.nullif(part(1), F.lit("")).alias("field_name"), part(2).cast("int").alias("type_code"), "value")


def clean_cells(flagged: DataFrame) -> DataFrame:
    """Rows to keep, with optional values that are in error nulled; both dates where they are in disorder."""
    names = [c for c in flagged.columns if "_flag_" in c]
    columns = {n.rpartition("_flag_")[0] for n in names} & set(flagged.columns) - set(MANDATORY)
    wrong = {c: ~F.col(f"{c}_flag_{NO_ERROR}") for c in columns}
    for c in ("valid_date_start", "valid_date_end"):
        wrong[c] = wrong.get(c, F.lit(False)) | F.col(f"dates_flag_{OUT_OF_RANGE}")
    return flagged.where("to_preserve").withColumns({c: F.when(~w, F.col(c)) for c, w in wrong.items()}).drop(*names, "to_preserve", "some_error")


def top_errors(raw: DataFrame, flagged: DataFrame, top: int | None = 5, percent: float | None = None, key: str = "cell_row") -> DataFrame:
    """(date, field_name, type_code, error_value, error_count, accumulated_percentage) of the most frequent wrong values.

    The cut is the first ``top`` of a day, or those up to ``percent`` of its errors and one more. Ties go by
    field, code and value. ``key`` identifies the rows of ``raw``, whose values are reported as they came.
    """
    names = [c for c in flagged.columns if "_flag_" in c and not c.endswith(f"_flag_{NO_ERROR}") and c.rpartition("_flag_")[0] in raw.columns]
    values = flagged.select(key, *names).join(raw.select(F.col(key), "date", *{n.rpartition("_flag_")[0] for n in names}), key)
    entries = F.array_compact(
        F.array(
            *[
                F.when(F.col(n), F.struct(F.lit(n.rpartition("_flag_")[0]).alias("field_name"), F.lit(int(n.rpartition("_")[2])).alias("type_code"), F.col(n.rpartition("_flag_")[0]).cast("string").alias("error_value")))
                for n in names
            ]
        )
    )
    counts = values.select("date", F.inline(entries)).groupBy("date", "field_name", "type_code", "error_value").agg(F.count("*").alias("error_count"))
    w = Window.partitionBy("date").orderBy(F.desc("error_count"), "field_name", "type_code", "error_value")
    share = 100.0 * F.sum("error_count").over(w.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("error_count").over(Window.partitionBy("date"))
    ranked = counts.withColumns({"accumulated_percentage": share, "_rank": F.row_number().over(w)})
    if percent is not None:
        before = F.coalesce(F.lag("accumulated_percentage").over(w), F.lit(0.0))
        return ranked.withColumn("_before", before).where(F.col("_before") < percent).drop("_rank", "_before")
    return ranked.where(F.col("_rank") <= top).drop("_rank")
