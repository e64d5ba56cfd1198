"""Quality warnings: daily measures against what came before and against fixed limits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..codes import UNKNOWN_CELL
from ..plans.windows import lookback


@dataclass(frozen=True)
class Check:
    """A warning ``name`` where ``condition`` holds, reporting ``limit``."""

    name: str
    condition: Column
    limit: Column


def warnings(df: DataFrame, keys: Sequence[str], checks: Sequence[Check]) -> DataFrame:
    """(keys..., daily_value, warning, condition_value): one row for each check that a row fails."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(c.condition, F.lit(False)), F.struct(F.lit(c.name).alias("warning"), c.limit.cast("double").alias("condition_value"))) for c in checks]))
    return df.select(*keys, "daily_value", F.inline(found))


def over(value: Column, limit: Column) -> Column:
    """Whether a value exceeds a limit by more than the order of summation can tell: statistics that are equal stay equal."""
    return F.round(value - limit, 9) > 0


def size_warnings(frequency: DataFrame, column: str, rows: int = 7, variability: float = 2.0, lower: float = 0.0, upper: float = 1e12) -> DataFrame:
    """Daily sums of ``column`` outside of mean -/+ variability * deviation of the rows before, or of the limits."""
    daily = lookback(frequency.groupBy("date").agg(F.sum(column).alias("daily_value")), "daily_value", "date", rows)
    value, lo, hi = F.col("daily_value"), F.col("average") - variability * F.col("spread"), F.col("average") + variability * F.col("spread")
    return warnings(daily, ["date"], [Check("lower_variability", over(lo, value), lo), Check("upper_variability", over(value, hi), hi), Check("lower_limit", value < lower, F.lit(lower)), Check("upper_limit", value > upper, F.lit(upper))])


def rate_warnings(daily: DataFrame, keys: Sequence[str], rows: int | None = 7, variability: float = 2.0, over_average: float = 30.0, upper: float = 20.0) -> DataFrame:
    """``daily_value`` over mean + variability * deviation, over the mean by a percentage, or over a limit.

    The mean is over the rows before of the same keys, or, with ``rows`` None, over the other keys' rows of the day.
    """
    others = [k for k in keys if k != "date"]
    if rows is None:
        w = Window.partitionBy("date")
        df = daily.withColumns({"average": F.avg("daily_value").over(w), "spread": F.stddev_samp("daily_value").over(w)})
    else:
        df = lookback(daily, "daily_value", "date", rows, others)
    value, ucl = F.col("daily_value"), F.col("average") + variability * F.col("spread")
    percent = F.try_divide(value, F.col("average")) * 100
    return warnings(df, keys, [Check("upper_variability", over(value, ucl), ucl), Check("over_average", over(percent, F.lit(100 + over_average)), F.lit(over_average)), Check("upper_limit", value > upper, F.lit(upper))])


def error_rate(frequency: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per cent of rows lost in cleaning at a granularity: date alone, with cell, with user, or with both."""
    sums = frequency.groupBy(*keys).agg(F.sum("initial_frequency").alias("i"), F.sum("final_frequency").alias("f"))
    return sums.select(*keys, (F.coalesce(F.try_divide(F.col("i") - F.col("f"), "i"), F.lit(0.0)) * 100).cast("double").alias("daily_value"))


def error_type_rate(by_column: DataFrame, frequency: DataFrame) -> DataFrame:
    """(date, variable, type_of_error, daily_value): per cent of a day's rows with an error."""
    total = frequency.groupBy("date").agg(F.sum("initial_frequency").alias("i"))
    return by_column.where("type_of_error <> 0").join(total, "date").select("date", "variable", "type_of_error", (F.coalesce(F.try_divide("value", "i"), F.lit(0.0)) * 100).cast("double").alias("daily_value"))


def semantic_rates(metrics: DataFrame) -> DataFrame:
    """(date, type_of_error, daily_value): per cent of a day's events with each code but 0."""
    share = F.try_divide("value", F.sum("value").over(Window.partitionBy("date")))
    return metrics.withColumn("daily_value", F.coalesce(share, F.lit(0.0)) * 100).where("type_of_error <> 0").select("date", "type_of_error", "daily_value")


def semantic_warnings(rates: DataFrame, rows: int = 7, variability: float = 2.0, fixed: float = 10.0) -> DataFrame:
    """Against mean + variability * deviation of the days before, or a fixed per cent where there are too few (under 2)."""
    df = lookback(rates, "daily_value", "date", rows, ["type_of_error"])
    n = F.count("*").over(Window.partitionBy("type_of_error").orderBy("date").rowsBetween(-rows, -1))
    df = df.withColumn("bound", F.when(n >= 2, F.col("average") + variability * F.col("spread")).otherwise(F.lit(fixed)))
    return warnings(df, ["date", "type_of_error"], [Check("upper_control_limit", F.col("daily_value") > F.col("bound"), F.col("bound"))])


def semantic_log(rates: DataFrame, codes: Sequence[int] = (1, 2, 3, 4, 5)) -> DataFrame:
    """A row a day with each code's rate."""
    wide = rates.groupBy("date").pivot("type_of_error", list(codes)).agg(F.max("daily_value"))
    return wide.select("date", *[F.col(str(c)).alias(f"error_{c}") for c in codes])


def network_warnings(metrics: DataFrame, rows: int = 7, variability: float = 2.0, over_average: float = 20.0, under_average: float = 20.0, lower: float = 1.0, upper: float = 1e9, rate_limit: float = 20.0) -> DataFrame:
    """(date, measure, daily_value, warning, condition_value) over raw and clean size, error rate, and rates by field and type.

    Sizes: over and under the mean by a percentage, outside of the control limits, outside of fixed limits; rates:
    over the mean, over the control limit, over a fixed per cent. All measures go in one plan.
    """
    total = F.sum(F.when(F.col("type_code") == 100, F.col("value"))).over(Window.partitionBy("date"))
    size = metrics.where("type_code in (100, 101)").select("date", F.when(F.col("type_code") == 100, "raw_size").otherwise("clean_size").alias("measure"), F.col("value").cast("double").alias("daily_value"))
    per = lambda m: F.coalesce(F.try_divide("value", "_rows"), F.lit(0.0)) * 100
    with_total = metrics.withColumn("_rows", total)
    field = with_total.where("field_name is not null and type_code <> 0").select("date", F.concat_ws("_", F.lit("rate"), "field_name", F.col("type_code").cast("string")).alias("measure"), per("value").alias("daily_value"))
    kept = with_total.where("type_code = 101").select("date", F.lit("error_rate").alias("measure"), (100 - per("value")).alias("daily_value"))
    df = lookback(size.unionByName(kept).unionByName(field), "daily_value", "date", rows, ["measure"])
    v, mean, sd, sized = F.col("daily_value"), F.col("average"), F.col("spread"), F.col("measure").isin("raw_size", "clean_size")
    hi, lo = mean + variability * sd, mean - variability * sd
    checks = [
        Check("over_average", v > mean * (1 + over_average / 100), F.lit(over_average)), Check("under_average", sized & (v < mean * (1 - under_average / 100)), F.lit(under_average)),
        Check("upper_variability", v > hi, hi), Check("lower_variability", sized & (v < lo), lo),
        Check("upper_limit", F.when(sized, v > upper).otherwise(v > rate_limit), F.when(sized, F.lit(upper)).otherwise(F.lit(rate_limit))), Check("lower_limit", sized & (v < lower), F.lit(lower)),
    ]
    return warnings(df, ["date", "measure"], checks)


def plot_lines(daily: DataFrame, keys: Sequence[str], rows: int = 7, variability: float = 2.0) -> DataFrame:
    """Value, mean and control limits by date, for line plots."""
    df = lookback(daily, "daily_value", "date", rows, [k for k in keys if k != "date"])
    return df.select(*keys, "daily_value", "average", (F.col("average") - variability * F.col("spread")).alias("lcl"), (F.col("average") + variability * F.col("spread")).alias("ucl"))


def plot_shares(metrics: DataFrame) -> DataFrame:
    """(date, field_name, type_code, value) of errors found, for pie plots."""
    return metrics.where("field_name is not null and type_code <> 0 and value > 0").select("date", "field_name", "type_code", "value")


def footprint_metrics(cells: DataFrame, footprint: DataFrame, events: DataFrame, critical: float = 20.0, warning: float = 10.0) -> DataFrame:
    """(date, cell_id, events, percent, status): cells without a footprint and the share of the day's events they hold."""
    lacking = cells.select("date", "cell_id").distinct().join(footprint.select("cell_id").distinct(), "cell_id", "left_anti")
    counts = events.groupBy("date", "cell_id").agg(F.count("*").alias("events"))
    total = events.groupBy("date").agg(F.count("*").alias("all"))
    df = lacking.join(counts, ["date", "cell_id"], "left").join(total, "date", "left").withColumn("events", F.coalesce("events", F.lit(0)))
    percent = F.coalesce(F.try_divide(F.col("events") * 100.0, "all"), F.lit(0.0))
    day = F.sum(percent).over(Window.partitionBy("date"))
    status = F.when(day > critical, "critical").when(day > warning, "warning").otherwise("ok")
    return df.select("date", "cell_id", "events", percent.alias("percent"), status.alias("status"))


def unknown_share(durations: DataFrame, unknown_percent: float = 50.0, slot_seconds: int = 3600) -> DataFrame:
    """(day, devices, mostly_unknown, percent): devices of whose slots at least a share is unknown, mostly or whole.

    A slot that is unknown whole is one row and is only counted; of the others, the cell of most seconds tells.
    """
    whole = (F.col("cell_id") == UNKNOWN_CELL) & (F.col("seconds") >= slot_seconds)
    slots = durations.where(~whole).groupBy("user_id", "day", "slot").agg(F.max_by("cell_id", F.struct("seconds", "cell_id")).alias("main"))
    slots = slots.select("user_id", "day", (F.col("main") == UNKNOWN_CELL).cast("int").alias("unknown")).unionByName(durations.where(whole).select("user_id", "day", F.lit(1).alias("unknown")))
    users = slots.groupBy("user_id", "day").agg((F.avg("unknown") * 100).alias("share"))
    return users.groupBy("day").agg(F.count("*").alias("devices"), F.count_if(F.col("share") >= unknown_percent).alias("mostly_unknown")).withColumn("percent", F.col("mostly_unknown") * 100.0 / F.col("devices"))
