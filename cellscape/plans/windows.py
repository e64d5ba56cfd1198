"""Window plans: sessions by gaps, and statistics of what came before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gaps_and_islands(df: DataFrame, key: list[str], order: list[str], start: Column, end: Column, gap: int, into: str, inclusive: bool = False) -> DataFrame:
    """``into``: the start of each row's island; an island ends where the next start is more than ``gap`` after all ends so far."""
    w = Window.partitionBy(*key).orderBy(*order)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    breaks = before.isNull() | ((start - before >= gap) if inclusive else (start - before > gap))
    flagged = df.withColumn("_opens", F.when(breaks, start))
    return flagged.withColumn(into, F.last("_opens", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_opens")


def lookback(df: DataFrame, value: str, order: str, rows: int, key: list[str] | None = None) -> DataFrame:
    """Adds ``average`` and ``spread`` (sample standard deviation) over the ``rows`` rows before."""
    w = Window.partitionBy(*(key or [])).orderBy(order).rowsBetween(-rows, -1)
    return df.withColumns({"average": F.avg(value).over(w), "spread": F.stddev_samp(value).over(w)})
