"""Streaming forms of the operators that carry state between batches: sessions, windows, deduplication, last events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def trip_sessions(stays: DataFrame, gap: str = "24 hours", late: str = "2 hours") -> DataFrame:
    """(user_id, trip_start, trip_end, stays): sessions of a stream of stays (user_id, ts); a gap of exactly ``gap`` ends one.

    A session window joins what begins where it ends, so windows are a microsecond shorter.
    """
    w = F.session_window("ts", f"{gap} -1 microseconds")
    s = stays.withWatermark("ts", late).groupBy("user_id", w.alias("w")).agg(F.count("*").alias("stays"))
    return s.select("user_id", F.col("w.start").alias("trip_start"), (F.col("w.end") + F.expr("interval 1 microsecond")).alias("trip_end"), "stays")


def cell_counts(events: DataFrame, window: str = "1 hour", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    """(start, cell_id, events, devices): events and about how many devices by window and cell; what comes later than the watermark is dropped."""
    w = F.window("ts", window, slide or window)
    s = events.withWatermark("ts", late).groupBy(w.alias("w"), "cell_id").agg(F.count("*").alias("events"), F.approx_count_distinct("user_id").alias("devices"))
    return s.select(F.col("w.start").alias("start"), "cell_id", "events", "devices")


def without_duplicates(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """Same-location duplicates dropped within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["user_id", "ts", "cell_id"])


def dwell(events: DataFrame, gap_seconds: int = 43200) -> DataFrame:
    """(user_id, cell_id, start_s, end_s, events): a user's runs in one cell, each sent when another cell or a longer gap ends it.

    ``events``: user_id, t (epoch seconds), cell_id. State is one run for each user, so it doesn't grow with history.
    """

    def fold(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run, out = (list(state.get) if state.exists else None), []
        rows = pd.concat([part[["t", "cell_id"]] for part in parts])  # parts are cut anywhere: only all of a user's new rows have an order
        for t, cell in rows.sort_values(["t", "cell_id"]).itertuples(index=False):
            if run and run[0] == cell and t - run[2] <= gap_seconds:
                run[2], run[3] = max(int(t), run[2]), run[3] + 1
            else:
                out += [(key[0], *run)] if run else []
                run = [cell, int(t), int(t), 1]
        if run:
            state.update(tuple(run))
        yield pd.DataFrame(out, columns=["user_id", "cell_id", "start_s", "end_s", "events"])

    return events.groupBy("user_id").applyInPandasWithState(
        fold, "user_id long, cell_id string, start_s long, end_s long, events long", "cell_id string, start_s long, end_s long, events long", "append", GroupStateTimeout.NoTimeout
    )


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Process what is there, exactly once, into Parquet, and read it."""
    stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
