"""Continuous time segments: each user's day cut into stays, moves, undetermined, unknown and abroad time.

The state machine is a fold in Column expressions. A user-day's events, sorted by time in one array, are folded into
segments; a second fold over the user's days carries the segment that is open at midnight. Both run in the JVM, so a history
needs one shuffle by user and day, one by user, and no loop over days. A later run can go on from the last segments that an
earlier one left, and then reads only the days since: runs of some months bound what a user's row holds.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..codes import ABROAD, MOVE, OUTBOUND, STAY, UNDETERMINED, UNKNOWN
from ..plans.joins import dealt

DAY = 86400
SEGMENT = "struct<start:bigint,end:bigint,last:bigint,cells:array<string>,plmn:bigint,state:int>"
EVENT = "struct<t:bigint,cell:string,overlap:array<string>,plmn:bigint,abroad:boolean>"


@dataclass(frozen=True)
class Params:
    """Seconds. A stay lasts longer than ``min_stay``; gaps up to the bounds are bridged, inclusively."""

    min_stay: int = 900
    missing_stay: int = 43200
    missing_move: int = 7200
    missing_abroad: int = 259200
    missing_unknown: int = 604800
    pad: int = 300
    local_mcc: int = 214


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _segment(start: Column, end: Column, last: Column | None, cells: Column | None, plmn: Column | None, state: Column | int) -> Column:
    none = _null("bigint")
    values = (start, end, none if last is None else last, F.array() if cells is None else cells, none if plmn is None else plmn, F.lit(state) if isinstance(state, int) else state)
    return F.struct(*values).cast(SEGMENT)


def _segments(*parts: Column) -> Column:
    return F.array(*parts).cast(f"array<{SEGMENT}>")


def opening(before: Column, t0: Column, midnight: Column, p: Params) -> Column:
    """The segment from midnight to the day's first event, at ``t0``; ``before`` is the last one of the day before, or null."""
    state, gap = before["state"], t0 - before["last"]
    most = F.when(state == STAY, p.missing_stay).when(state == MOVE, p.missing_move).when(state == ABROAD, p.missing_abroad)
    cells = F.when(state == ABROAD, F.array().cast("array<string>")).otherwise(before["cells"])
    goes_on = _segment(midnight, t0, before["last"], cells, before["plmn"], state)
    pad = F.least(F.lit(p.pad).cast("long"), F.floor((t0 - midnight) / 2))
    return F.when(F.coalesce(gap <= most, F.lit(False)), goes_on).otherwise(_segment(midnight, t0 - pad, before["last"], None, None, UNKNOWN))


def step(now: Column, e: Column, p: Params) -> Column:
    """(closed, now): what an event closes, and the segment that is open after it."""
    start, end, t, state = now["start"], now["end"], e["t"], now["state"]
    gap, here = t - end, F.array(e["cell"])
    out = lambda closed, after: F.struct(_segments(*closed).alias("closed"), after.alias("now"))
    mcc = lambda plmn: F.floor(F.coalesce(plmn, F.lit(0)) / 100)
    away = (
        F.when(state != ABROAD, out([now], _segment(end, t, now["last"], None, e["plmn"], ABROAD)))
        .when(gap > p.missing_abroad, out([now], _segment(end, t, None, None, None, UNKNOWN)))
        .when(mcc(e["plmn"]) == mcc(now["plmn"]), out([], _segment(start, t, t, now["cells"], now["plmn"], state)))
        .otherwise(out([now], _segment(end, t, t, None, e["plmn"], ABROAD)))
    )
    begins = lambda at: _segment(at, t, t, here, None, UNDETERMINED)
    known = lambda c: c.eqNullSafe(e["cell"]) | F.coalesce(F.array_contains(e["overlap"], c), F.lit(False))
    stays = F.when(t - start > p.min_stay, STAY).otherwise(state)
    middle = end + F.floor(gap / 2)
    pad = F.least(F.lit(p.pad).cast("long"), F.floor(gap / 2))

    def near(meets: Column) -> Column:
        return (
            F.when(meets & (gap <= p.missing_stay) & (state == MOVE), out([now], begins(end)))
            .when(meets & (gap <= p.missing_stay), out([], _segment(start, t, t, F.array_union(now["cells"], here), now["plmn"], stays)))
            .when(~meets & (gap <= p.missing_move), out([now, _segment(end, middle, now["last"], now["cells"], None, MOVE)], _segment(middle, t, t, here, None, MOVE)))
            .otherwise(out([_segment(start, end + pad, now["last"], now["cells"], now["plmn"], state), _segment(end + pad, t - pad, None, None, None, UNKNOWN)], begins(t - pad)))
        )

    local = F.when(state.isin(UNKNOWN, ABROAD), out([now], begins(end))).otherwise(bound((F.size(now["cells"]) > 0) & F.forall(now["cells"], known), near))
    return F.when(e["abroad"], away).otherwise(local)


def day_segments(before: Column, events: Column, following: Column, midnight: Column, p: Params) -> Column:
    """The segments of one day; the last ends at 23:59:59. ``following``: the first event of the next day, or null."""
    last = midnight + (DAY - 1)
    abroad = (before["state"] == ABROAD) & F.coalesce(last - before["last"] <= p.missing_abroad, F.lit(False))
    empty = _segment(midnight, last, before["last"], None, F.when(abroad, before["plmn"]), F.when(abroad, ABROAD).otherwise(UNKNOWN))

    def fold(acc: Column, e: Column) -> Column:
        return bound(step(acc["now"], e, p), lambda r: F.struct(F.concat(acc["closed"], r["closed"]).alias("closed"), r["now"].alias("now")))

    zero = F.struct(_segments().alias("closed"), opening(before, F.get(events, F.lit(0))["t"], midnight, p).alias("now"))
    folded = F.aggregate(F.concat(events, F.array_compact(F.array(following))), zero, fold)

    def ended(f: Column) -> Column:
        now = f["now"]
        rest = F.when(now["end"] <= last, _segments(_segment(now["end"], last, now["last"], None, None, UNKNOWN))).otherwise(_segments())
        cut = F.transform(F.filter(F.concat(f["closed"], _segments(now), rest), lambda s: s["start"] <= last), lambda s: s.withField("end", F.least(s["end"], last)))
        return F.filter(cut, lambda s: s["end"] > s["start"])

    return F.when(F.size(events) > 0, bound(folded, ended)).when(before.isNull(), _segments()).otherwise(_segments(empty))


def history(days: Column, p: Params) -> Column:
    """Array of (segment, is_last, day) from a user's array of (day, held, events, following), sorted by day.

    A day that holds the last segment of an earlier run (``held``) makes no segment; what is unknown for too long is dropped.
    """

    def one(acc: Column, d: Column) -> Column:
        b = acc["before"]
        stale = (b["state"] == UNKNOWN) & F.coalesce(d["day"] * DAY - b["last"] > p.missing_unknown, F.lit(True))
        before = F.when(b.isNotNull() & ~stale, b)
        made = F.when(d["held"].isNotNull(), _segments()).otherwise(bound(before, lambda x: day_segments(x, d["events"], d["following"], d["day"] * DAY, p)))

        def carried(m: Column) -> Column:
            told = F.transform(m, lambda s, i: F.struct(s.alias("segment"), (i == F.size(m) - 1).alias("is_last"), d["day"].alias("day")))
            return F.struct(F.coalesce(d["held"], F.get(m, F.size(m) - 1)).alias("before"), F.concat(acc["out"], told).alias("out"))

        return bound(made, carried)

    zero = F.struct(_null(SEGMENT).alias("before"), F.array().cast(f"array<struct<segment:{SEGMENT},is_last:boolean,day:bigint>>").alias("out"))
    return F.aggregate(days, zero, one)["out"]


def segment_id(user: Column, start: Column) -> Column:
    """md5 of the user and the segment's start as text, in UTC."""
    at = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=start)
    return F.md5(F.concat(user.cast("string"), at.cast("string")).cast("binary"))


def user_days(rows: DataFrame, until: int, p: Params) -> DataFrame:
    """(user_id, day, held, events, following) from rows (user_id, day, e, held): a row for each day with events or a held
    segment, and for the days without that follow, as long as a segment can still reach into them, up to day ``until``.
    """
    w = Window.partitionBy("user_id").orderBy("day")
    days = rows.groupBy("user_id", "day").agg(F.sort_array(F.collect_list("e")).alias("events"), F.first("held", ignorenulls=True).alias("held"))
    ahead = F.lead(F.struct("day", F.get("events", F.lit(0)).alias("e"))).over(w)
    days = days.withColumn("ahead", ahead).where(F.col("day") <= until)
    reach = max(p.missing_abroad, p.missing_unknown) // DAY + 2
    to = F.least(F.coalesce(F.col("ahead.day") - 1, F.lit(until)), F.lit(until), F.col("day") + reach)
    days = days.withColumn("at", F.explode(F.sequence(F.col("day"), to)))
    own = F.col("at") == F.col("day")
    return days.select(
        "user_id", F.col("at").alias("day"), F.when(own, F.col("held")).alias("held"), F.when(own, F.col("events")).otherwise(F.array().cast(f"array<{EVENT}>")).alias("events"),
        F.when(F.col("ahead.day") == F.col("at") + 1, F.col("ahead.e")).alias("following"),
    )


def time_segments(events: DataFrame, overlaps: DataFrame, until: int, params: Params = Params(), last: DataFrame | None = None, since: int | None = None) -> DataFrame:
    """Segments of every user from its first event's day to day ``until`` (days since 1970).

    ``events``: user_id, timestamp, cell_id, plmn, domain; ``overlaps``: cell_id, overlapping_cell_ids. Events of the day
    after ``until`` only tell how that day ends. To go on from an earlier run, give the rows of its result as ``last`` and
    the day after it as ``since``: only events from then on are used, and the segments are those of a run over everything,
    if the earlier run also saw the events of ``since``. A user's events of one run are one row.
    """
    near = overlaps.select(F.col("cell_id").alias("_cell"), F.col("overlapping_cell_ids").alias("overlap"))
    t, plmn = F.unix_timestamp("timestamp"), F.col("plmn").cast("long")
    rows = events.withColumn("t", t).where(F.col("t") < (until + 2) * DAY)
    rows = rows if since is None else rows.where(F.col("t") >= since * DAY)
    e = F.struct("t", F.col("cell_id").alias("cell"), "overlap", plmn.alias("plmn"), F.coalesce(F.col("domain") == OUTBOUND, F.lit(False)).alias("abroad")).cast(EVENT)
    rows = rows.join(near, F.col("cell_id") == F.col("_cell"), "left").select("user_id", F.floor(F.col("t") / DAY).alias("day"), e.alias("e"), _null(SEGMENT).alias("held"))
    if last is not None and since is not None:
        held = _segment(F.col("start_s"), F.col("end_s"), F.col("last_event_s"), F.col("cells"), F.col("plmn"), F.col("state"))
        kept = last.where(F.col("is_last") & (F.col("day") == since - 1)).select("user_id", F.lit(since - 1).cast("long").alias("day"), _null(EVENT).alias("e"), held.alias("held"))
        rows = rows.unionByName(kept)
    days = user_days(dealt(rows, "user_id"), until, params).groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("day", "held", "events", "following"))).alias("days"))
    s = F.col("s.segment")
    return days.select("user_id", F.explode(history(F.col("days"), params)).alias("s")).select(
        "user_id", segment_id(F.col("user_id"), s["start"]).alias("time_segment_id"), s["start"].alias("start_s"), s["end"].alias("end_s"), s["last"].alias("last_event_s"),
        F.array_sort(s["cells"]).alias("cells"), s["plmn"].cast("int").alias("plmn"), s["state"].alias("state"), "s.is_last", "s.day",
    )


def with_outbound_users(events: DataFrame) -> DataFrame:
    """Only users with outbound events, with all of their events."""
    return events.join(events.where(F.col("domain") == OUTBOUND).select("user_id").distinct(), "user_id", "left_semi")
