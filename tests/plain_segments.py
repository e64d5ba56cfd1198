"""The state machine of time segments in plain Python, one event after another: what the fold in Spark is held against."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

from cellscape.codes import ABROAD, MOVE, STAY, UNDETERMINED, UNKNOWN
from cellscape.operators.segments import Params

DAY = 86400


@dataclass(frozen=True)
class Segment:
    start: int
    end: int
    last: int | None
    cells: frozenset[str]
    plmn: int | None
    state: int


@dataclass(frozen=True)
class Event:
    t: int
    cell: str | None
    overlap: frozenset[str]
    plmn: int | None
    abroad: bool


def opening(before: Segment | None, t0: int, midnight: int, p: Params) -> Segment:
    """The segment from midnight to the day's first event."""
    if before is not None and before.last is not None:
        gap, none = t0 - before.last, frozenset()
        bound = {STAY: p.missing_stay, MOVE: p.missing_move, ABROAD: p.missing_abroad}.get(before.state)
        if bound is not None and gap <= bound:
            return Segment(midnight, t0, before.last, none if before.state == ABROAD else before.cells, before.plmn, before.state)
    return Segment(midnight, t0 - min(p.pad, (t0 - midnight) // 2), before.last if before else None, frozenset(), None, UNKNOWN)


def step(now: Segment, e: Event, p: Params) -> tuple[list[Segment], Segment]:
    """What an event closes, and the segment that is open after it."""
    gap = e.t - now.end
    if e.abroad:
        if now.state != ABROAD:
            return [now], Segment(now.end, e.t, now.last, frozenset(), e.plmn, ABROAD)
        if gap > p.missing_abroad:
            return [now], Segment(now.end, e.t, None, frozenset(), None, UNKNOWN)
        if (e.plmn or 0) // 100 == (now.plmn or 0) // 100:
            return [], replace(now, end=e.t, last=e.t)
        return [now], Segment(now.end, e.t, e.t, frozenset(), e.plmn, ABROAD)
    here = frozenset([e.cell])
    if now.state in (UNKNOWN, ABROAD):
        return [now], Segment(now.end, e.t, e.t, here, None, UNDETERMINED)
    meets = bool(now.cells) and now.cells <= e.overlap | here
    if meets and gap <= p.missing_stay:
        if now.state == MOVE:
            return [now], Segment(now.end, e.t, e.t, here, None, UNDETERMINED)
        state = STAY if e.t - now.start > p.min_stay else now.state
        return [], replace(now, end=e.t, last=e.t, cells=now.cells | here, state=state)
    if not meets and gap <= p.missing_move:
        middle = now.end + gap // 2
        return [now, Segment(now.end, middle, now.last, now.cells, None, MOVE)], Segment(middle, e.t, e.t, here, None, MOVE)
    pad = min(p.pad, gap // 2)
    return [replace(now, end=now.end + pad), Segment(now.end + pad, e.t - pad, None, frozenset(), None, UNKNOWN)], Segment(e.t - pad, e.t, e.t, here, None, UNDETERMINED)


def day_segments(before: Segment | None, events: list[Event], following: Event | None, midnight: int, p: Params) -> list[Segment]:
    """The segments of one day; the last ends at 23:59:59. ``following``: the first event of the next day."""
    last = midnight + DAY - 1
    if not events:
        if before is None:
            return []
        abroad = before.state == ABROAD and before.last is not None and last - before.last <= p.missing_abroad
        return [Segment(midnight, last, before.last, frozenset(), before.plmn if abroad else None, ABROAD if abroad else UNKNOWN)]
    out, now = [], opening(before, events[0].t, midnight, p)
    for e in [*events, *([following] if following else [])]:
        closed, now = step(now, e, p)
        out += closed
    out.append(now)
    if now.end <= last:
        out.append(Segment(now.end, last, now.last, frozenset(), None, UNKNOWN))
    cut = [replace(s, end=min(s.end, last)) for s in out if s.start <= last]
    return [s for s in cut if s.end > s.start]


def history(days: Iterable[tuple[int, list[Event]]], until: int, p: Params, before: Segment | None = None, since: int | None = None) -> Iterator[tuple[Segment, bool, int]]:
    """(segment, is_last, day) over a user's days of events, up to day ``until``; days without events between are filled.

    ``before`` is the last segment of the day before ``since``, from which a later run goes on. Events of the day after
    ``until`` only tell how that day ends.
    """
    coming = iter(days)
    after = next(coming, None)
    day = since if before is not None and since is not None else after[0] if after else until + 1
    while day <= until:
        events: list[Event] = []
        if after and after[0] == day:
            events, after = after[1], next(coming, None)
        following = after[1][0] if after and after[0] == day + 1 else None
        if before is not None and before.state == UNKNOWN and (before.last is None or day * DAY - before.last > p.missing_unknown):
            before = None
        made = day_segments(before, events, following, day * DAY, p)
        for j, s in enumerate(made):
            yield s, j == len(made) - 1, day
        before = made[-1] if made else None
        day = day + 1 if made else after[0] if after else until + 1
