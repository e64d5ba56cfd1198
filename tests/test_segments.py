"""The time segment state machine: one case for each row of its transition tables, and whole days."""

import hashlib

import pytest
from pyspark.sql import functions as F

from cellscape.codes import ABROAD, MOVE, STAY, UNDETERMINED, UNKNOWN
from cellscape.operators.segments import Params, time_segments

from plain_segments import DAY, Event, Segment, day_segments, history, opening, step

P = Params()
H = 3600


def seg(start, end, state, cells=(), last=None, plmn=None):
    return Segment(start, end, last, frozenset(cells), plmn, state)


def local(t, cell, *near):
    return Event(t, cell, frozenset(near), None, False)


def abroad(t, plmn=20801):
    return Event(t, None, frozenset(), plmn, True)


@pytest.mark.parametrize(
    ("before", "t0", "want"),
    [
        (None, 10 * H, (UNKNOWN, 10 * H - 300)),
        (None, 400, (UNKNOWN, 200)),
        (seg(-H, -1, STAY, "a", last=-2 * H), 10 * H, (STAY, 10 * H)),
        (seg(-H, -1, STAY, "a", last=-2 * H - 1), 10 * H, (UNKNOWN, 10 * H - 300)),
        (seg(-H, -1, MOVE, "a", last=-H), H, (MOVE, H)),
        (seg(-H, -1, MOVE, "a", last=-H), H + 1, (UNKNOWN, H + 1 - 300)),
        (seg(-H, -1, ABROAD, last=-60 * H, plmn=20801), 12 * H, (ABROAD, 12 * H)),
        (seg(-H, -1, UNDETERMINED, "a", last=-10), H, (UNKNOWN, H - 300)),
        (seg(-H, -1, UNKNOWN, last=-10), H, (UNKNOWN, H - 300)),
    ],
)
def test_opening(before, t0, want):
    s = opening(before, t0, 0, P)
    assert (s.state, s.end) == want and s.start == 0


def test_local_transitions():
    for state in (UNKNOWN, ABROAD):
        now = seg(0, 100, state)
        assert step(now, local(200, "a"), P) == ([now], seg(100, 200, UNDETERMINED, "a", 200))
    now = seg(0, 100, UNDETERMINED, "a", 100)
    assert step(now, local(800, "b", "a"), P) == ([], seg(0, 800, UNDETERMINED, "ab", 800))
    assert step(now, local(900, "a"), P)[1].state == UNDETERMINED  # not over the bound
    assert step(now, local(901, "a"), P)[1].state == STAY
    assert step(seg(0, 100, STAY, "a", 100), local(100 + 43200, "a"), P)[1].end == 43300
    moving = seg(0, 100, MOVE, "a", 100)
    assert step(moving, local(200, "a"), P) == ([moving], seg(100, 200, UNDETERMINED, "a", 200))
    for state in (UNDETERMINED, STAY, MOVE):
        now = seg(0, 100, state, "a", 100)
        assert step(now, local(7300, "b"), P) == ([now, seg(100, 3700, MOVE, "a", 100)], seg(3700, 7300, MOVE, "b", 7300))
        closed, after = step(now, local(7301, "b"), P)
        assert [(s.start, s.end, s.state) for s in closed] == [(0, 400, state), (400, 7001, UNKNOWN)] and after == seg(7001, 7301, UNDETERMINED, "b", 7301)
    closed, after = step(seg(0, 100, STAY, "a", 100), local(100 + 43201, "a"), P)  # the same cell, after too long
    assert [s.state for s in closed] == [STAY, UNKNOWN] and after.state == UNDETERMINED


def test_abroad_transitions():
    now = seg(0, 100, STAY, "a", 90)
    assert step(now, abroad(200), P) == ([now], seg(100, 200, ABROAD, last=90, plmn=20801))
    out = seg(0, 100, ABROAD, last=100, plmn=20801)
    assert step(out, abroad(100 + 259200, 20899), P) == ([], seg(0, 100 + 259200, ABROAD, last=100 + 259200, plmn=20801))
    assert step(out, abroad(200, 31001), P) == ([out], seg(100, 200, ABROAD, last=200, plmn=31001))
    assert step(out, abroad(101 + 259200), P) == ([out], seg(100, 101 + 259200, UNKNOWN))


def test_days():
    assert day_segments(None, [], None, 0, P) == []
    out = seg(-DAY, -1, ABROAD, last=-10, plmn=20801)
    assert day_segments(out, [], None, 0, P) == [seg(0, DAY - 1, ABROAD, last=-10, plmn=20801)]
    assert day_segments(seg(-DAY, -1, STAY, "a", -10), [], None, 0, P)[0].state == UNKNOWN
    made = day_segments(None, [local(10 * H, "a"), local(20 * H, "a")], local(DAY + H, "a"), 0, P)
    assert [(s.start, s.end, s.state) for s in made] == [(0, 10 * H - 300, UNKNOWN), (10 * H - 300, DAY - 1, STAY)]
    made = day_segments(None, [local(10 * H, "a")], None, 0, P)
    assert made[-1].state == UNKNOWN and made[-1].end == DAY - 1


def test_history_covers_each_day_once():
    days = [(0, [local(5 * H, "a"), local(6 * H, "b", "a")]), (1, [local(DAY + 7 * H, "c")]), (4, [abroad(4 * DAY + H), local(4 * DAY + 9 * H, "a")])]
    rows = list(history(days, 6, P))
    for d in range(7):
        own = [s for s, _, x in rows if x == d]
        assert own[0].start == d * DAY and own[-1].end == (d + 1) * DAY - 1
        assert all(a.end == b.start for a, b in zip(own, own[1:]))
        assert [last for _, last, x in rows if x == d] == [False] * (len(own) - 1) + [True]
    assert {s.state for s, _, x in rows if x in (2, 3)} == {UNKNOWN}


def test_history_reads_no_further_than_the_next_day():
    read = []

    def days():
        for d in range(50):
            read.append(d)
            yield d, [local(d * DAY + H, "a")]

    made = history(days(), 49, P)
    assert next(made)[2] == 0 and read == [0, 1]
    assert max(d for _, _, d in made) == 49


def test_unknown_is_dropped_after_a_week():
    rows = list(history([(0, [local(H, "a")])], 20, P))
    assert max(d for _, _, d in rows) == 7


def test_frame_unsorted_input(spark):
    rows = [(7, 20 * H, "a", None, "domestic"), (7, 10 * H, "a", None, "domestic"), (8, H, None, 20801, "outbound")]
    ev = spark.createDataFrame(rows, "user_id long, s long, cell_id string, plmn int, domain string").withColumn("timestamp", F.timestamp_seconds("s"))
    near = spark.createDataFrame([("a", ["b"])], "cell_id string, overlapping_cell_ids array<string>")
    got = time_segments(ev, near, 0).orderBy("user_id", "start_s").collect()
    assert [(r["user_id"], r["start_s"], r["end_s"], r["state"]) for r in got] == [
        (7, 0, 10 * H - 300, UNKNOWN), (7, 10 * H - 300, 20 * H, STAY), (7, 20 * H, DAY - 1, UNKNOWN), (8, 0, H - 300, UNKNOWN), (8, H - 300, H, ABROAD), (8, H, DAY - 1, UNKNOWN),
    ]
    assert got[0]["time_segment_id"] == hashlib.md5(b"71970-01-01 00:00:00").hexdigest() and [r["is_last"] for r in got] == [False, False, True] * 2
    assert time_segments(ev.limit(0), near, 0).count() == 0


def test_going_on_from_saved_segments_equals_the_whole_history(spark):
    import random

    draw = random.Random(4)
    rows = []
    for user in range(12):
        t = draw.randrange(3 * DAY)
        while t < 14 * DAY:
            out = draw.random() < 0.15
            rows.append((user, t, None if out else draw.choice("abc"), 20801 if out else None, "outbound" if out else "domestic"))
            t += int(draw.expovariate(1 / draw.choice([900, 20_000, 200_000]))) + 1
    ev = spark.createDataFrame(rows, "user_id long, s long, cell_id string, plmn int, domain string").withColumn("timestamp", F.timestamp_seconds("s"))
    near = spark.createDataFrame([("a", ["b"]), ("b", ["a"])], "cell_id string, overlapping_cell_ids array<string>")
    whole = sorted(map(str, time_segments(ev, near, 14).collect()))
    parts, last, since = [], None, None
    for until in (4, 5, 14):
        seen = ev if since is None else ev.where(F.col("s") >= since * DAY)
        rows = time_segments(seen.where(F.col("s") < (until + 2) * DAY), near, until, last=last, since=since).collect()
        parts += rows
        last, since = spark.createDataFrame(rows, "user_id long, time_segment_id string, start_s long, end_s long, last_event_s long, cells array<string>, plmn int, state int, is_last boolean, day long"), until + 1
    assert sorted(map(str, parts)) == whole and len(whole) > 200


def test_registered_segments_against_a_fold_of_plain_rows(spark):
    """The whole table, event by event in one list a user, without frames."""
    from collections import defaultdict

    from cellscape.operators import coverage
    from cellscape.queries import mobility
    from cellscape.sources import demo

    sf = "/root/testdata/sf0.001"
    fp = coverage.prune_share_of_best(coverage.dominance(coverage.tiles_in_range(coverage.impute_defaults(demo.cells(spark)), demo.lattice(spark).drop("k"), coverage.Params(bin_size=250.0))))
    near = {r["cell_id"]: r["overlapping_cell_ids"] for r in coverage.overlap_groups(coverage.nearby_cells(fp, demo.lattice(spark), 500.0), 250.0).collect()}
    events = defaultdict(lambda: defaultdict(list))
    for r in demo.events(spark, sf).select("user_id", F.unix_timestamp("timestamp").alias("t"), "cell_id", "plmn", "domain").collect():
        events[r["user_id"]][r["t"] // DAY].append((r["t"], r["cell_id"], r["plmn"], r["domain"] == "outbound"))
    p, want = Params(missing_stay=43200, missing_move=28800, min_stay=900), []
    for user, days in events.items():
        before = None
        for day in range(min(days), 19753):
            row = [Event(t, c, frozenset(near.get(c) or ()), m, o) for t, c, m, o in sorted(days.get(day, ()), key=lambda x: x[:2])]
            nxt = sorted(days.get(day + 1, ()), key=lambda x: x[:2])
            following = Event(nxt[0][0], nxt[0][1], frozenset(near.get(nxt[0][1]) or ()), nxt[0][2], nxt[0][3]) if nxt else None
            if before and before.state == UNKNOWN and (before.last is None or day * DAY - before.last > p.missing_unknown):
                before = None
            made = day_segments(before, row, following, day * DAY, p)
            want += [(user, day, s.start, s.end, s.state, ",".join(sorted(s.cells))) for s in made]
            before = made[-1] if made else None
    got = [(r["user_id"], r["day"], r["start_s"], r["end_s"], r["state"], r["cells"]) for r in mobility.time_segments(spark, sf).collect()]
    assert sorted(got) == sorted(want)
