"""Plane geometry, cover, overlay and outlines against brute force in plain Python."""

import math
import random
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellscape.functions import hulls as batches
from cellscape.functions import polygons
from cellscape.operators import areas, coverage


def sides(ring):
    return list(zip(ring, ring[1:] + ring[:1]))


def inside(x, y, ring):
    hits = 0
    for (ax, ay), (bx, by) in sides(ring):
        hits += (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax
    return hits % 2 == 1


def away(x, y, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    t = max(0, min(1, ((x - a[0]) * dx + (y - a[1]) * dy) / (dx * dx + dy * dy)))
    return math.hypot(x - a[0] - t * dx, y - a[1] - t * dy)


def dart(x, y, u, points=((0, 0), (3, 0.6), (1.2, 1.1), (0.8, 2.9))):
    return [(x + u * a, y + u * b) for a, b in points]


HOLE = ((0.7, 0.55), (1.1, 0.75), (0.85, 1.0))


@pytest.fixture(scope="module")
def shapes():
    draw = random.Random(2)
    out = []
    for i in range(14):
        x, y, u = draw.uniform(-500, 900), draw.uniform(-500, 900), draw.uniform(20, 180)
        hole = dart(x, y, u, HOLE if i % 2 else HOLE[::-1])
        out.append((i, "abc"[i % 3], i % 3, dart(x, y, u)[:: 1 if i % 5 else -1], [hole] if i % 4 == 0 else []))
    return out


@pytest.fixture(scope="module")
def frame(spark, shapes):
    return spark.createDataFrame([(*s, "x", 1) for s in shapes], f"id int, category string, priority int, ring {polygons.RING}, holes {areas.RINGS}, s string, n int")


TILES = [(i, 100.0 * (i % 20) - 950, 100.0 * (i // 20) - 950) for i in range(400)]


@pytest.fixture(scope="module")
def tiles(spark):
    return spark.createDataFrame(TILES, "grid_id int, tile_x double, tile_y double")


def in_shape(x, y, shape):
    return inside(x, y, shape[3]) and not any(inside(x, y, h) for h in shape[4])


def area_in(ring, x0, y0, x1, y1):
    """What lies under each side, clamped to the box, signed by its direction."""
    high = y1 - y0
    below = lambda v: 0 if v <= y0 else (v - y0) ** 2 / 2 if v <= y1 else high * high / 2 + high * (v - y1)
    total = 0.0
    for (ax, ay), (bx, by) in sides(ring):
        lo, hi = max(min(ax, bx), x0), min(max(ax, bx), x1)
        if hi > lo:
            m = (by - ay) / (bx - ax)
            part = (below(ay + (hi - ax) * m) - below(ay + (lo - ax) * m)) / m
            total += -part if bx > ax else part
    return abs(total)


def test_hulls_and_their_distances(spark):
    draw = random.Random(1)
    few = lambda: [(float(draw.randrange(6)), float(draw.randrange(6))) for _ in range(draw.choice([1, 2, 3, 8]))]
    rows = []
    for _ in range(300):
        off, up = draw.choice([0, 3, 8]), draw.random()
        rows.append((few(), [(x + off, y + off * up) for x, y in few()]))

    def chain(points):
        out = []
        for p in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    def hull(points):
        points = sorted(set(points))
        return points if len(points) < 2 else chain(points) + chain(points[::-1])

    def gap(a, b):
        """The widest gap over the normals of all segments and the lines between the sets: no hull is needed for it."""
        ways = [(p[1] - q[1], q[0] - p[0]) for s in (a, b) for p in s for q in s] + [(q[0] - p[0], q[1] - p[1]) for p in a for q in b]
        best = 0.0
        for ux, uy in ways:
            n = math.hypot(ux, uy)
            for sign in (1, -1) if n else ():
                along = lambda p: sign * (ux * p[0] + uy * p[1]) / n  # noqa: B023, E731
                best = max(best, min(map(along, b)) - max(map(along, a)))
        return best

    df = spark.createDataFrame(rows, f"a {polygons.RING}, b {polygons.RING}").withColumns({"p": polygons.hull(F.col("a")), "q": polygons.hull(F.col("b"))})
    for r in df.withColumn("d", polygons.hull_distance(F.col("p"), F.col("q"))).collect():
        a, b = ([tuple(x) for x in r[c]] for c in "ab")
        assert [tuple(x) for x in r["p"]] == hull(a)
        assert r["d"] == pytest.approx(gap(a, b), abs=1e-9)


def test_areas_far_from_the_origin_keep_their_digits(spark):
    ring = dart(4_000_003.5, 3_000_007.25, 10.0)
    got = spark.createDataFrame([(ring, ring + ring[:1], ring[::-1])], f"a {polygons.RING}, b {polygons.RING}, c {polygons.RING}").select(*[polygons.signed_area(F.col(c)) for c in "abc"]).first()
    want = area_in(dart(3.5, 7.25, 10.0), -100, -100, 500, 500)
    assert got[0] == pytest.approx(want, abs=1e-6) and got[1] == got[0] and got[2] == pytest.approx(-want, abs=1e-6)


def test_shares_of_tiles(spark, shapes, frame, tiles):
    got = {(r["grid_id"], r["id"]): r["area"] for r in areas.tile_pieces(tiles, frame, 500.0).collect()}
    want = {}
    for g, x, y in TILES:
        for s in shapes:
            box = (x - 50, y - 50, x + 50, y + 50)
            a = area_in(s[3], *box) - sum(area_in(h, *box) for h in s[4])
            if a > 1e-6:
                want[g, s[0]] = a
    assert {k for k, v in got.items() if v > 1e-6} == set(want)
    assert all(got[k] == pytest.approx(v, abs=1e-6) for k, v in want.items())
    assert areas.tile_pieces(tiles, frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        areas.tile_pieces(tiles, frame, 250.5)


@pytest.mark.parametrize(("by", "buffer"), [("centroids", 0.0), ("centroids", 130.0), ("tiles", 0.0)])
def test_cover(shapes, frame, by, buffer):
    got = {(r["id"], r["tile_x"], r["tile_y"]) for r in areas.cover(frame, ["id"], (-3000, -3000), by, buffer).collect()}
    want = set()
    for s in shapes:
        every = [e for r in (s[3], *s[4]) for e in sides(r)]
        for x in range(-1450, 2500, 100):
            for y in range(-1450, 2500, 100):
                ok = in_shape(x, y, s) or (buffer > 0 and min(away(x, y, a, b) for a, b in every) <= buffer)
                for a, b in every if by == "tiles" else ():
                    low, high = 0.0, 1.0
                    for p, q, c in ((a[0], b[0], x), (a[1], b[1], y)):
                        u, v = sorted(((c - 50 - p) / (q - p), (c + 50 - p) / (q - p)))
                        low, high = max(low, u), min(high, v)
                    ok = ok or low <= high
                if ok:
                    want.add((s[0], float(x), float(y)))
    assert got == want
    assert areas.cover(frame.limit(0), ["id"], (0, 0), by, buffer).count() == 0


def test_ids_of_covering_tiles(frame):
    from cellscape.functions import grid

    t = areas.cover(frame, ["id"], (-3000, -3000))
    x, y = grid.centroid(F.col("grid_id"), F.lit(0).cast("long"))
    assert t.where((x - 3000 != F.col("tile_x")) | (y - 3000 != F.col("tile_y"))).count() == 0


def test_lines(spark, tiles):
    draw = random.Random(5)
    lines = [("abd"[i % 3], [(draw.uniform(-900, 900), draw.uniform(-900, 900)) for _ in range(3)]) for i in range(9)]
    lines += [("a", [(0.0, 0.0)]), ("a", []), ("b", [(20.0, 30.0), (20.0, 30.0)]), ("b", [(-900.0, 550.0), (900.0, 550.0)]), ("a", [(150.0, -900.0), (150.0, 900.0)])]
    widths = {"a": 40.0, "b": 110.0, "unknown": 25.0}
    got = {(r[0], r[1]) for r in areas.near_lines(tiles, spark.createDataFrame(lines, f"category string, line {polygons.RING}"), widths).collect()}
    near = lambda x, y, a, b, w: (math.hypot(x - a[0], y - a[1]) if a == b else away(x, y, a, b)) <= w
    want = {(g, c) for g, x, y in TILES for c, line in lines if any(near(x, y, a, b, widths.get(c, 25.0)) for a, b in zip(line, line[1:]))}
    assert got == want


def test_overlay_counts_each_point_once(shapes, frame, tiles):
    got = {(r["grid_id"], r["category"]): r["area"] for r in areas.overlay(tiles, frame, "rest", 500.0).collect()}
    sums = defaultdict(float)
    for (g, _), a in got.items():
        assert a > 0
        sums[g] += a
    assert len(sums) == len(TILES) and all(s == pytest.approx(10_000, abs=1e-6) for s in sums.values())
    n = 40
    for g, x, y in TILES:
        if (g, "rest") in got and got[g, "rest"] > 9999:
            continue
        seen = defaultdict(int)
        for a in range(n):
            for b in range(n):
                px, py = x - 50 + (a + 0.5) * 100 / n, y - 50 + (b + 0.5) * 100 / n
                seen[min(((s[2], s[1]) for s in shapes if in_shape(px, py, s)), default=(9, "rest"))[1]] += 1
        assert all(got.get((g, c), 0) == pytest.approx(seen[c] * 10_000 / n / n, abs=60) for c in ("a", "b", "c", "rest"))


def test_outlines(spark):
    """Rings close, turn at each corner, enclose just their tiles, and tiles that touch at a corner stay apart."""
    draw = random.Random(2)
    rows = [(f"z{int(draw.random() < 0.4)}", 100.0 * e + 50, 100.0 * n + 50) for e in range(14) for n in range(14)]
    rows += [("touch", 50.0, 50.0), ("touch", 150.0, 150.0), ("touch", 150.0, 150.0)] + [("frame", 100.0 * e - 450, 100.0 * n - 450) for e in range(5) for n in range(5) if (e, n) != (2, 2)]
    got = defaultdict(list)
    for r in areas.outlines(spark.createDataFrame(rows, "zone string, tile_x double, tile_y double"), "zone").collect():
        got[r["zone"]].append(([tuple(p) for p in r["ring"]], r["area"]))
    assert sorted(a for _, a in got["touch"]) == [10_000, 10_000]
    assert sorted((len(r), a) for r, a in got["frame"]) == [(4, -10_000), (4, 250_000)]
    for zone, found in got.items():
        own = {(x, y) for z, x, y in rows if z == zone}
        assert sum(a for _, a in found) == 10_000 * len(own)
        for ring, _ in found:
            for (a, b), (_, c) in zip(sides(ring), sides(ring)[1:] + sides(ring)[:1]):
                assert (a[0] == b[0]) != (a[1] == b[1]) and (b[0] == c[0]) != (b[1] == c[1]) and (a[0] == b[0]) == (b[1] == c[1])
        for x, y in {(x, y) for _, x, y in rows}:
            assert (sum(inside(x, y, r) for r, _ in found) % 2 == 1) == ((x, y) in own)
    assert areas.outlines(spark.createDataFrame([], "zone string, tile_x double, tile_y double"), "zone").count() == 0


def test_nearby_hulls_meet_once_and_by_day(spark):
    rows = [(d, c, polygons_of) for d in ("x", "y") for c, polygons_of in (("a", [(0.0, 0.0), (100.0, 0.0), (0.0, 100.0)]), ("b", [(150.0, 0.0)]), ("c", [(20.0, 20.0), (30.0, 20.0)]), ("d", [(5000.0, 0.0)]))]
    hulls = spark.createDataFrame([(d, c, p if d == "x" else p[:1]) for d, c, p in rows], f"date string, cell_id string, hull {polygons.RING}")
    got = {(r["date"], r["cell_id_a"], r["cell_id_b"]): r["distance"] for r in coverage.nearby_hulls(hulls, 120.0, 10.0, ("date",)).collect()}
    pair = {k[1:]: v for k, v in got.items() if k[0] == "x" and k[2]}
    assert pair == {("a", "b"): 30.0, ("b", "a"): 30.0, ("a", "c"): 0.0, ("c", "a"): 0.0, ("b", "c"): pytest.approx(math.hypot(120, 20) - 20), ("c", "b"): pytest.approx(math.hypot(120, 20) - 20)}
    assert {k for k in got if k[2] is None} == {(d, c, None) for d in "xy" for c in "abcd"}
    assert got["y", "a", "c"] == pytest.approx(math.hypot(20, 20) - 20)


@pytest.mark.parametrize("held", [4, batches.HELD])
def test_distances_of_many_hulls_are_those_of_each_pair(spark, held, monkeypatch):
    """Points, lines, closed rings, hulls that touch, cross and hold each other, and none; also where a pair is more than is held at once."""
    monkeypatch.setattr(batches, "HELD", held)
    rng = random.Random(7)
    some = lambda: [(float(rng.randint(0, w)) + x, float(rng.randint(0, w)) + y) for w, x, y in [(rng.choice((1, 3, 9)), rng.randint(-6, 6) + 4e6, rng.randint(-6, 6) / 3)] for _ in range(rng.choice((1, 1, 2, 3, 5, 40)))]
    df = spark.createDataFrame([(i, some(), some()) for i in range(800)], f"i int, a {polygons.RING}, b {polygons.RING}")
    hulls = df.select("i", *[polygons.hull(F.col(c)).alias(c) for c in "ab"]).withColumn("a", F.when(F.col("i") % 3 == 0, F.concat("a", F.slice("a", 1, 1))).otherwise(F.col("a"))).localCheckpoint()
    want = hulls.select("i", polygons.hull_distance(F.col("a"), F.col("b")).alias("d")).orderBy("i").collect()
    table = hulls.orderBy("i").toArrow()
    a, b = (batches.packed(table[c].combine_chunks())[0] for c in "ab")
    assert batches.distances(a, b).tolist() == [r["d"] for r in want]
    assert batches.distances(a.slice(300, 100), b.slice(300, 100)).tolist() == [r["d"] for r in want[300:400]]
    none, boxes = batches.packed(pa.array([None, [], [{"x": 1.0, "y": 4.0}, {"x": 3.0, "y": 2.0}]], table["a"].type))
    assert none.null_count == 2 and [x.tolist()[2] for x in boxes] == [1.0, 2.0, 3.0, 4.0]
    assert [x == x for x in batches.distances(none, a.slice(0, 3)).tolist()] == [False, False, True]


def test_nearby_hulls_take_pairs_in_whole_batches(spark):
    """A fold over the sides of each pair takes a tenth of a millisecond, and batches of a few rows about as much."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")  # as another operator of the session may have left it
    hulls = spark.createDataFrame([(f"c{i:02d}", [(i * 10.0, 0.0)]) for i in range(40)], f"cell_id string, hull {polygons.RING}")
    near = coverage.nearby_hulls(hulls, 100.0)
    assert "MapInArrow" in near._jdf.queryExecution().executedPlan().toString()
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) >= 1000
    assert near.where("cell_id_b is not null").count() == sum(abs(i - j) <= 10 for i in range(40) for j in range(40) if i != j)


def test_overlap_groups_drop_far_pairs_before_they_are_shuffled(spark):
    pairs = spark.createDataFrame([("a", None, 0.0), ("b", None, 0.0), ("c", None, 0.0), ("a", "b", 5.0), ("b", "a", 5.0), ("b", "c", 5.5), ("c", "b", 5.5)], "cell_id_a string, cell_id_b string, distance double")
    groups = coverage.overlap_groups(pairs, 2.5)
    assert {r["cell_id"]: r["overlapping_cell_ids"] for r in groups.collect()} == {"a": ["b"], "b": ["a"], "c": []}
    plan = groups._jdf.queryExecution().optimizedPlan().toString()
    assert "<= 5.0" in plan.split("Aggregate")[-1].split("\n", 1)[1]
