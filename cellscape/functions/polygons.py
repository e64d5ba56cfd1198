"""Plane geometry on arrays of points (structs x, y), as Column expressions: no geometry engine, no Python on the way.

A ring is an array of points, with or without its first one repeated at the end. What a fold computes once and names often is
bound by ``let``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
RING = f"array<{POINT}>"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def cross(o: Column, a: Column, b: Column) -> Column:
    """Twice the signed area of the triangle: positive where o, a, b turn left."""
    return (a["x"] - o["x"]) * (b["y"] - o["y"]) - (a["y"] - o["y"]) * (b["x"] - o["x"])


def opened(ring: Column) -> Column:
    """The ring without its first point repeated at the end."""
    n = F.size(ring)
    return F.when((n > 1) & (F.get(ring, F.lit(0)) == F.get(ring, n - 1)), F.slice(ring, F.lit(1), n - 1)).otherwise(ring)


def edges(ring: Column) -> Column:
    """Array of structs (a, b): the ring's sides in order, the last one back to the first point; one point is a side by itself."""
    return let(opened(ring), lambda r: F.transform(r, lambda p, i: F.struct(p.alias("a"), F.get(r, (i + 1) % F.size(r)).alias("b"))))


def path(points: Column) -> Column:
    """Array of structs (a, b): the pieces of an open line."""
    n = F.greatest(F.size(points) - 1, F.lit(0))
    return F.zip_with(F.slice(points, F.lit(1), n), F.slice(points, F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def hull(points: Column) -> Column:
    """The convex hull of an array of points, counterclockwise and open, by monotone chain: one point or two ends where there is no area.

    Each point of the sorted array is put on a stack from which the points go that would not turn left; those are its end
    from the last left turn on, so that one slice takes them off.
    """
    none = F.array().cast(RING)

    def put(stack: Column, p: Column) -> Column:
        turns = F.transform(stack, lambda q, i: F.when((i > 0) & (cross(F.get(stack, i - 1), q, p) > 0), i + 1).otherwise(1))
        return F.concat(F.slice(stack, F.lit(1), F.coalesce(F.array_max(turns), F.lit(0))), F.array(p))

    def both(s: Column) -> Column:
        half = lambda r: F.aggregate(r, none, put)
        ends = lambda c: F.slice(c, F.lit(1), F.size(c) - 1)
        return F.when(F.size(s) < 2, s).otherwise(F.concat(let(half(s), ends), let(half(F.reverse(s)), ends)))

    return let(F.array_sort(F.array_distinct(points.cast(RING))), both)


def signed_area(ring: Column) -> Column:
    """Positive for a counterclockwise ring, negative for a clockwise one."""
    from_first = lambda sides: F.aggregate(sides, F.lit(0.0), lambda s, e: s + cross(F.get(sides, F.lit(0))["a"], e["a"], e["b"]) / 2)  # noqa: E731  coordinates are large
    return let(edges(ring), from_first)


def area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def to_segment(p: Column, e: Column) -> Column:
    """Distance from a point to the segment (a, b)."""
    dx, dy = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
    along = F.coalesce(F.try_divide((p["x"] - e["a"]["x"]) * dx + (p["y"] - e["a"]["y"]) * dy, dx * dx + dy * dy), F.lit(0.0))

    def off(t: Column) -> Column:
        return F.sqrt(F.pow(p["x"] - e["a"]["x"] - t * dx, 2) + F.pow(p["y"] - e["a"]["y"] - t * dy, 2))

    return let(F.greatest(F.lit(0.0), F.least(F.lit(1.0), along)), off)


def cross_each_other(e: Column, f: Column) -> Column:
    """Whether two segments cross at a point inside both."""
    return (cross(e["a"], e["b"], f["a"]) * cross(e["a"], e["b"], f["b"]) < 0) & (cross(f["a"], f["b"], e["a"]) * cross(f["a"], f["b"], e["b"]) < 0)


def hull_distance(a: Column, b: Column) -> Column:
    """Distance between two hulls: 0 where they meet, else from a corner of one to a side of the other; null where one is.

    Hulls whose boxes are apart can't meet. Squares are compared: of a corner and a side the distance is to the line where the
    corner lies beside the side, else to the side's first end, as its other end is the next one's first.
    """

    def beyond(p: Column, q: Column) -> Column:
        side = lambda f, r, c: f(F.transform(r, lambda e: e["a"][c]))
        return (
            (side(F.array_max, p, "x") < side(F.array_min, q, "x")) | (side(F.array_max, q, "x") < side(F.array_min, p, "x"))
            | (side(F.array_max, p, "y") < side(F.array_min, q, "y")) | (side(F.array_max, q, "y") < side(F.array_min, p, "y"))
        )

    def square(p: Column, e: Column) -> Column:
        dx, dy = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
        px, py = p["x"] - e["a"]["x"], p["y"] - e["a"]["y"]
        along = px * dx + py * dy
        return F.when((along > 0) & (along < dx * dx + dy * dy), (px * dy - py * dx) * (px * dy - py * dx) / (dx * dx + dy * dy)).otherwise(px * px + py * py)

    def of(p: Column, q: Column) -> Column:  # sides
        holds = lambda sides, x: (F.size(sides) > 2) & F.forall(sides, lambda e: cross(e["a"], e["b"], x) >= 0)
        meet = F.exists(p, lambda e: holds(q, e["a"])) | F.exists(q, lambda e: holds(p, e["a"])) | F.exists(p, lambda e: F.exists(q, lambda f: cross_each_other(e, f)))
        least = lambda s, t: F.array_min(F.transform(s, lambda e: F.array_min(F.transform(t, lambda f: square(e["a"], f)))))
        return F.when(~beyond(p, q) & meet, F.lit(0.0)).otherwise(F.sqrt(F.least(least(p, q), least(q, p))))

    known = a.isNotNull() & b.isNotNull()
    return F.when(known, let(edges(a), lambda p: let(edges(b), lambda q: of(p, q))))


def clip(ring: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """The ring cut to a box, one side of the box after another (Sutherland-Hodgman); empty where they don't meet.

    A ring that the box parts stays one, its parts joined along the box's sides, so its area is right.
    """

    def half(axis: str, other: str, limit: Column, sign: int) -> Callable[[Column], Column]:
        inside = lambda p: (p[axis] - limit) * sign >= 0

        def cut(e: Column) -> Column:
            a, b = e["a"], e["b"]
            v = a[other] + (b[other] - a[other]) * F.try_divide(limit - a[axis], b[axis] - a[axis])
            at = point(limit, v) if axis == "x" else point(v, limit)
            turn = F.when(inside(a) != inside(b), F.array(at)).otherwise(F.array().cast(RING))
            return F.concat(F.when(inside(a), F.array(a)).otherwise(F.array().cast(RING)), turn)

        return lambda r: F.flatten(F.transform(edges(r), cut))

    out = opened(ring.cast(RING))
    for axis, other, limit, sign in (("x", "y", x0, 1), ("x", "y", x1, -1), ("y", "x", y0, 1), ("y", "x", y1, -1)):
        out = let(out, half(axis, other, limit.cast("double"), sign))
    return out


def rows_met(e: Column, size: float) -> Column:
    """Array of structs (e, n): the squares of a lattice of ``size`` that a segment passes, column by column.

    Squares are half-open: one belongs to the square whose lower left sides it lies on.
    """
    x0, x1 = F.least(e["a"]["x"], e["b"]["x"]), F.greatest(e["a"]["x"], e["b"]["x"])
    y0, y1 = F.least(e["a"]["y"], e["b"]["y"]), F.greatest(e["a"]["y"], e["b"]["y"])
    slope = F.try_divide(e["b"]["y"] - e["a"]["y"], e["b"]["x"] - e["a"]["x"])
    at = lambda x: F.greatest(y0, F.least(y1, e["a"]["y"] + (x - e["a"]["x"]) * slope))
    cell = lambda v: F.floor(v / size)

    def column(c: Column) -> Column:
        left, right = at(F.greatest(x0, c * size)), at(F.least(x1, (c + 1) * size))
        low, high = F.coalesce(F.least(left, right), y0), F.coalesce(F.greatest(left, right), y1)
        return F.transform(F.sequence(cell(low), cell(high)), lambda r: F.struct(c.alias("e"), r.alias("n")))

    return F.flatten(F.transform(F.sequence(cell(x0), cell(x1)), column))
