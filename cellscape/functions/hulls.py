"""Distances of many pairs of hulls at once, over Arrow batches in the tasks: what ``polygons.hull_distance`` gives for each pair,
by the same sums. As a Column a pair costs a tenth of a millisecond, which hundreds of millions of pairs haven't got."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Corners of one hull times sides of the other that are held at once.
HELD = 1 << 14


def _listed(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of arrays of points x and y of all, and each ring's first place and number of points, without a first point repeated at the end; 0 for null."""
    x, y = (column.values.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
    offsets = column.offsets.to_numpy()
    begin, n = offsets[:-1].astype(np.int64), np.diff(offsets).astype(np.int64)
    n[column.is_null().to_numpy(zero_copy_only=False)] = 0
    many = np.flatnonzero(n > 1)
    first, last = begin[many], begin[many] + n[many] - 1
    n[many] -= (x[first] == x[last]) & (y[first] == y[last])
    return x, y, begin, n


def packed(column: pa.Array) -> tuple[pa.Array, list[np.ndarray]]:
    """Arrays of points as bytes, each x and y in turn, and their boxes: x0, y0, x1 and y1; null and NaN where there is no point.

    A row's bytes are handed on as they are, where an array of points goes to Arrow number by number in each of its pairs.
    """
    x, y, begin, n = _listed(column)
    ends = np.cumsum(n)
    at = np.repeat(begin - ends + n, n) + np.arange(ends[-1] if len(n) else 0)
    points = np.stack([x[at], y[at]], 1)
    some = np.flatnonzero(n)
    boxes = [np.full(len(n), np.nan) for _ in range(4)]
    for box, f, c in zip(boxes, (np.minimum, np.minimum, np.maximum, np.maximum), (0, 1, 0, 1)) if len(some) else ():
        box[some] = f.reduceat(points[:, c], (ends - n)[some])
    offsets = np.concatenate([[0], 16 * ends]).astype(np.int64)
    known = pa.py_buffer(np.packbits(n > 0, bitorder="little").tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(n), [known, pa.py_buffer(offsets.tobytes()), pa.py_buffer(points.tobytes())]).cast(pa.binary()), boxes


def _rings(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """x and y of all points of rings as bytes, and each ring's first place and number of points; 0 for null."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] // 16 if len(column) else np.zeros(1, np.int64)
    points = np.frombuffer(data, np.float64, 2 * offsets[-1]).reshape(-1, 2) if offsets[-1] else np.zeros((0, 2))
    n = np.diff(offsets)
    n[column.is_null().to_numpy(zero_copy_only=False)] = 0
    return np.ascontiguousarray(points[:, 0]), np.ascontiguousarray(points[:, 1]), offsets[:-1], n


def _sides(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """x, y of the corners (corner, pair), those of the next corner, and the ways there."""
    ends = [np.concatenate([c[1:], c[:1]]) for c in (x, y)]
    return [x, y, *ends, ends[0] - x, ends[1] - y]


def _least(px: np.ndarray, py: np.ndarray, side: list[np.ndarray]) -> np.ndarray:
    """The least square of corners (corner, 1, pair) and sides (side, pair), by pair."""
    x, y, _, _, dx, dy = side
    length = dx * dx + dy * dy
    px, py = px - x, py - y
    along, off, ends = px * dx + py * dy, px * dy - py * dx, px * px + py * py
    beside = (along > 0) & (along < length)
    return np.where(beside, off * off / np.where(length > 0, length, 1.0), ends).min(axis=(0, 1))


def _apart(px: np.ndarray, py: np.ndarray, qx: np.ndarray, qy: np.ndarray) -> np.ndarray:
    """Distances of hulls of as many points each, (point, pair). Those whose boxes are apart can't meet, those that meet are not measured."""
    beyond = (px.max(0) < qx.min(0)) | (qx.max(0) < px.min(0)) | (py.max(0) < qy.min(0)) | (qy.max(0) < py.min(0))
    p, q = _sides(px, py), _sides(qx, qy)
    step = max(1, HELD // len(qx))
    out = np.full(px.shape[1], np.inf)
    near = np.flatnonzero(~beyond)
    if len(near):
        out[near[_meet([c[:, near] for c in p], [c[:, near] for c in q], step)]] = 0.0
    far = np.flatnonzero(out > 0)
    p, q = [c[:, far] for c in p], [c[:, far] for c in q]
    square = np.full(len(far), np.inf)
    for s in range(0, len(px), step):
        part = [c[s : s + step] for c in p]
        for corners, side in ((part, q), (q, part)):
            square = np.minimum(square, _least(corners[0][:, None], corners[1][:, None], side))
    out[far] = np.sqrt(square)
    return out


def _meet(p: list[np.ndarray], q: list[np.ndarray], step: int) -> np.ndarray:
    """Whether a hull holds a corner of the other, or a side of each cross inside both."""
    turn = lambda e, x, y: e[4] * (y - e[1]) - e[5] * (x - e[0])  # noqa: E731  cross() of polygons
    n, m = len(p[0]), len(q[0])
    out, held = np.zeros(p[0].shape[1], bool), np.full(q[0].shape, n > 2)
    for s in range(0, n, step):
        here = [c[s : s + step, None] for c in p]
        begins, ends = turn(q, here[0], here[1]), turn(q, here[2], here[3])  # (side of p, side of q, pair)
        others, next_others = turn(here, q[0], q[1]), turn(here, q[2], q[3])
        if m > 2:
            out |= (begins >= 0).all(axis=1).any(axis=0)
        held &= (others >= 0).all(axis=0)
        out |= ((others * next_others < 0) & (begins * ends < 0)).any(axis=(0, 1))
    return out | held.any(axis=0)


def distances(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Distance of each pair of rings as bytes, NaN where one is null. Pairs of as many points each are taken together."""
    (ax, ay, a0, an), (bx, by, b0, bn) = _rings(a), _rings(b)
    out = np.full(len(an), np.nan)
    order = np.lexsort((bn, an))
    cuts = np.flatnonzero((np.diff(an[order]) != 0) | (np.diff(bn[order]) != 0)) + 1
    for alike in np.split(order, cuts):
        n, m = (int(an[alike[0]]), int(bn[alike[0]])) if len(alike) else (0, 0)
        if n and m:
            most = max(1, HELD // (n * m))
            for i in range(0, len(alike), most):
                k = alike[i : i + most]
                p, q = a0[k] + np.arange(n)[:, None], b0[k] + np.arange(m)[:, None]
                out[k] = _apart(ax[p], ay[p], bx[q], by[q])
    return out


Batches = Iterator[pa.RecordBatch]


def boxed(hull: str) -> Callable[[Batches], Batches]:
    """Batches with ``hull`` as bytes, and columns x0, y0, x1 and y1 of its box after the others."""

    def of(batches: Batches) -> Batches:
        for batch in batches:
            rings, boxes = packed(batch.column(hull))
            columns = [rings if c == hull else batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(b, from_pandas=True) for b in boxes]], names=[*batch.schema.names, "x0", "y0", "x1", "y1"])

    return of


def within(a: str, b: str, distance: float, buffer: float) -> Callable[[Batches], Batches]:
    """Of batches with hulls ``a`` and ``b`` as bytes the rows whose hulls, widened by ``buffer``, are within ``distance``: other columns, then the distance."""

    def of(batches: Batches) -> Batches:
        for batch in batches:
            apart = np.maximum(0.0, distances(batch.column(a), batch.column(b)) - 2 * buffer)  # NaN stays
            near = apart <= distance
            kept = [c for c in batch.schema.names if c not in (a, b)]
            columns = [batch.column(c).filter(pa.array(near)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(apart[near])], names=[*kept, "distance"])

    return of
