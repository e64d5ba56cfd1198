"""Geometries in well-known binary, as GeoParquet files hold them: points, lines and polygons, single and multiple, in both byte orders.

A decoded geometry is a struct: ``kind`` (point, line or polygon) and ``parts``, an array of parts, each an array of rings, each an
array of points. A point is one part of one ring of one point, a line one ring a part; of a polygon's rings the first is the
outer one. Heights, measures and reference systems are read over.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.polygons import RING

GEOMETRY = f"struct<kind:string,parts:array<array<{RING}>>>"
KINDS = ("point", "line", "polygon")

Parts = list[list[np.ndarray]]
_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_TYPE = pa.struct([("kind", pa.string()), ("parts", pa.list_(pa.list_(pa.list_(_POINT))))])


class Malformed(ValueError):
    """Bytes that are no geometry of these kinds."""


class _Reader:
    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0

    def take(self, form: str) -> int:
        size = struct.calcsize(form)
        if self.at + size > len(self.data):
            raise Malformed("it ends early")
        (value,) = struct.unpack_from(form, self.data, self.at)
        self.at += size
        return value

    def head(self) -> tuple[str, int, int]:
        """(byte order, kind from 1 to 6, coordinates of a point)."""
        order = self.take("B")
        if order > 1:
            raise Malformed(f"byte order {order}")
        end = "<>"[1 - order]
        code = self.take(f"{end}I")
        z, m, named = bool(code & 0x80000000), bool(code & 0x40000000), code & 0x20000000
        thousand, kind = divmod(code & 0x0FFFFFFF, 1000)
        if thousand > 3 or not 1 <= kind <= 6:
            raise Malformed(f"kind {code}")
        if named:
            self.take(f"{end}I")
        return end, kind, 2 + (z or thousand in (1, 3)) + (m or thousand in (2, 3))

    def points(self, end: str, width: int, n: int) -> np.ndarray:
        size = 8 * width * n
        if self.at + size > len(self.data):
            raise Malformed("it ends early")
        values = np.frombuffer(self.data, f"{end}f8", width * n, self.at).reshape(n, width)[:, :2]
        self.at += size
        return values.astype(np.float64)

    def one(self, end: str, kind: int, width: int) -> list[np.ndarray]:
        if kind == 1:
            return [self.points(end, width, 1)]
        if kind == 2:
            return [self.points(end, width, self.take(f"{end}I"))]
        return [self.points(end, width, self.take(f"{end}I")) for _ in range(self.counted(end, 4))]

    def counted(self, end: str, least: int) -> int:
        """A number of things of at least ``least`` bytes each, that there is room for."""
        n = self.take(f"{end}I")
        if n * least > len(self.data) - self.at:
            raise Malformed(f"{n} parts don't fit")
        return n

    def geometry(self) -> tuple[str, Parts]:
        end, kind, width = self.head()
        if kind <= 3:
            return KINDS[kind - 1], [self.one(end, kind, width)]
        parts = []
        for _ in range(self.counted(end, 5)):
            own, inner, wide = self.head()
            if inner != kind - 3:
                raise Malformed(f"kind {inner} within kind {kind}")
            parts.append(self.one(own, inner, wide))
        return KINDS[kind - 4], parts


def decode(data: bytes) -> tuple[str, Parts]:
    """(kind, parts) of one geometry; ``Malformed`` for anything else, and for bytes that are left over."""
    reader = _Reader(data)
    out = reader.geometry()
    if reader.at != len(data):
        raise Malformed("bytes are left over")
    return out


def encode(kind: str, parts: Parts, big: bool = False, multi: bool = False) -> bytes:
    """Bytes of a geometry; several parts make it a multiple one."""
    end, order = (">", b"\0") if big else ("<", b"\1")
    code = KINDS.index(kind) + 1
    points = lambda ring: np.asarray(ring, dtype=f"{end}f8").tobytes()

    def one(rings: list) -> bytes:
        head = order + struct.pack(f"{end}I", code)
        if code == 1:
            return head + points(rings[0])
        count = struct.pack(f"{end}I", len(rings)) if code == 3 else b""
        return head + count + b"".join(struct.pack(f"{end}I", len(r)) + points(r) for r in rings)

    if len(parts) == 1 and not multi:
        return one(parts[0])
    return order + struct.pack(f"{end}II", code + 3, len(parts)) + b"".join(map(one, parts))


def nested(found: list[tuple[str, Parts] | None]) -> pa.Array:
    """Decoded geometries as one Arrow array: three levels of offsets over two columns of coordinates."""
    parts = [p for g in found if g for p in g[1]]
    rings = [r for p in parts for r in p]
    xy = np.concatenate([np.zeros((0, 2)), *rings])
    sums = lambda n: np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], fields=list(_POINT))
    rows = pa.ListArray.from_arrays(sums([len(r) for r in rings]), points)
    rows = pa.ListArray.from_arrays(sums([len(p) for p in parts]), rows)
    rows = pa.ListArray.from_arrays(sums([len(g[1]) if g else 0 for g in found]), rows)
    none = pa.array([g is None for g in found])
    return pa.StructArray.from_arrays([pa.array([g[0] if g else None for g in found], pa.string()), rows], fields=list(_TYPE), mask=none)


def with_geometry(df: DataFrame, column: str = "geometry", into: str = "shape") -> DataFrame:
    """``df`` plus ``into``: the geometry that ``column`` (binary) holds; null for null and for malformed bytes. See ``malformed``."""
    if into in df.columns:
        raise ValueError(f"there is a column {into} already")
    kept = df.columns

    def tried(data: bytes | None) -> tuple[str, Parts] | None:
        try:
            return None if data is None else decode(data)
        except Malformed:
            return None

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), nested([tried(x) for x in b.column(1).to_pylist()])], names=["row", "shape"])

    ready = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(column).cast("binary").alias("data"))
    made = ready.mapInArrow(decoded, f"row {ready.schema['row'].dataType.simpleString()}, shape {GEOMETRY}")
    return made.select(*[F.col("row").getField(c).alias(c) for c in kept], F.col("shape").alias(into))


def malformed(df: DataFrame, column: str = "geometry", shape: str = "shape") -> DataFrame:
    """(rows, malformed): how many rows there are, and how many hold bytes that gave no geometry."""
    return df.agg(F.count("*").alias("rows"), F.count_if(F.col(column).isNotNull() & F.col(shape).isNull()).alias("malformed"))


def polygons_of(df: DataFrame, shape: str = "shape") -> DataFrame:
    """A row for each part of each polygon, with ``ring`` and ``holes`` as the operators on areas take them."""
    part = F.col("_part")
    out = df.where(F.col(f"{shape}.kind") == "polygon").withColumn("_part", F.explode(f"{shape}.parts")).where(F.size("_part") > 0)
    return out.withColumns({"ring": part[0], "holes": F.slice(part, F.lit(2), F.greatest(F.size(part) - 1, F.lit(0)))}).drop("_part", shape)


def lines_of(df: DataFrame, shape: str = "shape") -> DataFrame:
    """A row for each part of each line, with ``line``, an array of points."""
    return df.where(F.col(f"{shape}.kind") == "line").withColumn("line", F.explode(F.transform(f"{shape}.parts", lambda p: p[0]))).drop(shape)


def with_wkb(df: DataFrame, shape: str, into: str = "geometry", big: Column | bool = False) -> DataFrame:
    """``df`` plus ``into``: the bytes of a geometry struct, most significant byte first where ``big``."""
    kept = df.columns

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [
                None if s is None else encode(s["kind"], [[[(p["x"], p["y"]) for p in r] for r in part] for part in s["parts"]], bool(big))
                for s, big in zip(b.column(1).to_pylist(), b.column(2).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["row", "data"])

    ready = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(shape).cast(GEOMETRY).alias("shape"), (big if isinstance(big, Column) else F.lit(big)).alias("big"))
    made = ready.mapInArrow(encoded, f"row {ready.schema['row'].dataType.simpleString()}, data binary")
    return made.select(*[F.col("row").getField(c).alias(c) for c in kept], F.col("data").alias(into))
