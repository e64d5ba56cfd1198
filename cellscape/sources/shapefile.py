"""Shapefiles as a Spark data source: ``spark.dataSource.register(Shapefile)``, then ``spark.read.format("shapefile").load(path)``.

The index file (.shx) says where each record of the geometry file (.shp) lies, and rows of the attribute file (.dbf) have one
length; so ranges of records are dealt to tasks (option ``records``: most in a task), and each task reads its bytes of both files
and no others. Paths are opened through Arrow's file systems, so a path may also be a URI that these know.

Columns: ``record`` (from 0), ``shape`` as of ``sources.wkb`` (null for a null shape), then the attributes by their names.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from .wkb import _TYPE, GEOMETRY, nested

# Shape types, without and with heights and measures.
POINTS, LINES, POLYGONS, MULTIPOINTS = (1, 11, 21), (3, 13, 23), (5, 15, 25), (8, 18, 28)
_HEAD = 100


def _open(path: str) -> pa.NativeFile:
    system, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system.open_input_file(inner)


def _read(f: pa.NativeFile, at: int, size: int) -> bytes:
    f.seek(at)
    data = f.read(size)
    if len(data) != size:
        raise ValueError(f"the file ends within {size} bytes from {at}")
    return data


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    at: int
    size: int
    decimals: int

    @property
    def ddl(self) -> str:
        if self.kind == "N":
            return "bigint" if self.decimals == 0 and self.size <= 18 else "double"
        return {"F": "double", "D": "date", "L": "boolean"}.get(self.kind, "string")

    def value(self, raw: bytes, encoding: str) -> object:
        text = raw.decode(encoding, "replace").strip(" \0")
        if self.kind in "NF":
            try:
                return int(text) if self.ddl == "bigint" else float(text)
            except ValueError:
                return None  # blank, or stars where a number didn't fit
        if self.kind == "D":
            return date(int(text[:4]), int(text[4:6]), int(text[6:8])) if len(text) == 8 and text.isdigit() and text > "00010101" else None
        if self.kind == "L":
            return True if text in ("T", "t", "Y", "y") else False if text in ("F", "f", "N", "n") else None
        return text


@dataclass(frozen=True)
class Table:
    """What the head of an attribute file says."""

    rows: int
    head: int
    row: int
    fields: tuple[Field, ...]

    @staticmethod
    def of(path: str) -> Table:
        with _open(path) as f:
            rows, head, row = struct.unpack("<IHH", _read(f, 4, 8))
            data = _read(f, 32, head - 32)
        fields, at = [], 1
        for k in range(0, len(data) - 31, 32):
            if data[k] == 0x0D:
                break
            name = data[k : k + 11].split(b"\0")[0].decode("latin-1")
            fields.append(Field(name, chr(data[k + 11]), at, data[k + 16], data[k + 17]))
            at += data[k + 16]
        return Table(rows, head, row, tuple(fields))


@dataclass
class Records(InputPartition):
    """Records ``first`` to before ``end``."""

    first: int
    end: int

    def __post_init__(self) -> None:
        super().__init__((self.first, self.end))


def shape(data: bytes) -> tuple[str, list[list[np.ndarray]]] | None:
    """(kind, parts) of a record's content; None for a null shape."""
    (kind,) = struct.unpack_from("<i", data)
    if kind == 0:
        return None
    if kind in POINTS:
        return "point", [[np.frombuffer(data, "<f8", 2, 4).reshape(1, 2)]]
    if kind in MULTIPOINTS:
        (n,) = struct.unpack_from("<i", data, 36)
        return "point", [[p.reshape(1, 2)] for p in np.frombuffer(data, "<f8", 2 * n, 40).reshape(n, 2)]
    if kind not in LINES + POLYGONS:
        raise ValueError(f"shape type {kind}")
    parts, n = struct.unpack_from("<ii", data, 36)
    begins = np.frombuffer(data, "<i4", parts, 44)
    xy = np.frombuffer(data, "<f8", 2 * n, 44 + 4 * parts).reshape(n, 2)
    rings = [xy[a:b] for a, b in zip(begins, [*begins[1:], n])]
    return ("line", [[r] for r in rings]) if kind in LINES else ("polygon", grouped(rings))


def turn(ring: np.ndarray) -> float:
    """Twice the ring's signed area: negative for a clockwise one."""
    p = ring - ring[0]
    return float(np.sum(p[:-1, 0] * p[1:, 1] - p[1:, 0] * p[:-1, 1]))


def holds(ring: np.ndarray, x: float, y: float) -> bool:
    a, b = ring[:-1], ring[1:]
    over = (a[:, 1] > y) != (b[:, 1] > y)
    a, b = a[over], b[over]
    return bool(np.count_nonzero(x < (b[:, 0] - a[:, 0]) * (y - a[:, 1]) / (b[:, 1] - a[:, 1]) + a[:, 0]) % 2)


def grouped(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Polygons of an outer ring, clockwise, and its holes: each goes to the smallest outer ring that holds its first point."""
    outer = [[r] for r in rings if turn(r) <= 0]
    if not outer:
        return [[r] for r in rings]
    for hole in (r for r in rings if turn(r) > 0):
        around = [p for p in outer if holds(p[0], *hole[0])] or outer[:1]
        min(around, key=lambda p: abs(turn(p[0]))).append(hole)
    return outer


class Shapefile(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shapefile"

    @property
    def base(self) -> str:
        return self.options["path"].removesuffix(".shp")

    def schema(self) -> str:
        return f"record bigint, shape {GEOMETRY}" + "".join(f", `{f.name}` {f.ddl}" for f in Table.of(f"{self.base}.dbf").fields)

    def reader(self, schema: StructType) -> DataSourceReader:
        return Reader(self.base, int(self.options.get("records", 10_000)), self.options.get("encoding", "utf-8"))


class Reader(DataSourceReader):
    def __init__(self, base: str, most: int, encoding: str) -> None:
        self.base, self.most, self.encoding = base, most, encoding

    def partitions(self) -> list[Records]:
        with _open(f"{self.base}.shx") as f:
            n = (f.size() - _HEAD) // 8
        if n != (rows := Table.of(f"{self.base}.dbf").rows):
            raise ValueError(f"{n} shapes, but {rows} rows of attributes")
        return [Records(k, min(n, k + self.most)) for k in range(0, n, self.most)] or [Records(0, 0)]

    def read(self, partition: Records) -> Iterator[pa.RecordBatch]:
        first, n = partition.first, partition.end - partition.first
        table = Table.of(f"{self.base}.dbf")
        found: list = []
        if n:
            with _open(f"{self.base}.shx") as f:
                index = np.frombuffer(_read(f, _HEAD + 8 * first, 8 * n), ">i4").reshape(n, 2).astype(np.int64) * 2
            low, high = int(index[:, 0].min()), int((index[:, 0] + 8 + index[:, 1]).max())
            with _open(f"{self.base}.shp") as f:
                data = _read(f, low, high - low)
            found = [shape(data[at - low + 8 : at - low + 8 + size]) for at, size in index.tolist()]
        with _open(f"{self.base}.dbf") as f:
            rows = _read(f, table.head + table.row * first, table.row * n)
        kinds = {"bigint": pa.int64(), "double": pa.float64(), "date": pa.date32(), "boolean": pa.bool_(), "string": pa.string()}
        columns = [pa.array(range(first, first + n), pa.int64()), nested(found) if n else pa.array([], _TYPE)]
        for c in table.fields:
            values = [c.value(rows[k * table.row + c.at : k * table.row + c.at + c.size], self.encoding) for k in range(n)]
            columns.append(pa.array(values, kinds[c.ddl]))
        yield pa.RecordBatch.from_arrays(columns, names=["record", "shape", *[c.name for c in table.fields]])
