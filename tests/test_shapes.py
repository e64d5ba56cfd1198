"""Well-known binary and shapefiles: round trips, both byte orders, malformed bytes, ranges of records."""

import datetime
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellscape.sources import shapefile, wkb

SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
HOLE = [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (1.0, 1.0)]
FAR = [(x + 10.0, y) for x, y in SQUARE]
GEOMETRIES = [
    ("point", [[[(1.5, -2.25)]]]), ("point", [[[(1.0, 2.0)]], [[(3.0, 4.0)]]]), ("line", [[SQUARE[:3]]]), ("line", [[SQUARE[:2]], [FAR[:3]]]), ("line", [[[]]]),
    ("polygon", [[SQUARE, HOLE]]), ("polygon", [[SQUARE, HOLE], [FAR]]), ("polygon", [[]]),
]


def plain(found):
    return found[0], [[[tuple(map(float, p)) for p in r] for r in part] for part in found[1]]


@pytest.mark.parametrize("big", [False, True])
def test_round_trip(big):
    for kind, parts in GEOMETRIES:
        assert plain(wkb.decode(wkb.encode(kind, parts, big))) == (kind, parts)
    assert plain(wkb.decode(wkb.encode("polygon", [[SQUARE]], big, multi=True))) == ("polygon", [[SQUARE]])


def test_heights_measures_and_reference_systems_are_read_over():
    xyz = struct.pack("<6d", 1, 2, 9, 3, 4, 9)
    for code in (1002, 0x80000002):
        assert plain(wkb.decode(b"\1" + struct.pack("<II", code, 2) + xyz)) == ("line", [[[(1.0, 2.0), (3.0, 4.0)]]])
    assert plain(wkb.decode(b"\0" + struct.pack(">III", 0x20000002, 3035, 1) + struct.pack(">2d", 7, 8))) == ("line", [[[(7.0, 8.0)]]])
    assert plain(wkb.decode(b"\1" + struct.pack("<I", 3001) + struct.pack("<4d", 1, 2, 8, 9))) == ("point", [[[(1.0, 2.0)]]])
    mixed = b"\0" + struct.pack(">II", 6, 2) + wkb.encode("polygon", [[SQUARE]]) + wkb.encode("polygon", [[FAR]], True)
    assert plain(wkb.decode(mixed)) == ("polygon", [[SQUARE], [FAR]])


def test_malformed_bytes_are_told():
    good = [wkb.encode(k, p, big) for k, p in GEOMETRIES for big in (False, True)]
    for g in good:
        for bad in (g[:-1], g + b"\0", b"\2" + g[1:], g[:1] + b"\x63\0\0\x63" + g[5:], b""):
            with pytest.raises(wkb.Malformed):
                wkb.decode(bad)
        for k in range(len(g)):  # no other failure, whatever is cut
            with pytest.raises(wkb.Malformed):
                wkb.decode(g[:k])
    with pytest.raises(wkb.Malformed):
        wkb.decode(b"\1" + struct.pack("<II", 3, 0xFFFFFFFF))
    with pytest.raises(wkb.Malformed):
        wkb.decode(b"\1" + struct.pack("<II", 6, 1) + wkb.encode("line", [[SQUARE]]))


def test_frames_of_geometries(spark):
    rows = [(i, bytearray(wkb.encode(k, p, i % 2 == 1)), "x") for i, (k, p) in enumerate(GEOMETRIES)] + [(98, bytearray(b"\1\2"), "x"), (99, None, "x")]
    df = wkb.with_geometry(spark.createDataFrame(rows, "row long, geometry binary, data string"))
    assert df.columns == ["row", "geometry", "data", "shape"]
    got = {r["row"]: r["shape"] for r in df.collect()}
    for i, want in enumerate(GEOMETRIES):
        assert plain(got[i]) == want
    assert got[98] is None and got[99] is None
    assert tuple(wkb.malformed(df).first()) == (len(rows), 1)
    assert {(r["row"], len(r["ring"]), len(r["holes"])) for r in wkb.polygons_of(df).collect()} == {(5, 5, 1), (6, 5, 1), (6, 5, 0)}
    assert sorted((r["row"], len(r["line"])) for r in wkb.lines_of(df).collect()) == [(2, 3), (3, 2), (3, 3), (4, 0)]
    again = wkb.with_wkb(df, "shape", "bytes", F.col("row") % 2 == 1).where("row < 90").collect()
    assert all(bytes(r["bytes"]) == bytes(r["geometry"]) for r in again)
    assert wkb.with_geometry(spark.createDataFrame([], "geometry binary")).count() == 0
    with pytest.raises(ValueError):
        wkb.with_geometry(df)


def write_shapefile(base, kind, shapes, fields, rows):
    """``shapes``: None, a point, or (rings); a field is (name, type, size, decimals)."""
    body, index, at = b"", b"", 100
    for k, s in enumerate(shapes):
        if s is None:
            content = struct.pack("<i", 0)
        elif kind == 1:
            content = struct.pack("<i2d", 1, *s)
        else:
            points = [p for r in s for p in r]
            begins = np.cumsum([0] + [len(r) for r in s[:-1]]).tolist()
            content = struct.pack("<i4dii", kind, 0, 0, 0, 0, len(s), len(points)) + struct.pack(f"<{len(s)}i", *begins) + b"".join(struct.pack("<2d", *p) for p in points)
        body += struct.pack(">ii", k + 1, len(content) // 2) + content
        index += struct.pack(">ii", at // 2, len(content) // 2)
        at += 8 + len(content)
    head = lambda size: struct.pack(">i5ii", 9994, 0, 0, 0, 0, 0, size // 2) + struct.pack("<ii8d", 1000, kind, *[0.0] * 8)
    (base.with_suffix(".shp")).write_bytes(head(100 + len(body)) + body)
    (base.with_suffix(".shx")).write_bytes(head(100 + len(index)) + index)
    size = 1 + sum(f[2] for f in fields)
    dbf = struct.pack("<B3BIHH20x", 3, 124, 1, 1, len(rows), 33 + 32 * len(fields), size)
    dbf += b"".join(n.encode().ljust(11, b"\0") + t.encode() + bytes(4) + bytes([w, d]) + bytes(14) for n, t, w, d in fields) + b"\r"
    dbf += b"".join(b" " + b"".join(v.encode().ljust(f[2])[: f[2]] for v, f in zip(r, fields)) for r in rows) + b"\x1a"
    (base.with_suffix(".dbf")).write_bytes(dbf)


FIELDS = [("NAME", "C", 12, 0), ("COUNT", "N", 9, 0), ("SHARE", "N", 12, 4), ("DAY", "D", 8, 0), ("OPEN", "L", 1, 0)]


def test_shapefile_of_polygons_in_ranges(spark, tmp_path):
    spark.dataSource.register(shapefile.Shapefile)
    outer = lambda k: [(x + 10.0 * k, y) for x, y in SQUARE[::-1]]  # noqa: E731  clockwise
    hole = lambda k: [(x + 10.0 * k, y) for x, y in HOLE[::-1]]
    shapes = [None if k % 10 == 3 else [outer(k), outer(k + 500), hole(k + 500)] if k % 2 else [hole(k), outer(k)] for k in range(57)]
    rows = [(f"zöne {k}", str(k) if k % 7 else "", f"{k / 8:.4f}", f"2024010{k % 9 + 1}" if k % 5 else "", "TF?"[k % 3]) for k in range(57)]
    write_shapefile(tmp_path / "zones", 5, shapes, FIELDS, rows)
    df = spark.read.format("shapefile").option("records", 10).load(str(tmp_path / "zones.shp"))
    assert df.rdd.getNumPartitions() == 6
    assert [f.dataType.simpleString() for f in df.schema][2:] == ["string", "bigint", "double", "date", "boolean"]
    got = {r["record"]: r for r in df.collect()}
    assert sorted(got) == list(range(57))
    for k, r in got.items():
        if k % 10 == 3:
            assert r["shape"] is None
        else:
            want = [[outer(k)], [outer(k + 500), hole(k + 500)]] if k % 2 else [[outer(k), hole(k)]]
            assert plain(r["shape"]) == ("polygon", want)
        assert r["NAME"] == f"zöne {k}" and r["COUNT"] == (k if k % 7 else None) and r["SHARE"] == round(k / 8, 4)
        assert r["DAY"] == (datetime.date(2024, 1, k % 9 + 1) if k % 5 else None) and r["OPEN"] == (True, False, None)[k % 3]
    assert wkb.polygons_of(df).count() == sum(1 if s and len(s) == 2 else 2 for s in shapes if s)
    assert spark.read.format("shapefile").load(f"file://{tmp_path}/zones.shp").where("COUNT > 50").count() == 5  # 56 is a multiple of 7


def test_shapefiles_of_points_lines_and_nothing(spark, tmp_path):
    spark.dataSource.register(shapefile.Shapefile)
    read = lambda name: spark.read.format("shapefile").load(str(tmp_path / name)).orderBy("record").collect()
    write_shapefile(tmp_path / "p", 1, [(1.0, 2.0), None], FIELDS[:1], [("a",), ("b",)])
    assert [r["shape"] and plain(r["shape"]) for r in read("p")] == [("point", [[[(1.0, 2.0)]]]), None]
    write_shapefile(tmp_path / "l", 3, [[SQUARE[:2], FAR[:3]]], FIELDS[:1], [("a",)])
    assert plain(read("l")[0]["shape"]) == ("line", [[SQUARE[:2]], [FAR[:3]]])
    write_shapefile(tmp_path / "none", 5, [], FIELDS, [])
    assert read("none") == []
    write_shapefile(tmp_path / "odd", 1, [(1.0, 2.0)], FIELDS[:1], [])
    with pytest.raises(Exception, match="rows of attributes"):
        read("odd")
