"""Distances, angles and the equal-area projection, as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS = 6371008.8


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres between points in degrees; null where a coordinate is."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return 2 * EARTH_RADIUS * F.asin(F.sqrt(F.when(a > 1, 1.0).otherwise(a)))  # least() would turn null into 1


def planar(x1: Column, y1: Column, x2: Column, y2: Column, z1: Column | None = None, z2: Column | None = None) -> Column:
    """Metres on the plane, or in space where heights are given."""
    square = F.pow(x2 - x1, 2) + F.pow(y2 - y1, 2)
    return F.sqrt(square + F.pow(z2 - z1, 2)) if z1 is not None and z2 is not None else F.sqrt(square)


# The ellipsoid and the origin of the European equal-area grid.
_A, _F = 6378137.0, 1 / 298.257222101
_E2 = _F * (2 - _F)
_E = math.sqrt(_E2)
_LAT0, _LON0, _X0, _Y0 = math.radians(52.0), math.radians(10.0), 4321000.0, 3210000.0


def _q(s: float) -> float:
    return (1 - _E2) * (s / (1 - _E2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


_QP = _q(1.0)
_RQ = _A * math.sqrt(_QP / 2)
_B0 = math.asin(_q(math.sin(_LAT0)) / _QP)
_D = _A * math.cos(_LAT0) / math.sqrt(1 - _E2 * math.sin(_LAT0) ** 2) / (_RQ * math.cos(_B0))


def to_grid(lat: Column, lon: Column) -> tuple[Column, Column]:
    """(easting, northing) of degrees by Lambert azimuthal equal-area projection."""
    s = F.sin(F.radians(lat))
    q = (1 - _E2) * (s / (1 - _E2 * s * s) - F.ln((1 - _E * s) / (1 + _E * s)) / (2 * _E))
    b, dl = F.asin(q / _QP), F.radians(lon) - _LON0
    k = _RQ * F.sqrt(2 / (1 + math.sin(_B0) * F.sin(b) + math.cos(_B0) * F.cos(b) * F.cos(dl)))
    return _X0 + k * _D * F.cos(b) * F.sin(dl), _Y0 + k / _D * (math.cos(_B0) * F.sin(b) - math.sin(_B0) * F.cos(b) * F.cos(dl))


def project(lat: float, lon: float) -> tuple[float, float]:
    """``to_grid`` for one point on the driver, for extents."""
    b, dl = math.asin(_q(math.sin(math.radians(lat))) / _QP), math.radians(lon) - _LON0
    k = _RQ * math.sqrt(2 / (1 + math.sin(_B0) * math.sin(b) + math.cos(_B0) * math.cos(b) * math.cos(dl)))
    return _X0 + k * _D * math.cos(b) * math.sin(dl), _Y0 + k / _D * (math.cos(_B0) * math.sin(b) - math.sin(_B0) * math.cos(b) * math.cos(dl))


def inside(x: Column, y: Column, ring: Column) -> Column:
    """Whether (x, y) is in the polygon whose closed ring is an array of structs (x, y): crossings of a ray, counted."""
    n = F.size(ring)
    a = F.slice(ring, F.lit(1), F.greatest(n - 1, F.lit(0)))
    b = F.slice(ring, F.lit(2), F.greatest(n - 1, F.lit(0)))

    def crosses(p: Column, q: Column) -> Column:
        return ((p["y"] > y) != (q["y"] > y)) & (x < (q["x"] - p["x"]) * F.try_divide(y - p["y"], q["y"] - p["y"]) + p["x"])

    return F.size(F.filter(F.zip_with(a, b, crosses), lambda c: c)) % 2 == 1
