"""Registered queries over the demonstration views, with the SQL that each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import areas, cleaning, coverage, environment, lattice, mobility, quality, stored

Query = Callable[[SparkSession, str], DataFrame]
_MODULES = (lattice, areas, cleaning, coverage, environment, mobility, quality, stored)


def queries() -> dict[str, Query]:
    return {k: q for m in _MODULES for k, (q, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, (_, s) in m.QUERIES.items() if s}
