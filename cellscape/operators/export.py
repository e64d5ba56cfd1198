"""Export: roll-up to zones, scaling to the population, anonymity, and the sum over operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..codes import INSPIRE_1KM, INSPIRE_100M
from ..functions import grid
from ..plans.iterate import cut
from ..schemas import Table, assert_conforms, audit
from .zoning import zone_at_level


def select_case(df: DataFrame, equals: Mapping[str, object], between: Mapping[str, tuple[object, object]] | None = None) -> DataFrame:
    """Rows of a use case: equal values (null: null), and inclusive ranges."""
    for c, v in equals.items():
        df = df.where(F.col(c).eqNullSafe(F.lit(v)))
    for c, (lo, hi) in (between or {}).items():
        df = df.where(F.col(c).between(lo, hi))
    return df


def hierarchy_rollup(df: DataFrame, zones: DataFrame, levels: Sequence[int], value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., level, zone_id, value): sums over the tiles of each zone at every level, in one pass. Paths that end above a level don't count in it."""
    joined = df.join(zones.select("grid_id", "hierarchical_id"), "grid_id").withColumn("level", F.explode(F.array(*[F.lit(x) for x in levels])))
    at = joined.withColumn("zone_id", zone_at_level(F.col("hierarchical_id"), F.col("level"))).where("zone_id is not null")
    return at.groupBy(*by, "level", "zone_id").agg(F.sum(value).alias(value))


def grid_rollup(df: DataFrame, zoning: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Sums by INSPIRE name at 100 m or 1 km; needs grid_id and origin."""
    if zoning not in (INSPIRE_100M, INSPIRE_1KM):
        raise ValueError(f"not a grid zoning: {zoning}")
    name = grid.inspire_id(F.col("grid_id"), F.col("origin"), 1000 if zoning == INSPIRE_1KM else 100)
    return df.groupBy(*by, name.alias("zone_id")).agg(F.sum(value).alias(value))


def scale(df: DataFrame, columns: Sequence[str], factor: float | Column) -> DataFrame:
    return df.withColumns({c: F.col(c) * factor for c in columns})


def scale_by_country(df: DataFrame, factors: DataFrame, columns: Sequence[str], factor: str, default: float, country: str = "country_of_origin") -> DataFrame:
    """By each row's country factor (iso2, factor), or the default where the country or its factor is missing."""
    own = factors.select(F.col("iso2").alias("_iso"), F.col(factor).alias("_factor"))
    out = df.join(own, F.col(country) == F.col("_iso"), "left")
    return scale(out, columns, F.coalesce("_factor", F.lit(default))).drop("_iso", "_factor")


def obfuscate(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """Values below k become -1."""
    return df.withColumns({c: F.when(F.col(c) < k, F.lit(-1.0)).otherwise(F.col(c)) for c in columns})


def delete_small(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """Rows in which every value reaches k."""
    for c in columns:
        df = df.where(F.col(c) >= k)
    return df


def output_problems(df: DataFrame, table: Table, required: Sequence[str] = ()) -> DataFrame:
    return audit(df, table, tuple(required))


def aggregate_operators(tables: Sequence[tuple[DataFrame, float]], by: Sequence[str], columns: Sequence[str], like: Table | None = None) -> DataFrame:
    """Weighted sum over operators; obfuscated (negative) records don't count. ``like``: every table must have its exact schema."""
    parts = []
    for df, weight in tables:
        df = assert_conforms(df, like) if like else df
        for c in columns:
            df = df.where(F.col(c) >= 0)
        parts.append(scale(df.select(*by, *columns), columns, weight))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(*by).agg(*[F.sum(c).alias(c) for c in columns])


def written_once(df: DataFrame) -> DataFrame:
    """For exports that several outputs share: computed once, in the shared folder."""
    return cut(df)
