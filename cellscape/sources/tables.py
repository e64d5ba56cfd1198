"""Reading and writing declared tables, and files of other formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import Table, conform


def read(spark: SparkSession, table: Table, path: str) -> DataFrame:
    """The table with its declared schema: nothing is inferred."""
    return spark.read.schema(table.schema).parquet(path)


def write(df: DataFrame, table: Table, path: str, mode: str = "append") -> None:
    """Conform to the table and write by its partition columns. ``overwrite`` replaces only the partitions that ``df`` holds."""
    w = conform(df, table).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    (w.partitionBy(*table.partition_by) if table.partition_by else w).parquet(path)


def empty(spark: SparkSession, table: Table) -> DataFrame:
    return spark.createDataFrame([], table.schema)


def read_csv(spark: SparkSession, table: Table, path: str, sep: str = ",", header: bool = True) -> DataFrame:
    return spark.read.schema(table.schema).csv(path, sep=sep, header=header)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, sep=sep, header=True)


def read_json(spark: SparkSession, table: Table, path: str) -> DataFrame:
    return spark.read.schema(table.schema).json(path)


def read_geojson(spark: SparkSession, path: str, properties: str, lines: bool = False) -> DataFrame:
    """Staged features: their properties (DDL), ``ring``, the outer ring of each polygon, and ``holes``; other geometries are left out.

    A feature collection is one value and so one task a file; with ``lines``, files have a feature a line, and are split.
    """
    feature = f"struct<properties: struct<{_as_struct(properties)}>, geometry: struct<type: string, coordinates: array<array<array<double>>>>>"
    if lines:
        f = spark.read.text(path).select(F.from_json("value", feature).alias("f")).where("f is not null")
    else:
        f = spark.read.schema(f"features array<{feature}>").json(path, multiLine=True).select(F.explode("features").alias("f"))
    rings = F.transform("f.geometry.coordinates", lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    polygons = f.where("f.geometry.type = 'Polygon' and size(f.geometry.coordinates) > 0").select("f.properties.*", rings.alias("_rings"))
    holes = F.slice("_rings", F.lit(2), F.greatest(F.size("_rings") - 1, F.lit(0)))
    return polygons.withColumns({"ring": F.element_at("_rings", 1), "holes": holes}).drop("_rings")


def write_geojson(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Polygons (``ring``, ``holes``) as a feature a line, all other columns as properties."""
    pairs = lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"]))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.concat(F.array(pairs(F.col("ring"))), F.transform("holes", pairs)).alias("coordinates"))
    properties = F.struct(*[c for c in df.columns if c not in ("ring", "holes")])
    df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), geometry.alias("geometry"))).alias("value")).write.mode(mode).text(path)


def _as_struct(ddl: str) -> str:
    return ", ".join(": ".join(c.strip().split(" ", 1)) for c in ddl.split(","))


def points_from_wkb(df: DataFrame, column: str = "geometry") -> DataFrame:
    """``x`` and ``y`` of little-endian WKB points, as GeoParquet files hold them."""
    number = lambda at: F.expr(f"substring(hex({column}), {at}, 16)")

    def double(h):
        swapped = F.concat(*[F.substring(h, i, 2) for i in range(15, 0, -2)])
        top = F.conv(F.substring(swapped, 1, 3), 16, 10).cast("int")
        mantissa = F.conv(F.substring(swapped, 4, 13), 16, 10).cast("double") / float(1 << 52)
        exponent = top % 2048
        value = F.when(exponent == 0, mantissa * F.pow(F.lit(2.0), F.lit(-1022))).otherwise((1 + mantissa) * F.pow(F.lit(2.0), exponent - 1023))
        return F.when(top >= 2048, -value).otherwise(value)

    return df.withColumns({"x": double(number(11)), "y": double(number(27))})


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.mkdirs(p)


def partition_values(spark: SparkSession, path: str) -> list[dict[str, str]]:
    """The partitions of a table's folder, from its paths alone."""
    p, fs = _path(spark, path)
    out: list[dict[str, str]] = []

    def walk(at, values: dict[str, str]) -> None:
        inner = [s.getPath() for s in fs.listStatus(at) if s.isDirectory() and "=" in s.getPath().getName()]
        if not inner and values:
            out.append(values)
        for x in inner:
            k, _, v = x.getName().partition("=")
            walk(x, values | {k: v})

    walk(p, {})
    return sorted(out, key=lambda d: sorted(d.items()))
