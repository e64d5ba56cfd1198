"""Helpers shared by the training-data operators."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share (``spark.checkpoint.dir``).

    Only where a local session names none, as in tests, a temporary folder is set; a cluster must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="cellscape-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    (df if partitions is None else df.coalesce(partitions)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a superseded ``table()``."""
    spark = df.sparkSession
    jvm = spark._jvm
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores before it as it takes for ``df`` not to have it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def with_row_key(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` plus two columns, and their names: the file and the place in it of every row.

    So rows that repeat an id, or have none, stay apart. The key is the same however often the frame is read. A frame
    that doesn't read Parquet files is written first.
    """
    names = free(df, "row_file", "row_place")
    key = (F.xxhash64("_metadata.file_path").alias(names[0]), F.col("_metadata.row_index").alias(names[1]))
    try:
        keyed = df.select("*", *key)
        keyed.schema  # noqa: B018  (analysis finds whether there are files)
        return keyed, names
    except AnalysisException:
        return table(df, "keyed").select("*", *key), names


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only; a text of ASCII alone by the faster function that would lower-case other letters too."""
    return F.when(F.octet_length(column) == F.length(column), F.lower(column)).otherwise(F.translate(column, _UPPER, _LOWER))


def crc_bucket(column: Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus`` (null counts as the empty text)."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def hashed_sample(df: DataFrame, keys: list[str], most: int) -> DataFrame:
    """At most ``most`` rows: those of least hash of ``keys``, ties by them.

    A threshold on the hash, set by the count, drops most rows first, so partitions don't each hand on ``most``.
    """
    span = 1 << 40
    share = min(span, -(-4 * most * span // max(1, df.count())) + 1)
    h = F.pmod(F.xxhash64(*keys), F.lit(span))
    return df.where(h < share).orderBy(h, *keys).limit(most)


def with_next(df: DataFrame, order: list[str], columns: list[str], into: str, per_partition: int = 4) -> DataFrame:
    """``df`` plus the struct ``into``: ``columns`` of the row that comes next by ``order``; the first one's after the last.

    Rows that are equal by ``order`` (whole numbers, nulls first) come by their place in the files. Ranges of rows are found
    from the keys alone; then each row moves once, to its range, and the first row of a range also to the end of the range
    before, so that no window is wider than a range. The driver sees a key for each range, ``per_partition`` for each
    shuffle partition.
    """
    spark = df.sparkSession
    keyed, place = with_row_key(df)
    key = F.struct(*[F.col(c).cast("long").alias(f"k{i}") for i, c in enumerate([*order, *place])])
    n = per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = keyed.select(key.alias("k")).repartitionByRange(n, "k").groupBy(F.spark_partition_id()).agg(F.min("k").alias("k"))
    rows = sorted((tuple(r["k"]) for r in keys.collect()), key=lambda r: [(x is not None, x or 0) for x in r])
    kind = "array<struct<" + ",".join(f"k{i}:bigint" for i in range(len(order) + 2)) + ">>"
    bounds = F.from_json(F.lit(json.dumps([{f"k{i}": x for i, x in enumerate(r)} for r in rows])), kind)
    k, at, wraps, home = free(keyed, "next_key", "next_range", "next_wraps", "next_home")
    halves = [1 << b for b in range(len(rows).bit_length() - 1, -1, -1)]
    here = F.aggregate(F.array(*map(F.lit, halves or [1])), F.lit(0), lambda a, s: F.when((a + s <= len(rows)) & (F.get(bounds, a + s - 1) <= F.col(k)), a + s).otherwise(a))
    out = keyed.withColumn(k, key).withColumn(at, here)
    before = F.when(F.col(at) == 1, len(rows)).otherwise(F.col(at) - 1)
    own = lambda a, h, w: F.struct(a.alias("at"), h.alias("home"), w.alias("wraps"))
    twice = F.array(own(F.col(at), F.lit(True), F.lit(False)), own(before, F.lit(False), F.col(at) == 1))
    out = out.withColumn(home, F.explode(F.when(F.get(bounds, F.col(at) - 1) == F.col(k), twice).otherwise(F.slice(twice, 1, 1))))
    w = Window.partitionBy(F.col(home)["at"]).orderBy(F.col(home)["wraps"], k)
    return out.withColumn(into, F.lead(F.struct(*columns)).over(w)).where(F.col(home)["home"]).select(*df.columns, into)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows and bytes that go to a Python worker at once; whole texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def runs(parts: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Frames of sorted rows that never split a key between two of them."""
    held: pd.DataFrame | None = None
    for part in parts:
        part = part if held is None else pd.concat([held, part], ignore_index=True)
        cut = int(part[key].searchsorted(part[key].iloc[-1])) if len(part) else 0
        if cut:
            yield part.iloc[:cut].reset_index(drop=True)
        held = part.iloc[cut:]
    if held is not None and len(held):
        yield held.reset_index(drop=True)
