"""Iteration with bounded lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_path(spark: SparkSession, name: str) -> str:
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


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to and read from the folder that all executors share."""
    path = shared_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def iterate_until(state: DataFrame, step: Callable[[DataFrame], DataFrame], key: list[str], value: str, tolerance: float, most: int) -> DataFrame:
    """Apply ``step`` until the L1 change of ``value`` falls below ``tolerance``, or ``most`` times."""
    for _ in range(most):
        new = cut(step(state))
        old = state.select(*key, F.col(value).alias("_old"))
        change = new.join(old, key, "full_outer").agg(F.sum(F.abs(F.coalesce(value, F.lit(0.0)) - F.coalesce("_old", F.lit(0.0))))).first()[0]
        state = new
        if change is None or change < tolerance:
            break
    return state
