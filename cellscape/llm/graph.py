"""Connected components as alternating large-star and small-star rounds over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, table


def _fresh(column: str) -> F.Column:
    """The same value as a new expression, so that a join deals both of its sides anew and can split hot keys."""
    return F.col(column).bitwiseXOR(F.lit(0))


def _star(pairs: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """(node, least neighbour) of every ``key`` of ``pairs`` joined to ``edges``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(_fresh("u").alias("k"), "m")
    return edges.join(least, F.col(key) == F.col("k"))


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(node, component) of every node with an edge; component is the least node reachable.

    ``edges`` has two long columns ``u`` and ``v``; direction, repeats and self-loops don't matter, rows
    with a null are ignored. Each round points nodes at the least neighbour of their neighbour, so the
    rounds grow with the logarithm of the longest path, and no component is gathered anywhere: hubs
    only meet partial minima and joins whose partitions adaptive execution can split. Every round is a
    written table.
    """
    high, low = F.greatest("u", "v"), F.least("u", "v")
    now = table(edges.where("u <> v").select(high.alias("u"), low.alias("v")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if before == seen or not seen[0]:
            break
        before = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, now, "v").select("u", F.least("v", "m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least.select(_fresh("u").alias("k"), "m"), F.col("u") == F.col("k"))
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        done = table(small, "edges")
        drop_table(now)
        now = done
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
