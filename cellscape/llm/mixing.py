"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight (its share of the words of the mix) and a schedule, a piecewise linear curve
over training time 0 to 1 that says when those words are wanted. Integrating the curve gives the
source's cumulative demand; inverting it at a document's offset in the source's random order gives the
time at which the document is due. Documents are then range-sorted by that time.
Offsets are prefix sums in two levels, so no source is ever ordered in one task: within hash buckets by
a window, and over the buckets' sums, of which there are at most 16**digits a source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, table, with_row_key

#: Curves by which the default curriculum lets sources fade, stay and grow.
CURVES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))

#: Rows of a plan that are broadcast.
BROADCAST_ROWS = 1_000_000


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def segments(curve: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """(t0, t1, w0, w1, demand before t0) of each piece of the curve, demand scaled to 1 in all."""
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(curve, curve[1:]))
    if area <= 0 or any(w < 0 for _, w in curve) or curve[0][0] != 0 or curve[-1][0] != 1:
        raise ValueError("a curve runs from 0 to 1, is never negative and has an area")
    out, done = [], 0.0
    for (t0, w0), (t1, w1) in zip(curve, curve[1:]):
        if t1 > t0 and w0 + w1 > 0:
            out.append((t0, t1, w0 / area, w1 / area, done))
            done += (t1 - t0) * (w0 + w1) / 2 / area
    return out


def due(share: Column, kind: Column, curves: Sequence[Sequence[tuple[float, float]]] = CURVES) -> Column:
    """The time at which ``share`` (0 to 1) of a source's demand is met, its curve being number ``kind``."""

    def piece(t0: float, t1: float, w0: float, w1: float, done: float) -> Column:
        rest, slope = share - F.lit(done), (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
        return F.lit(t0) + F.least(F.coalesce(F.try_divide(F.lit(2.0) * rest, F.lit(w0) + root), F.lit(0.0)), F.lit(t1 - t0))

    out = F.lit(0.0)
    for k, curve in enumerate(curves):
        at = None
        for s in segments(curve):
            at = piece(*s) if at is None else F.when(share >= s[4], piece(*s)).otherwise(at)
        out = F.when(kind == k, at).otherwise(out)
    return out


def targets(sizes: DataFrame, cycle: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, rank, weight, target, quota) from one row (source, source_size) a source.

    Sources by code point, null last, take the weights of ``cycle`` in turn and share the words of all.
    No target passes ``most`` times its source's size; the excess goes to the others by weight. That
    water level is found in one ordered pass: with sources by saturation level (cap over weight), it is
    the first level at which what is left, over the weights left, saturates nobody more. There is one
    row a source, so the windows here order the sources, never documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_level = Window.orderBy("level", "rank").rowsBetween(Window.unboundedPreceding, -1)
    ranked = sizes.withColumn("rank", F.row_number().over(by_name).cast("long")).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in cycle]), ((F.col("rank") - 1) % len(cycle) + 1).cast("int")).cast("long")
    )
    cap = F.col("source_size") * most
    level = ranked.withColumn("cap", cap).withColumn("level", F.col("cap").cast("double") / F.col("weight"))
    whole = Window.partitionBy()
    water = level.withColumn(
        "line",
        (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(by_level), F.lit(0))).cast("double")
        / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(by_level), F.lit(0))),
    )
    line = F.min_by("line", F.when(F.col("line") <= F.col("level"), F.struct("level", "rank"))).over(whole)
    return (
        water.withColumn("target", F.least(F.col("cap").cast("double"), line * F.col("weight")))
        .withColumn("quota", F.round("target").cast("long"))
        .select("source", "source_size", "rank", "weight", "target", "quota")
    )


def plan(sized: DataFrame, id_col: str = "doc_id", source_col: str = "source", digits: int = 3, cycle: Sequence[int] = (1, 2, 3), most: int = 3, curves=CURVES, spread: Sequence[str] = ()) -> DataFrame:
    """``sized`` (with a long column ``mix_size``) plus a struct ``mix``.

    mix: source_size, target, taken (words: whole passes, then what the last pass still needs), passes,
    rest (words of the last, partial pass), start (offset in the source's order), position and last_position
    (when its first and its last pass are due, 0 to 1; each source's order is by md5 of the id, then id, then
    size). Null sources are a source. Rows that repeat an id are each planned. Rows of a null id are ordered by
    the md5 of the columns ``spread`` (name some, where such rows may be many; else all have one key). Documents
    without words take nothing and have no position. An empty table gives an empty one; texts aren't read here.
    """
    other = F.concat_ws(" ", *[F.col(c).cast("string") for c in spread])
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), other).cast("binary"))
    keyed = sized.withColumn("mix_source", F.col(source_col)).withColumn("mix_key", key).withColumn("mix_bucket", F.substring("mix_key", 1, digits))
    sums = keyed.groupBy("mix_source", "mix_bucket").agg(F.sum("mix_size").alias("words"))
    total = sums.groupBy(F.col("mix_source").alias("source")).agg(F.sum("words").alias("source_size"))
    before = Window.partitionBy("mix_source").orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    goal = targets(total, cycle, most).withColumnRenamed("source", "goal_source")
    known = starts.join(goal, F.col("mix_source").eqNullSafe(F.col("goal_source"))).select(
        F.col("mix_source").alias("mix_s"), F.col("mix_bucket").alias("mix_b"), F.struct("before", "source_size", "rank", "target", "quota").alias("mix_known")
    )
    within = Window.partitionBy("mix_source", "mix_bucket").orderBy("mix_key", id_col, "mix_size").rowsBetween(Window.unboundedPreceding, -1)
    rows = keyed.withColumn("mix_within", F.coalesce(F.sum("mix_size").over(within), F.lit(0)))
    rows = rows.join(known, F.col("mix_source").eqNullSafe(F.col("mix_s")) & (F.col("mix_bucket") == F.col("mix_b")))
    size, of, quota = F.col("mix_size"), F.col("mix_known.source_size"), F.col("mix_known.quota")
    start = F.col("mix_known.before") + F.col("mix_within")
    passes = F.when(of > 0, F.floor(quota / of)).otherwise(0).cast("long")
    rest = F.greatest(F.lit(0), F.least(size, quota - passes * of - start)).cast("long")
    goal_words, kind = F.col("mix_known.target"), (F.col("mix_known.rank") - 1) % len(curves)
    share = F.coalesce(F.try_divide(start.cast("double"), goal_words), F.lit(0.0))
    last = F.least(F.coalesce(F.try_divide((start + (passes - F.when(rest > 0, 0).otherwise(1)) * of).cast("double"), goal_words), F.lit(0.0)), F.lit(1.0))
    taken = passes * size + rest
    mix = F.struct(
        of.alias("source_size"),
        F.col("mix_known.target").alias("target"),
        taken.alias("taken"),
        passes.alias("passes"),
        rest.alias("rest"),
        start.alias("start"),
        F.when(taken > 0, due(share, kind, curves)).alias("position"),
        F.when(taken > 0, due(last, kind, curves)).alias("last_position"),
        kind.alias("curve"),
    )
    return rows.withColumn("mix", mix).drop("mix_source", "mix_key", "mix_bucket", "mix_within", "mix_s", "mix_b", "mix_known")


def in_order(planned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``planned`` range-sorted by the position at which a document is first due; those that the mix leaves out come last."""
    return planned.orderBy(F.asc_nulls_last("mix.position"), id_col, "mix_size")


def passes(planned: DataFrame, columns: Sequence[str], curves=CURVES) -> DataFrame:
    """``columns``, mix_pass and mix_due: one row for each pass over a document, with the position it is due at.

    A last, partial pass keeps documents whole: it takes those of which it needs at least half.
    """
    whole = F.col("mix.passes") + F.when((F.col("mix.rest") * 2 >= F.col("mix_size")) & (F.col("mix_size") > 0), 1).otherwise(0)
    share = F.try_divide((F.col("mix.start") + F.col("mix_pass") * F.col("mix.source_size")).cast("double"), F.col("mix.target"))
    rows = planned.where((whole > 0) & (F.col("mix.taken") > 0)).withColumn("mix_pass", F.explode(F.sequence(F.lit(0).cast("long"), whole - 1)))
    return rows.select(*columns, "mix_pass", due(F.least(share, F.lit(1.0)), F.col("mix.curve"), curves).alias("mix_due"))


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row for each pass that the mix takes, range-sorted by the position it is due at.

    The plan is made on ids, sources and sizes alone; texts are moved by the sort, and by no other exchange
    as long as the plan has ``BROADCAST_ROWS`` rows at most, of 40 bytes each; a larger one is joined by shuffle.
    Rows that repeat an id, or have none, are each planned by themselves; empty texts take no part.
    """
    keyed, key = with_row_key(docs)
    sized = table(keyed.select(*key, F.col(id_col).alias("mix_id"), F.col(source_col).alias("mix_of"), word_count(F.col(text_col)).alias("mix_size")), "sizes")
    order = table(passes(plan(sized, "mix_id", "mix_of", spread=key, **options), [*key, "mix_id"]), "order")
    whole = keyed.select(F.struct(*docs.columns).alias("doc"), *[F.col(k).alias(f"doc_{k}") for k in key])
    order = F.broadcast(order) if order.count() <= BROADCAST_ROWS else order
    met = whole.join(order, [F.col(k) == F.col(f"doc_{k}") for k in key])
    return met.orderBy("mix_due", "mix_pass", "mix_id", *key).select("doc.*")
