"""Hard negatives for anchors by sorted integer scores.

Every anchor is scored against all rows in blocks; blocks of rows and of anchors are dealt out over tasks, and each task takes all
pairs of its own. An anchor's order is a sorted run a pair of blocks, by falling score and then id, of the rows that are asked
for: those of its label, first, are the positives; for each positive a binary search in the run finds where scores stop being
over the upper limit, and the first rows of other labels from there on, down to the lower limit, are the run's share. A task keeps
the first of all its runs, and leaves out of later ones what is behind them; what tasks keep is merged. So no task holds more than
a block of rows, some blocks of anchors and what is asked for of them, and what leaves it is bounded by that.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, table


@dataclass(frozen=True)
class Params:
    """A negative's score is within ``low`` and ``high`` percent of its positive's. ``rows`` and ``anchors``: sizes of blocks."""

    scale: int = 256
    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100
    rows: int = 2048
    anchors: int = 512


def prepared(rows: DataFrame, vec_id: Column, label: Column, vector: Column, anchor: Column, params: Params) -> DataFrame:
    """(row, id, label, v, anchor): the rows that take part, numbered, with components scaled and floored.

    Rows of a null id or label, a null or empty vector, or a null or non-finite component take no part.
    """
    v = vector.cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    sound = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: F.coalesce(finite(x), F.lit(False)))
    whole = F.transform(v, lambda x: F.floor(x * params.scale).cast("double"))
    kept = rows.where(vec_id.isNotNull() & label.isNotNull() & sound)
    return kept.select(F.monotonically_increasing_id().alias("row"), vec_id.cast("long").alias("id"), F.xxhash64(label.cast("string")).alias("label"), whole.alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact: in floats or doubles where no sum can leave the whole numbers that they hold."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * a.shape[1]
    for kind, whole in ((np.float32, 2.0**24), (np.float64, 2.0**53)):
        if most < whole:
            return a.astype(kind, copy=False) @ x.astype(kind, copy=False).T
    exact = [[sum(int(p) * int(q) for p, q in zip(u, v)) for v in x] for u in a]
    if any(abs(s) >= 1 << 56 for r in exact for s in r):  # a hundred times a score is compared
        raise OverflowError("a score is too large to be told in percent")
    return np.array(exact, np.int64).reshape(len(a), len(x))


def scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    return products(a, x).astype(np.int64)


def blocks(rows: DataFrame, size: int, prefix: str, carry: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """Blocks of about ``size`` rows as one row each, and how many numbers they go by: ids, labels, row numbers and vectors of
    equal dimension, packed by id, vectors as short numbers where they can be. Columns begin with ``prefix``, but for ``dim`` and
    ``block``. ``carry``: columns of arrays of longs, of which the values are packed and how many each row has.
    """
    n = max(1, -(-rows.count() // size))
    longs = ("row", "id", "label")
    placed = rows.select(*longs, "v", *carry, F.size("v").alias("dim"), F.pmod(F.xxhash64("row"), F.lit(n)).alias("block"))

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "row"])
        v = np.stack(pdf["v"]).astype(np.float64)
        out = {"dim": pdf["dim"].iloc[0], "block": pdf["block"].iloc[0]}
        out |= {prefix + c: pdf[c].to_numpy(np.int64).tobytes() for c in longs} | {f"{prefix}v": (v.astype(np.int16) if np.abs(v).max() < 1 << 15 else v).tobytes()}
        for c in carry:
            out |= {prefix + c: np.concatenate(list(pdf[c])).astype(np.int64).tobytes(), f"{prefix}{c}_n": pdf[c].map(len).to_numpy(np.int64).tobytes()}
        return pd.DataFrame([out])

    names = [f"{prefix}{c}" for c in (*longs, "v", *carry, *[f"{c}_n" for c in carry])]
    return placed.groupBy("block", "dim").applyInPandas(packed, "dim int, block long, " + ", ".join(f"{c} binary" for c in names)), n


def paired(anchors: DataFrame, rows: DataFrame, n: int, m: int) -> DataFrame:
    """Each of the ``m`` blocks of anchors beside each of the ``n`` blocks of rows.

    Both are dealt out, and each part of the one meets each part of the other in a task, so that neither is copied for each
    block of the other. A part holds no more than 16 blocks of anchors.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    of_anchors = max(min(m, math.ceil(math.sqrt(tasks))), -(-m // 16))
    dealt = anchors.withColumnRenamed("block", "a_block").repartition(of_anchors)
    return rows.repartition(min(n, -(-tasks // of_anchors))).join(dealt.hint("shuffle_replicate_nl"), "dim")


#: The score of a place that no row has taken.
EMPTY = -(1 << 62)


def _unpacked(r: dict, prefix: str) -> dict[str, np.ndarray]:
    out = {c: np.frombuffer(r[prefix + c], np.int64) for c in ("row", "id", "label")}
    short = len(r[f"{prefix}v"]) == 2 * len(out["row"]) * r["dim"]
    return out | {"v": np.frombuffer(r[f"{prefix}v"], np.int16 if short else np.float64).reshape(-1, r["dim"]).astype(np.float32 if short else np.float64)}


def _asked_for(a: dict, x: dict, same: bool, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score): of each anchor the other rows of its label, or else those of other labels, with scores from low to high."""
    every = [(np.arange(len(a["row"])), np.arange(len(x["row"])))]
    parts = [(np.flatnonzero(a["label"] == v), np.flatnonzero(x["label"] == v)) for v in np.intersect1d(a["label"], x["label"])] if same else every
    out = [(np.zeros(0, np.int64),) * 3]
    for i, j in parts:
        found = products(a["v"][i], x["v"][j])
        most = {"f4": 1 << 24, "f8": 1 << 53}.get(found.dtype.str[1:], 1 << 62)  # no score is beyond, so a limit may be cut
        limit = lambda v: np.clip(v[i], -most, most).astype(found.dtype)[:, None]  # noqa: B023, E731
        k, c = np.divmod(np.flatnonzero((found >= limit(low)) & (found <= limit(high))), len(j))
        anchor, row, score = i[k], j[c], found[k, c].astype(np.int64)
        takes = a["row"][anchor] != x["row"][row] if same else a["label"][anchor] != x["label"][row]
        out.append((anchor[takes], row[takes], score[takes]))
    return tuple(np.concatenate(c) for c in zip(*out))


def share(a: dict, x: dict, same: bool, asker: np.ndarray, lower: np.ndarray, upper: np.ndarray, most: int) -> np.ndarray:
    """(score, id, row) by place of the first ``most`` rows of each question: one anchor's rows with scores from lower to upper."""
    low, high = np.full(len(a["row"]), 1 << 62), np.full(len(a["row"]), -(1 << 62))
    np.minimum.at(low, asker, lower)
    np.maximum.at(high, asker, upper)
    anchor, row, score = _asked_for(a, x, same, low, high)
    out = np.full((3, len(asker), most), EMPTY)
    if len(score):
        levels, level = np.unique(score, return_inverse=True)  # their numbers stay small, whatever the scores are
        n, width = len(levels), len(x["row"])
        run = np.sort((anchor * (n + 1) + n - 1 - level) * width + row)  # rows are in order of id
        place = lambda v, side: np.searchsorted(run, (asker * (n + 1) + n - np.searchsorted(levels, v, side)) * width)
        at = place(upper, "right")[:, None] + np.arange(most)
        held = at < place(lower, "left")[:, None]
        key = run[at[held]]
        out[:, held] = levels[n - 1 - key // width % (n + 1)], x["id"][key % width], x["row"][key % width]
    return out


def merge(kept: np.ndarray, new: np.ndarray) -> None:
    """Puts the first of both (score, id, row) by place into ``kept``."""
    better = np.flatnonzero((new[0, :, 0] >= kept[0, :, -1]) & (new[0, :, 0] > EMPTY))
    both = np.concatenate([kept[:, better], new[:, better]], axis=2)
    order = np.lexsort((both[2], both[1], -both[0]))
    kept[:, better] = np.take_along_axis(both, order[None], 2)[:, :, : kept.shape[2]]


def searched(pairs: DataFrame, same: bool, questions: Callable[[dict, dict], tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]], names: list[str], most: int) -> DataFrame:
    """What ``questions`` of a block of anchors name, and (row, id, score) of the first rows of each, of all pairs of a task."""

    def of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: dict[tuple, tuple] = {}
        for part in parts:
            for r in part.to_dict("records"):
                a, key = _unpacked(r, "a_"), (r["dim"], r["a_block"])
                if key not in state:
                    asks = questions(r, a)
                    state[key] = asks, np.full((3, len(asks[1]), most), EMPTY)
                (_, asker, lower, upper), kept = state[key]
                merge(kept, share(a, _unpacked(r, "r_"), same, asker, np.maximum(lower, kept[0, :, -1]), upper, most))
        for (fixed, *_), kept in state.values():
            k, place = np.nonzero(kept[0] > EMPTY)
            score, i, row = kept[:, k, place]
            yield pd.DataFrame(dict(zip(names, [*[c[k] for c in fixed], row, i, score])))

    return pairs.mapInPandas(of, ", ".join(f"{c} long" for c in names))


def first(found: DataFrame, key: list[str], order: list, most: int) -> DataFrame:
    """The first ``most`` rows of each key, with their ``place`` from 1; others are dropped before they are shuffled."""
    return found.withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("place") <= most)


def positives(pairs: DataFrame, params: Params) -> DataFrame:
    """(anchor_row, anchor_id, positive_row, positive_id, positive_score): each anchor's first rows of its label."""
    names = ["anchor_row", "anchor_id", "positive_row", "positive_id", "positive_score"]

    def questions(_: dict, a: dict) -> tuple:
        n = len(a["row"])
        return [a["row"], a["id"]], np.arange(n), np.full(n, EMPTY), np.full(n, 1 << 62)

    found = searched(pairs, True, questions, names, params.positives)
    return first(found, ["anchor_row"], [F.desc("positive_score"), "positive_id", "positive_row"], params.positives).drop("place")


def negatives(pairs: DataFrame, params: Params) -> DataFrame:
    """The first rows of other labels within the limits of each positive that the blocks of anchors carry, with their ``place``."""
    names = ["anchor_row", "anchor_id", "positive_row", "positive_id", "positive_score", "negative_row", "negative_id", "negative_score"]

    def questions(r: dict, a: dict) -> tuple:
        row, i, score = np.frombuffer(r["a_asked"], np.int64).reshape(-1, 3).T
        asker = np.repeat(np.arange(len(a["row"])), np.frombuffer(r["a_asked_n"], np.int64) // 3)
        return [a["row"][asker], a["id"][asker], row, i, score], asker, -(-params.low * score // 100), params.high * score // 100

    found = searched(pairs, False, questions, names, params.negatives)
    return first(found, ["anchor_row", "positive_row"], [F.desc("negative_score"), "negative_id", "negative_row"], params.negatives)


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None, params: Params = Params()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); anchors are the rows that meet ``anchor``.

    ``label`` is the column ``label`` unless given. Rows of different dimension never meet. Rows that repeat an id are rows
    of their own (an id of two anchors has the results of both); ties in score go by id. An empty table gives an empty one;
    other columns aren't read. Anchors without a positive and positives without a negative have no row.
    """
    small_batches(rows.sparkSession, 4)
    ready = table(prepared(rows, F.col(id_col), F.col("label") if label is None else label, F.col(vector_col), anchor, params), "vectors")
    chosen = ready.where("anchor")
    packed, n = blocks(ready, params.rows, "r_")
    packed = table(packed, "blocks")
    anchors, m = blocks(chosen, params.anchors, "a_")
    found = table(positives(paired(anchors, packed, n, m), params), "positives")
    triple = F.array("positive_row", "positive_id", "positive_score")
    asked = found.groupBy(F.col("anchor_row").alias("asker")).agg(F.flatten(F.collect_list(triple)).alias("asked"))
    askers = chosen.join(asked, F.col("row") == F.col("asker"))
    anchors, m = blocks(askers, params.anchors, "a_", ("asked",))
    out = negatives(paired(anchors, packed, n, m), params)
    return out.select("anchor_id", "positive_id", F.col("place").alias("rank"), "negative_id", "positive_score", "negative_score")
