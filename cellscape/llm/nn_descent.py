"""Embedding near-duplicates by NN-descent.

A neighbour graph starts from random-projection orders (in each of several tables, vectors are sorted
by label, sign pattern and projection, and each is linked to the next few) and is refined through
joins of neighbours of neighbours: all who share a neighbour are compared, and each keeps its nearest.
A vector whose whole list passes the threshold is saturated and its list is doubled in the next round.
What a list has no room for still ties: every pair found over the threshold, or a path with the same
components, is kept beside the lists, and components come from these ties. Each further draw compares only
vectors of different components, so a large group's own members can't hide its links to another one.
Recall is audited against brute force by query, on nodes that have a link and on a share of all others; draws go on until it
is reached and the components larger than a list have settled, and a warning tells where they don't. Inside a component links are counted whole without being
expanded: angles to one of its vectors tell most pairs by the triangle inequality, all others are compared
block by block. Equal vectors of a label are one node with a count and a number of its own throughout.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_table, hashed_sample, runs, small_batches, table
from .graph import connected_components

EDGE = "a long, b long, sim double, tie boolean"
#: ``sim`` of an edge that only ties.
TIES = -2.0


@dataclass(frozen=True)
class Params:
    threshold: float = 0.98
    tables: int = 8
    following: int = 2
    window: int = 32
    top: int = 4
    neighbours: int = 8
    rounds: int = 2
    floor: float = 0.9
    queries: int = 256
    most_queries: int = 4096
    recall: float = 0.99
    most_draws: int = 12
    block: int = 128
    bins: int = 16
    seed: int = 11


def unit(values: object, label: object) -> bytes | None:
    """The vector over its norm as bytes of doubles; None where it links with nothing."""
    if values is None or label is None:
        return None
    v = np.array(values, dtype=np.float64)
    if not len(v) or not np.isfinite(v).all():
        return None
    v = v / np.abs(v).max() if np.abs(v).max() > 0 else v  # the norm of tiny or huge values neither vanishes nor overflows
    norm = np.sqrt(v @ v)
    return (v / norm).tobytes() if norm > 0 else None


def _units(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        vecs = [unit(v, x) for v, x in zip(part["v"], part["label"])]
        yield pd.DataFrame({"id": part["id"].astype("Int64"), "label": part["label"], "vec": vecs})


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def _masked_pairs(x: np.ndarray, c: np.ndarray, params: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, cosine) of rows of different ``c`` in their order: the next ``following``, and among the next ``window`` or
    more those from the floor on; of these the ``top`` nearest and the last over the threshold, where there are more."""
    w, n = params.window, len(x)
    blocks = -(-n // w)
    padded = np.zeros(((blocks + 1) * w, x.shape[1]))
    padded[:n] = x
    named = np.full(len(padded), -1, np.int64)
    named[:n] = np.arange(n)
    own, at = padded[:-w].reshape(blocks, w, -1), named[:-w].reshape(blocks, w)
    both, to = np.concatenate([own, padded[w:].reshape(blocks, w, -1)], 1), np.concatenate([at, named[w:].reshape(blocks, w)], 1)
    sims = own @ both.transpose(0, 2, 1)
    i, j = at[:, :, None], to[:, None, :]
    valid = (i >= 0) & (j > i) & (c[i] != c[j])
    near = valid & (sims >= params.floor)
    if (near.sum(2) > params.top).any():
        held = np.where(near, sims, -np.inf)
        last = (near & (sims >= params.threshold))[:, :, ::-1].argmax(2)
        farthest = near & (sims >= params.threshold) & (np.arange(2 * w) == (2 * w - 1 - last)[:, :, None])
        near &= held >= np.partition(held, -params.top, 2)[:, :, -params.top, None]
        near |= farthest
    k, p, q = np.nonzero(near | (valid & (j - i <= params.following)))
    return at[k, p], to[k, q], sims[k, p, q]


def first_edges(nodes: DataFrame, params: Params, draw: int, bits: int, tables: int) -> DataFrame:
    """Edges between nodes of different ``c`` from the random-projection orders of one draw of tables."""

    def placed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for dim, rows in part.groupby(part["vec"].map(len)):
                x = _matrix(rows["vec"])
                for t in range(tables):
                    planes = np.random.default_rng([params.seed, draw, t]).standard_normal((dim // 8, bits + 1))
                    p = x @ planes
                    sign = (p[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))
                    yield pd.DataFrame({"t": t, "label": rows["label"], "dim": dim, "sign": sign, "place": p[:, bits], "id": rows["id"], "c": rows["c"], "vec": rows["vec"]})

    def slid(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None
        for part in parts:
            part = part if tail is None else pd.concat([tail, part], ignore_index=True)
            for _, rows in part.groupby(["t", "label", "dim"], sort=False):
                ids = rows["id"].to_numpy()
                i, j, sims = _masked_pairs(_matrix(rows["vec"]), rows["c"].to_numpy(), params)
                yield pd.DataFrame({"a": ids[i], "b": ids[j], "sim": sims, "tie": sims >= params.threshold})
            tail = part.iloc[-params.window :]

    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["t", "label", "dim", "sign", "place"]
    return (
        nodes.mapInPandas(placed, "t int, label string, dim int, sign long, place double, id long, c long, vec binary")
        .repartitionByRange(n, *order)
        .sortWithinPartitions(*order, "id")
        .mapInPandas(slid, EDGE)
    )


def nearest(edges: DataFrame, params: Params, largest: int) -> DataFrame:
    """Each node's nearest ``neighbours`` by falling similarity; up to ``largest`` where all of those pass the threshold.

    Edges that tie stay, one way, whatever their ``rank``; it is null where an edge is in no list.
    """
    columns = ("a", "b", "sim", "tie")
    edges = edges.select(*columns)
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim", "tie")).where("a <> b")
    best = both.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.max("tie").alias("tie"))
    order = Window.partitionBy("a").orderBy(F.desc("sim"), "b")
    ranked = best.withColumn("rank", F.row_number().over(order))
    listed = (F.col("sim") > TIES) & ((F.col("rank") <= params.neighbours) | ((F.col("rank") <= largest) & (F.col("sim") >= params.threshold)))
    return ranked.select(*columns, F.when(listed, F.col("rank")).alias("rank")).where((F.col("tie") & (F.col("a") < F.col("b"))) | F.col("rank").isNotNull())


def _paths(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a path through each component of a symmetric matrix of links."""
    label, before = np.arange(len(linked)), None
    while before is None or (label != before).any():
        before = label
        label = np.minimum(label, np.where(linked, label[None, :], len(linked)).min(1))
    order = np.argsort(label, kind="stable")
    same = label[order[1:]] == label[order[:-1]]
    return order[:-1][same], order[1:][same]


def refined(lists: DataFrame, nodes: DataFrame, params: Params) -> DataFrame:
    """Edges between nodes of different ``c`` that share a neighbour, where the cosine reaches the floor, and their ties."""

    def joined(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in runs(parts, "m"):
            out = []
            for _, rows in run.groupby("m", sort=False):
                if len(rows) > 1 and rows["vec"].map(len).nunique() == 1:
                    x, ids, c = _matrix(rows["vec"]), rows["id"].to_numpy(), rows["c"].to_numpy()
                    sims = np.where(c[:, None] != c[None, :], x @ x.T, TIES)
                    i, j = np.nonzero(np.triu(sims >= params.floor, 1))
                    if len(i):
                        out.append((ids[i], ids[j], sims[i, j], np.zeros(len(i), bool)))
                        if (sims[i, j] >= params.threshold).any():
                            i, j = _paths(sims >= params.threshold)
                            out.append((ids[i], ids[j], np.full(len(i), TIES), np.ones(len(i), bool)))
            if out:
                yield pd.DataFrame(dict(zip(("a", "b", "sim", "tie"), map(np.concatenate, zip(*out)))))

    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = nodes.select(F.col("id").alias("b"), "c", "vec")
    return lists.select(F.col("a").alias("m"), "b").join(named, "b").select("m", F.col("b").alias("id"), "c", "vec").repartition(n, "m").sortWithinPartitions("m").mapInPandas(joined, EDGE)


def _with_components(nodes: DataFrame, member: DataFrame | None) -> DataFrame:
    """``nodes`` with their component ``c``, their own id where they are in none, and ``tied``: whether they are in one."""
    if member is None:
        return nodes.withColumns({"c": F.col("id"), "tied": F.lit(False)})
    return nodes.join(member, F.col("id") == F.col("node"), "left").select("id", "label", "vec", F.coalesce("component", "id").alias("c"), F.col("component").isNotNull().alias("tied"))


@dataclass(frozen=True)
class Audit:
    """Sums of shares of links found and numbers of queries that have a link, both weighed, and how many were asked so.

    Ordinary queries, then saturated ones (of more links than ``neighbours``).
    """

    found: tuple[float, float]
    linked: tuple[float, float]
    asked: tuple[int, int]

    def reaches(self, recall: float) -> bool:
        return all(f >= recall * n - 1e-9 for f, n in zip(self.found, self.linked))

    @property
    def recall(self) -> float | None:
        """The share of links found, each query alike; None where no query has a link."""
        return sum(self.found) / sum(self.linked) if sum(self.linked) else None


def audit(nodes: DataFrame, member: DataFrame | None, params: Params) -> Audit:
    """What share of their links queries have found, by brute force against all nodes.

    ``queries`` are asked of the nodes that are tied, ``most_queries`` of the others, each weighed by how many nodes of its
    kind it stands for. So links that are rare among all nodes are measured too, on the nodes known to have one, and the rest
    tells of links of which neither end is tied. A link is found where both ends are in one component, as that is compared
    whole later.
    """
    placed = table(_with_components(nodes, member), "audited")
    rows = []
    for tied, most in ((True, params.queries), (False, params.most_queries)):
        kind = placed.where(F.col("tied") == tied)
        drawn = hashed_sample(kind, ["id"], most).collect()
        weight = kind.count() / len(drawn) if drawn else 0.0
        rows += [(r["id"], r["label"], bytes(r["vec"]), r["c"], weight) for r in drawn]
    asked = pd.DataFrame(rows, columns=["id", "label", "vec", "c", "weight"])

    def true_links(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for (label, dim), rows in part.groupby(["label", part["vec"].map(len)]):
                q = asked[(asked["label"] == label) & (asked["vec"].map(len) == dim)]
                if len(q):
                    near = _matrix(q["vec"]) @ _matrix(rows["vec"]).T >= params.threshold
                    near &= q["id"].to_numpy()[:, None] != rows["id"].to_numpy()[None, :]
                    at = np.flatnonzero(near.any(1))
                    hit = near[at] & (q["c"].to_numpy()[at, None] == rows["c"].to_numpy()[None, :])
                    yield pd.DataFrame({"a": q["id"].to_numpy()[at], "weight": q["weight"].to_numpy()[at], "links": near[at].sum(1), "found": hit.sum(1)})

    by = {}
    if rows:
        each = placed.mapInPandas(true_links, "a long, weight double, links long, found long").groupBy("a", "weight").agg(F.sum("links").alias("links"), F.sum("found").alias("found"))
        share = F.col("weight") * F.col("found") / F.col("links")
        kinds = each.groupBy((F.col("links") > params.neighbours).alias("many")).agg(F.sum(share).alias("f"), F.sum("weight").alias("w"), F.count("*").alias("n"))
        by = {r["many"]: (r["f"], r["w"], r["n"]) for r in kinds.collect()}
    drop_table(placed)
    both = [by.get(many, (0.0, 0.0, 0)) for many in (False, True)]
    return Audit(*zip(*both))


def tables_for(bits: int, params: Params) -> int:
    """So many tables that a pair at the threshold shares its signs in one of them, with half the misses that the recall allows."""
    shared = (1 - np.arccos(params.threshold) / np.pi) ** bits
    return max(params.tables, int(np.ceil(np.log((1 - params.recall) / 2) / np.log(1 - shared))))


def neighbour_graph(nodes: DataFrame, params: Params) -> DataFrame | None:
    """(node, component) of all nodes that are tied, None where none is; draws go on until the audited recall is reached.

    Components of more nodes than a list holds must also stay as they are in a draw across components. Where no query of the
    audit has a link, a draw that ties nothing new ends it. After ``most_draws`` what is found is returned with a warning
    that tells the recall. Tables that a later draw doesn't read are deleted.
    """
    n = nodes.count()
    bits = int(min(20, max(4, np.ceil(np.log2(n + 1)) - 5)))
    member = inner = large = found = None
    for draw in range(params.most_draws):
        placed = table(_with_components(nodes, member), "placed")
        lists = table(nearest(first_edges(placed, params, draw, bits, tables_for(bits, params)), params, params.neighbours), "lists")
        for k in range(1, params.rounds + 1):
            listed = lists.where("rank is not null")
            around = listed if inner is None else listed.select("a", "b").unionByName(inner.join(listed.select("a").distinct(), "a", "left_semi"))
            before, lists = lists, table(nearest(lists.drop("rank").unionByName(refined(around, placed, params)), params, params.neighbours << k), "lists")
            drop_table(before)
        inner = table(lists.where(F.col("rank") <= params.neighbours).select("a", "b"), "inner") if inner is None else inner
        ties = lists.where("tie").select(F.col("a").alias("u"), F.col("b").alias("v"))
        tied = not ties.isEmpty()
        if tied:
            known = ties if member is None else ties.unionByName(member.select(F.col("node").alias("u"), F.col("component").alias("v")))
            member = table(connected_components(known), "members")
        drop_table(lists)
        drop_table(placed)
        before, large = large, (0, None)
        if member is not None:
            sizes = member.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") > params.neighbours << params.rounds)
            large = tuple(sizes.agg(F.count("*"), F.sum("n")).first())
        settled = not large[0] or large == before
        found = audit(nodes, member, params)
        if settled and found.reaches(params.recall) and (found.recall is not None or not tied):
            return member
    warnings.warn(f"after {params.most_draws} draws: {found}, {large} large components and nodes in them", stacklevel=2)
    return member


def links_within(nodes: DataFrame, member: DataFrame, params: Params) -> DataFrame:
    """(id, links): how many vectors each node of a component links to in it.

    Nodes are put in bins by their angle to the component's first node. With the threshold's angle ``bins`` bins wide, the
    triangle inequality tells pairs of near bins to be links and pairs of distant ones not to be; both rules leave a bin's
    width for rounding. Only what lies between is compared, a pair of blocks at a time, each once: of a component of n nodes
    of which angles tell nothing, n ** 2 / ``block`` vectors are moved.
    """
    sure, far = params.bins - 3, params.bins + 1
    width = float(np.arccos(params.threshold)) / params.bins

    def binned(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for _, rows in part.groupby(part["vec"].map(len)):
                cosine = np.einsum("ij,ij->i", _matrix(rows["vec"]), _matrix(rows["pivot"]))
                yield rows.drop(columns="pivot").assign(bin=(np.arccos(np.clip(cosine, -1, 1)) / width).astype(np.int32))

    placed = member.join(nodes, F.col("node") == F.col("id")).select("component", "id", "vec", "mult")
    pivot = nodes.select(F.col("id").alias("p"), F.col("vec").alias("pivot"))
    rows = placed.join(pivot, F.col("component") == F.col("p")).select("component", "id", "vec", "mult", "pivot")
    rows = table(rows.mapInPandas(binned, "component long, id long, vec binary, mult long, bin int"), "binned")
    sizes = rows.groupBy("component", "bin").agg(F.count("*").alias("n"), F.sum("mult").alias("m"))
    sizes = table(sizes.groupBy(F.col("component").alias("c")).agg(F.sum("n").alias("n"), F.collect_list(F.struct("bin", F.ceil(F.col("n") / params.block).cast("int").alias("blocks"), "m")).alias("all")), "bins")
    rows = rows.join(sizes, F.col("component") == F.col("c"))
    pair, b = F.col("n") == 2, F.col("bin")  # two nodes of a component link
    certain = F.filter("all", lambda x: pair | (x["bin"] + b <= sure))
    linked = F.aggregate(certain, F.lit(0).cast("long"), lambda acc, x: acc + x["m"]) - F.when(pair | (2 * b <= sure), F.col("mult")).otherwise(0)
    open_bins = F.filter("all", lambda x: ~pair & (x["bin"] + b > sure) & (F.abs(x["bin"] - b) <= far))
    blocks = F.flatten(F.transform(open_bins, lambda x: F.transform(F.sequence(F.lit(0), x["blocks"] - 1), lambda k: F.struct(x["bin"].alias("bin"), k.alias("k")))))
    mine = F.filter("all", lambda x: x["bin"] == b)[0]["blocks"]
    own = F.struct(b.alias("bin"), F.pmod(F.xxhash64("id"), mine).cast("int").alias("k"))
    each = rows.select("component", "id", "vec", "mult", own.alias("own"), F.explode(blocks).alias("other"))
    each = each.select("component", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") <= F.col("other")).alias("first"), "id", "vec", "mult")

    def counted(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf[pdf["first"]], pdf[~pdf["first"]]
        same = not len(b) and dict(pdf["low"].iloc[0]) == dict(pdf["high"].iloc[0])
        b = a if same else b
        if not len(a) or not len(b):
            return pd.DataFrame({"id": [], "links": []}, dtype="int64")
        near = _matrix(a["vec"]) @ _matrix(b["vec"]).T >= params.threshold
        if same:
            np.fill_diagonal(near, False)
        out = [pd.DataFrame({"id": a["id"].to_numpy(), "links": near @ b["mult"].to_numpy()})]
        if not same:
            out.append(pd.DataFrame({"id": b["id"].to_numpy(), "links": a["mult"].to_numpy() @ near}))
        return pd.concat(out)

    compared = each.groupBy("component", "low", "high").applyInPandas(counted, "id long, links long")
    return rows.select("id", linked.alias("links")).unionByName(compared).groupBy("id").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", params: Params = Params()) -> DataFrame:
    """(id, n_links, component_id, kept): one row for each vector.

    Only vectors of equal, non-null label (of any type) and equal length link. A vector that is null, empty, zero or
    holds a null or non-finite component has no link and is its own component. Rows that repeat an id, or have
    none, are vectors of their own; a component's id is its least id that isn't null. Ties change nothing, as all
    pairs over the threshold count. An empty table gives an empty one; other columns aren't read. See ``neighbour_graph``
    for when a warning tells that the recall wasn't reached.
    """
    small_batches(vectors.sparkSession, 4000)
    raw = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    key = F.when(F.col("vec").isNotNull(), F.sha2(F.concat(F.col("vec"), F.col("label").cast("binary")), 256))
    rows = table(raw.mapInPandas(_units, "id long, label string, vec binary").withColumn("key", key), "vectors")
    own = rows.where("key is not null").groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("mult"), F.first("label").alias("label"), F.first("vec").alias("vec"))
    nodes = table(own.withColumn("id", F.monotonically_increasing_id()), "nodes")
    member = neighbour_graph(nodes.select("id", "label", "vec"), params)
    if member is None:
        member = vectors.sparkSession.createDataFrame([], "node long, component long")
    counts = table(links_within(nodes.select("id", "vec", "mult"), member, params), "links")
    small = nodes.select("id", "first", "key", "mult").join(member, F.col("id") == F.col("node"), "left")
    least = small.where("component is not null").groupBy(F.col("component").alias("c")).agg(F.min("first").alias("least"))
    named = small.join(least, F.col("component") == F.col("c"), "left").join(counts.withColumnRenamed("id", "counted"), F.col("id") == F.col("counted"), "left")
    named = table(
        named.select(F.col("key").alias("k"), (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("least", "first").alias("component_id")), "named"
    )
    return rows.select("id", "key").join(named, F.col("key") == F.col("k"), "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component_id", "id")).alias("kept"),
    )
