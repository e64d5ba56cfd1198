"""SimHash near-duplicates by anchor-point covering.

Anchors are the words of a covering code on 64 bits: nine Hamming [7,4] blocks (each of covering radius
one, and perfect) and one free bit, so every fingerprint has one nearest anchor within distance nine,
and there are 2**37 anchors. Two fingerprints at distance two or less have a common neighbour at
distance one of either; both are sent to that neighbour's anchor. So a fingerprint is replicated to the
nearest anchors of itself and of its 64 one-bit neighbours (about 29 of them: all those within covering
radius plus threshold that a link can need) and any two that link meet at an anchor.
At each anchor all fingerprints are compared. All pairs of a crowded one, as from a large group of near
copies, would be quadratic; its fingerprints go on to the sub-code with fewer Hamming blocks and more
free bits, of smaller radius (nine, then six, three and zero), whose anchors part them. The proof holds
for every code of the row, so a pair that links is compared at the first code at which an anchor of its
common neighbours is not crowded. At radius zero an anchor has 65 fingerprints at most. Nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, table
from .graph import connected_components

_ONE = np.uint64(1)
_FLIPS = np.concatenate([np.zeros(1, np.uint64), _ONE << np.arange(64, dtype=np.uint64)])


def fingerprint(text: str | None, width: int = 3, seed: int = 42, block: int = 1 << 16) -> int:
    """64-bit SimHash of ``width``-word shingles, repeats included; 0 where there is no word."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)))) if len(words) >= width else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(s, seed) for s in shingles), dtype="<u8", count=n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, block):
        part = h[i : i + block]
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(len(part), 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


#: Hamming blocks of the codes from coarse to fine; their number is the covering radius.
BLOCKS = (9, 6, 3, 0)


def nearest_anchor(f: np.ndarray, blocks: int = 9) -> np.ndarray:
    """A name of the code word nearest to each 64-bit word, where the first ``blocks`` sevens of bits are Hamming blocks.

    Bit k of block i is bit 9 * k + i of the word, so a block's bits are those nine apart. The name is the code word
    itself: in each block at most the one bit that breaks its parities is turned.
    """
    mask = np.uint64((1 << blocks) - 1)
    s = [None, *((f >> np.uint64(9 * i)) & mask for i in range(7))]
    p1, p2, p3 = s[1] ^ s[3] ^ s[5] ^ s[7], s[2] ^ s[3] ^ s[6] ^ s[7], s[4] ^ s[5] ^ s[6] ^ s[7]
    out = f
    for place in range(1, 8):  # the three parities spell the place of the bit to turn
        wrong = (p1 if place & 1 else p1 ^ mask) & (p2 if place & 2 else p2 ^ mask) & (p3 if place & 4 else p3 ^ mask)
        out = out ^ (wrong << np.uint64(9 * (place - 1)))
    return out


def _prints(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        prints = np.array([fingerprint(t) for t in part.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints, pa.int64()), part.column(2)], names=["id", "fp", "with"])


def replicas(prints: DataFrame, blocks: int) -> DataFrame:
    """(anchor, fp): each fingerprint at the anchors nearest to itself and to its one-bit neighbours."""

    def placed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in parts:
            for at in range(0, len(whole), 4096):
                f = whole["fp"].to_numpy()[at : at + 4096].view(np.uint64)
                anchors = np.sort(nearest_anchor(f[:, None] ^ _FLIPS[None, :], blocks), axis=1)
                new = np.ones(anchors.shape, bool)
                new[:, 1:] = anchors[:, 1:] != anchors[:, :-1]
                yield pd.DataFrame({"anchor": anchors[new].view(np.int64), "fp": np.repeat(f, new.sum(1)).view(np.int64)})

    return prints.select("fp").mapInPandas(placed, "anchor long, fp long")


def links(prints: DataFrame, crowd: int = 128) -> DataFrame:
    """Edges (u, v) over the distinct long column ``fp``: all pairs at distance two or less.

    An anchor of more than ``crowd`` fingerprints hands them on to the next sub-code.
    """
    if crowd < len(_FLIPS):
        raise ValueError("an anchor of radius zero can hold 65 fingerprints")
    found = None
    for blocks in BLOCKS:
        at = table(replicas(prints, blocks), "replicas")
        full = table(at.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select(F.col("anchor").alias("a"), "n"), "anchors")
        met = at.join(full, F.col("anchor") == F.col("a"))
        lists = met.where(F.col("n") <= crowd).groupBy("anchor").agg(F.collect_list("fp").alias("fps"))
        pairs = lists.select(F.explode("fps").alias("u"), "fps")
        pairs = pairs.select("u", F.explode(F.filter("fps", lambda v: (v > F.col("u")) & (F.bit_count(v.bitwiseXOR(F.col("u"))) <= 2))).alias("v"))
        pairs = table(pairs.distinct(), "pairs")
        found = pairs if found is None else found.unionByName(pairs)
        if full.where(F.col("n") > crowd).isEmpty():
            break
        prints = table(met.where(F.col("n") > crowd).select("fp").distinct(), "crowd")
    return found.distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """One row per input row: id, fp (long), fingerprint (hex), component_id (least id reachable), kept, and the columns ``carry``.

    ``kept`` marks one row of each component: the first by id, nulls last, then by its place in the input.
    A null or wordless text has fingerprint zero and links like any other; texts of any length are read
    whole. Rows that repeat an id are each returned, and all but one of those that link are not kept. A null
    id is the least of its component only if there is no other. ``docs`` may be empty and may hold any
    further columns; they aren't read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"), F.struct(*carry, F.lit(0)).alias("with"))
    made = rows.mapInArrow(_prints, T.StructType([T.StructField("id", T.LongType()), T.StructField("fp", T.LongType()), T.StructField("with", rows.schema["with"].dataType)]))
    prints = table(made.withColumn("row", F.monotonically_increasing_id()), "prints")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    groups = table(prints.groupBy("fp").agg(F.min(order).alias("first")), "groups")
    member = table(connected_components(links(groups)).select(F.col("node").alias("fp"), F.col("component").alias("root")), "members")
    least = member.join(groups, "fp").groupBy("root").agg(F.min("first").alias("least"))
    named = table(
        groups.join(member.join(least, "root").select("fp", "least"), "fp", "left").select(F.col("fp").alias("k"), F.coalesce("least", "first").alias("best")), "named"
    )
    return prints.join(named, F.col("fp") == F.col("k")).select(
        F.col("id").alias(id_col),
        "fp",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best.id").alias("component_id"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        *[F.col("with")[c].alias(c) for c in carry],
    )
