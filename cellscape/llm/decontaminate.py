"""Benchmark decontamination: size-partitioned MinHash containment search, in DataFrame operations only.

Test items are partitioned by how many distinct five-word shingles they hold. An item's signature is its
bottom-m MinHash sketch: the m shingles of least 64-bit hash, where m is set for the partition so that
(1 - threshold) of its largest member's shingles is less than m. A document that holds at least
``threshold`` of an item's shingles misses fewer than m of them, so it holds one of the signature: the
search loses nothing, however long the document. Shingles that several items share come last in the
order of a sketch, so a frame that many items have in common makes nothing a candidate as long as an
item has enough shingles of its own.
Documents meet signatures alone first; only the candidates that come of it are verified, by counting
the item's shingles that the document holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

#: Rows of up to 40 bytes each that are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; an empty array for null or none."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def _hashed(width: int) -> Column:
    return F.xxhash64(*[F.get("w", F.col("i") + k) for k in range(width)])


def shingle_rows(df: DataFrame, id_col: str, text_col: str, widths: Sequence[int] = (5,)) -> DataFrame:
    """(id, h) for each run of ``widths`` words of each text, repeats included; a text without one has no row."""
    kinds = sorted(widths)
    rows = df.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("w")).where(F.size("w") >= kinds[0])
    last = (F.size("w") - kinds[0] + 1) * len(kinds) - 1
    rows = rows.select("id", "w", F.explode(F.sequence(F.lit(0), last)).alias("p"))  # one generator, so that no row carries its words on
    rows = rows.select("id", "w", F.floor(F.col("p") / len(kinds)).cast("int").alias("i"), (F.col("p") % len(kinds)).alias("kind"))
    h = _hashed(kinds[-1])
    for n, k in enumerate(kinds[:-1]):
        h = F.when(F.col("kind") == n, _hashed(k)).otherwise(h)
    if len(kinds) > 1:
        rows = rows.where(F.get(F.array(*map(F.lit, kinds)), F.col("kind")) + F.col("i") <= F.size("w"))
    return rows.select("id", h.alias("h"))


def item_shingles(items: DataFrame, id_col: str, text_col: str, width: int = 5) -> DataFrame:
    """(item, k, h): distinct shingles of each item, of ``k`` words; an item of fewer words is one shingle of all its words."""
    rows = items.select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    rows = rows.select("item", "w", F.least(F.size("w"), F.lit(width)).alias("k"))
    rows = rows.select("item", "w", "k", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("k"))).alias("i"))
    h = _hashed(width)
    for k in range(1, width):
        h = F.when(F.col("k") == k, _hashed(k)).otherwise(h)
    return rows.select("item", "k", h.alias("h")).distinct()


def partition_of(size: Column) -> Column:
    """Size partition: the number of binary digits of the shingle count."""
    return F.length(F.bin(size))


def signatures(items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(item, size, h, signs) from (item, h); ``signs`` marks the bottom-m sketch of the item's partition.

    The sketch's order is by how many items hold a shingle, then by its hash.
    """
    by_hash = Window.partitionBy("item").orderBy("shared_by", "h")
    sized = items.withColumn("size", F.count("*").over(Window.partitionBy("item"))).withColumn("part", partition_of(F.col("size")))
    held = items.groupBy(F.col("h").alias("x")).agg(F.count("*").alias("shared_by"))
    largest = sized.groupBy("part").agg(F.max("size").alias("top")).select(F.col("part").alias("p"), "top")
    missing = F.floor(F.col("top") * F.lit(round(1 - threshold, 9)) + F.lit(1e-9))
    return (
        sized.join(held, F.col("h") == F.col("x"))
        .join(F.broadcast(largest), F.col("part") == F.col("p"))  # one row for each binary digit of a count
        .withColumn("signs", F.row_number().over(by_hash) <= missing + 1)
        .select("item", "size", "h", "signs")
    )


def contained(
    docs: DataFrame, benchmark: DataFrame, doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    width: int = 5, threshold: float = 0.8,
) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment) for all pairs of containment >= threshold.

    An item of fewer than ``width`` words is one shingle of all its words, found where a document holds
    them in a row. Null and wordless texts hold no shingle and match nothing. Rows that share an id are one
    document, or one item; so are those whose id is null. Texts of any length are read whole, a shingle a
    row. Repeated rows and ties change nothing, columns other than the four named aren't read.
    """
    shingles = table(item_shingles(benchmark, item_col, item_text_col, width), "items")
    widths = sorted({width, *(r["k"] for r in shingles.select("k").distinct().collect())})  # at most ``width`` numbers
    items = table(signatures(shingles.select("item", "h").distinct(), threshold), "signatures")
    small = F.broadcast if items.count() <= BROADCAST_ROWS else (lambda df: df)
    sketch = items.where("signs").select("item", F.col("h").alias("k"))
    met = shingle_rows(docs, doc_col, text_col, widths).join(small(sketch.select("k").distinct()), F.col("h") == F.col("k"), "left_semi")
    met = met.groupBy("id", "h").agg(F.count("*").alias("times"))  # combined before it is shuffled
    candidates = table(met.join(small(sketch), F.col("h") == F.col("k")).select("id", "item").distinct(), "candidates")
    asked = candidates.select(F.col("id").alias("a")).distinct()
    some = docs.join(F.broadcast(asked) if candidates.count() <= BROADCAST_ROWS else asked, F.col(doc_col).eqNullSafe(F.col("a")), "left_semi")
    held = shingle_rows(some, doc_col, text_col, widths).join(small(items.select(F.col("h").alias("k")).distinct()), F.col("h") == F.col("k"), "left_semi")
    held = held.groupBy("id", "h").agg(F.count("*").alias("times"))
    pairs = held.join(candidates.select(F.col("id").alias("a"), F.col("item").alias("b")), F.col("id").eqNullSafe(F.col("a"))).select("id", "b", "h")
    exact = pairs.join(small(items.select("item", "size", F.col("h").alias("k"))), F.col("b").eqNullSafe(F.col("item")) & (F.col("h") == F.col("k")))
    return (
        exact.groupBy("id", "item", "size").agg(F.count("*").alias("shared")).where(F.col("shared") >= F.lit(threshold) * F.col("size") - F.lit(1e-9))
        .select(
            F.col("id").alias(doc_col), F.col("item").alias(item_col), "shared", F.col("size").alias("item_shingles"),
            (F.col("shared") / F.col("size")).alias("containment"),
        )
    )
