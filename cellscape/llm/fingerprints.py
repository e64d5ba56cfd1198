"""Document fingerprints by one-permutation MinHash, in DataFrame operations only.

Every word shingle of a text is hashed once. The hash's first bits name a bin, and each bin keeps its least hash. A bin
that no shingle met takes the hash of another one by optimal densification: each bin has a random order of all bins of its
own, and its donor is the first in it that isn't empty. So two texts' bins agree with the probability of their Jaccard
similarity, however short they are. What is stored of a bin is ``bits`` low-order bits of its hash mixed with its own
number (so that bins of one donor don't all agree by chance together), packed in 64-bit words; chance agreement of those
bits is taken out of the similarity that two fingerprints tell.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, free


@dataclass(frozen=True)
class Params:
    """``bins`` is a power of two, ``bits`` divides 64. ``probes`` donors are looked up directly, later ones searched."""

    width: int = 5
    bins: int = 256
    bits: int = 4
    probes: int = 12
    seed: int = 42

    @property
    def shift(self) -> int:
        """Bits of a hash below those that name its bin."""
        return 64 - (self.bins.bit_length() - 1)


def words(text: Column) -> Column:
    """Lower-cased words between ASCII white space; an array of the empty text where there is none."""
    return F.split(F.lower(F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))), r"[\x20\x09-\x0D]+")


def _order(j: int, i: int, seed: int) -> int:
    """What Spark's ``xxhash64(seed, j, i)`` gives for three ints."""
    h = 42
    for x in (seed, j, i):
        h = xxhash.xxh64_intdigest(struct.pack("<i", x), h)
    return h - (1 << 64) if h >> 63 else h


def donors(params: Params) -> list[list[int]]:
    """The first ``probes`` bins of each bin's order of all others, a list for each probe."""
    near = [sorted((i for i in range(params.bins) if i != j), key=lambda i: _order(j, i, params.seed))[: params.probes] for j in range(params.bins)]
    return [[near[j][t] for j in range(params.bins)] for t in range(params.probes)]


def with_fingerprint(df: DataFrame, text: Column, into: str, params: Params = Params()) -> DataFrame:
    """``df`` plus ``into``, the packed fingerprint (array<long>) of a text.

    A text of fewer words than a shingle is one shingle; a null, empty or wordless one has a fingerprint of zeros.
    Equal texts have equal fingerprints. Each text is handled by itself, so ties and repeated rows change nothing, and all
    columns of ``df`` stay. Steps are columns of their own, so that none is computed twice.
    """
    n, low = params.bins, (1 << params.shift) - 1
    w, h, bins, held = free(df, "fp_words", "fp_hashes", "fp_bins", "fp_held")
    kept = df.columns
    empty = lambda x: x.bitwiseAND(F.lit(low)) == low
    of = lambda x: F.shiftright(x, params.shift).cast("int")

    out = df.select("*", words(text).alias(w))
    shingle = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(params.width)])  # noqa: E731  nulls beyond the last word don't count
    hashes = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - params.width, F.lit(0))), shingle)
    hashes = F.when(F.get(w, F.lit(0)) != "", hashes).otherwise(F.array().cast("array<bigint>"))
    ends = F.from_json(F.lit(str([(b << params.shift) + low for b in range(-n // 2, n // 2)])), "array<bigint>")  # the largest hash of each bin stands for an empty one
    ends = F.transform(ends, lambda x: F.coalesce(x, F.lit(0).cast("long")))  # tells that no element is null, so that longs are sorted as such
    out = out.select(*kept, F.sort_array(F.concat(hashes, ends)).alias(h))
    first = lambda x, i: (i == 0) | (F.shiftright(x, params.shift) != F.shiftright(F.get(h, i - 1), params.shift))
    out = out.select(*kept, F.filter(h, first).alias(bins))
    out = out.select(*kept, bins, F.filter(bins, lambda x: ~empty(x)).alias(held))

    def filled(x: Column, j: Column) -> Column:
        tried = []
        for row in donors(params):
            y = F.get(bins, F.get(F.from_json(F.lit(str(row)), "array<int>"), j))
            tried.append(F.when(~empty(y), y))
        last = F.array_min(F.transform(held, lambda v: F.struct(F.xxhash64(F.lit(params.seed), j, of(v) + n // 2).alias("o"), v.alias("v"))))["v"]
        value = F.coalesce(F.when(~empty(x), x), *tried, last)
        return F.xxhash64(value, j).bitwiseAND(F.lit((1 << params.bits) - 1))

    each = 64 // params.bits
    places = [list(range(k, k + each)) for k in range(0, n, each)]
    word = lambda b, at: F.aggregate(at, F.lit(0).cast("long"), lambda a, i: F.shiftleft(a, params.bits).bitwiseOR(F.get(b, i)))
    pack = lambda b: F.transform(F.from_json(F.lit(str(places)), "array<array<int>>"), lambda at: word(b, at))
    packed = F.get(F.transform(F.array(F.transform(bins, filled)), pack), F.lit(0))  # an array of one, so that bits are made once for all words
    zeros = F.array_repeat(F.lit(0).cast("long"), n // each)
    return out.select(*kept, F.when(F.size(held) > 0, packed).otherwise(zeros).alias(into))


def as_text(packed: Column) -> Column:
    """The fingerprint as hex digits."""
    return F.lower(F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column, params: Params = Params()) -> Column:
    """Estimate of the Jaccard similarity of two texts' shingles by their fingerprints, from 0 to 1.

    The share of equal bins, less what equals by chance. Two wordless texts are alike, one is unlike any other text.
    """
    ones = sum(1 << (params.bits * k) for k in range(64 // params.bits))
    ones = ones - (1 << 64) if ones >> 63 else ones

    def different(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        folded = d
        for k in range(1, params.bits):
            folded = folded.bitwiseOR(F.shiftrightunsigned(d, k))
        return F.bit_count(folded.bitwiseAND(F.lit(ones)))

    total = F.aggregate(F.zip_with(a, b, different), F.lit(0), lambda s, x: s + x)
    chance = 2.0**-params.bits
    estimate = F.greatest(F.lit(0.0), ((1 - total / params.bins) - chance) / (1 - chance))
    none = lambda x: F.forall(x, lambda v: v == 0)
    return F.when(a == b, F.lit(1.0)).when(none(a) | none(b), F.lit(0.0)).otherwise(estimate)
