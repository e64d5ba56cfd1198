"""Fill-in-the-middle transformation of texts cut at token boundaries.

Tokens are runs of ASCII letters and single other code points. The bytes at which tokens begin are set bits of a packed
bitvector, with a directory of popcounts by block: its total is the number of tokens, and the byte at which a token
begins is a select on its rank. So two ranks give two byte cuts, without a list of tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
KIND = "struct<n:long,form:string,prefix_chars:long,middle_chars:long,output:string>"


@dataclass(frozen=True)
class Params:
    """Percentages of hashes: ``changed`` are cut at all, of these ``suffix_first`` have their suffix first."""

    changed: int = 90
    suffix_first: int = 20
    salt: str = "1:"


class Bits:
    """A packed bitvector with the popcounts before each block of 512 bits."""

    BLOCK = 8  # 64-bit words

    def __init__(self, flags: np.ndarray) -> None:
        size = -(-max(1, len(flags)) // 512) * 64
        packed = np.zeros(size, np.uint8)
        packed[: -(-len(flags) // 8)] = np.packbits(flags, bitorder="little")
        self.words = packed.view("<u8")
        self.counts = np.bitwise_count(self.words)
        self.before = np.concatenate([[0], np.cumsum(self.counts.reshape(-1, self.BLOCK).sum(1, dtype=np.int64))])

    @property
    def total(self) -> int:
        return int(self.before[-1])

    def rank(self, place: int) -> int:
        """Set bits before ``place``."""
        word, bit = divmod(place, 64)
        block = word // self.BLOCK
        ones = int(self.before[block]) + int(self.counts[block * self.BLOCK : word].sum(dtype=np.int64))
        return ones + (int(self.words[word]) & ((1 << bit) - 1)).bit_count() if bit else ones

    def select(self, rank: int) -> int:
        """The place of the set bit that has ``rank`` set bits before it."""
        block = int(np.searchsorted(self.before, rank, side="right")) - 1
        left = rank - int(self.before[block])
        own = np.cumsum(self.counts[block * self.BLOCK : (block + 1) * self.BLOCK], dtype=np.int64)
        k = int(np.searchsorted(own, left, side="right"))
        left -= int(own[k - 1]) if k else 0
        word = block * self.BLOCK + k
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return word * 64 + int(np.flatnonzero(bits)[left])


def beginnings(text: bytes) -> Bits:
    """The bytes of UTF-8 text at which a token begins."""
    b = np.frombuffer(text, np.uint8)
    letter = ((b | 32) - 97).astype(np.uint8) < 26
    starts = (b & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    return Bits(starts)


def _chars(text: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def cut(text: bytes, h: tuple[int, int, int, int], params: Params = Params()) -> tuple[int, str, int | None, int | None, bytes]:
    """(tokens, form, code points of prefix and middle, output) of a text for four hashes."""
    bits = beginnings(text)
    n = bits.total
    if not text or h[2] % 100 >= params.changed or any(m.encode() in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = (bits.select(r) if r < n else len(text) for r in (low, high))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = PREFIX.encode() + prefix, SUFFIX.encode() + suffix, MIDDLE.encode() + middle
    if h[3] % 100 < params.suffix_first:
        return n, "spm", _chars(prefix), _chars(middle), s + p + m
    return n, "psm", _chars(prefix), _chars(middle), p + s + m


def hashes(doc_id: Column, salt: str) -> Column:
    """The first four 8-digit groups of the SHA-256 of the salted id, as longs; a null id counts as empty."""
    digits = F.sha2(F.concat(F.lit(salt), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", into: str = "fim", params: Params = Params()) -> DataFrame:
    """``docs`` plus the struct ``into``: n tokens, form (plain, psm or spm), code points of prefix and middle, output text.

    Each row is handled by itself, whole: repeated rows give equal results, a null or empty text stays an empty plain one,
    and a text that holds one of the markers stays plain. All columns of ``docs`` stay; one named as ``into`` is an error.
    """
    if into.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {into} already")
    small_batches(docs.sparkSession)
    kept = docs.columns
    ready = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"), hashes(F.col(id_col), params.salt).alias("h"))

    def made(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = [cut(t, h, params) for t, h in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
            n, form, prefix, middle, text = zip(*out) if out else ((),) * 5
            columns = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(text, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.StructArray.from_arrays(columns, ["n", "form", "prefix_chars", "middle_chars", "output"])], names=["row", "made"])

    row = ready.schema["row"].dataType.simpleString()
    done = ready.mapInArrow(made, f"row {row}, made {KIND}")
    return done.select(*[F.col("row").getField(c).alias(c) for c in kept], F.col("made").alias(into))


def restored(output: Column, form: Column) -> Column:
    """The exact text that an output was made of. No marker can begin inside another or across a seam, so each is found."""
    before = lambda x, m: F.substring_index(x, m, 1)
    after = lambda x, m: F.substr(x, F.length(F.substring_index(x, m, 1)) + len(m) + 1)
    psm = F.concat(before(after(output, PREFIX), SUFFIX), after(output, MIDDLE), before(after(output, SUFFIX), MIDDLE))
    spm = F.concat(before(after(output, PREFIX), MIDDLE), after(output, MIDDLE), before(after(output, SUFFIX), PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
