"""Language identification by compression: the per-language zstandard dictionary that shortens a text most wins."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, table

UNKNOWN = "und"
#: The library makes nothing of a dictionary of fewer bytes, so such content is repeated.
_LEAST = 8
_LETTERS = regex.compile(r"\p{L}+")
_RESULT = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
)


@dataclass(frozen=True)
class Params:
    """``rows_per_lang`` labelled rows at most train each language, by ``piece`` characters at a place of each that its hash
    chooses; a language's dictionary is so ``rows_per_lang * piece`` characters at most. Texts of all sizes are measured
    alike, in equal spans of up to ``span`` bytes, each against the fresh dictionary: a dictionary saves a bounded part of
    what it begins, so the margin of a long text measured in one would fall with its length."""

    rows_per_lang: int = 64
    piece: int = 1024
    span: int = 4096
    level: int = 12
    min_margin: float = 0.01
    max_langs: int = 500


def normalise(text: str | None) -> bytes:
    """Lower-cased runs of letters, a space after each."""
    found = _LETTERS.findall((text or "").lower())
    return (" ".join(found) + " ").encode() if found else b""


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", params: Params = Params()) -> dict[str, bytes]:
    """Raw dictionary content by language, from a bounded sample of the rows with a non-null language.

    Hash buckets give the sample without ordering any language's rows: of each of ``rows_per_lang`` buckets the text of
    least hash, whatever its id (equal texts are one, those without a letter none). Only hashes are compared for that; pieces
    are cut from the chosen rows alone, so what the driver gets is bounded by ``Params``. Every language with a letter in its
    pieces is learned, however little there is of it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    known = labelled.where(F.col(lang_col).isNotNull()).where(text.rlike(r"\p{L}")).select(F.col(lang_col).alias("l"), text.alias("t"), F.xxhash64(text).alias("h"))
    least = table(known.groupBy("l", F.pmod("h", F.lit(params.rows_per_lang)).alias("b")).agg(F.min("h").alias("h")), "least")
    if least.select("l").distinct().count() > params.max_langs:
        raise ValueError(f"more than {params.max_langs} languages")
    spare = F.greatest(F.length("t") - params.piece, F.lit(0)) + 1
    piece = F.substring("t", (F.pmod("h", spare) + 1).cast("int"), F.lit(params.piece))
    chosen = F.broadcast(least.select(F.col("l").alias("x"), F.col("h").alias("y")))  # max_langs * rows_per_lang rows at most
    rows = known.join(chosen, (F.col("l") == F.col("x")) & (F.col("h") == F.col("y")), "left_semi").select("l", "h", piece.alias("p"))
    content: dict[str, bytes] = {}
    for r in sorted(rows.groupBy("l", "h").agg(F.min("p").alias("p")).collect(), key=lambda r: (r["l"], r["h"])):
        content[r["l"]] = content.get(r["l"], b"") + normalise(r["p"])
    return {l: c for l, c in content.items() if c}


class Classifier:
    """Compressed sizes of a text under each language's dictionary."""

    def __init__(self, content: dict[str, bytes], params: Params):
        def tool(raw: bytes) -> zstandard.ZstdCompressor:
            raw = raw if len(raw) >= _LEAST else raw * _LEAST
            made = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(level=params.level)
            return zstandard.ZstdCompressor(level=params.level, dict_data=made, write_checksum=False, write_content_size=False, write_dict_id=False)

        self.params, self.tools = params, {lang: tool(raw) for lang, raw in sorted(content.items())}

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """(language, margin as a share of the second smallest size, rejected)."""
        data = normalise(text)
        if not data or not self.tools:
            return UNKNOWN, 0.0, True
        step = -(-len(data) // -(-len(data) // self.params.span))
        spans = [data[i : i + step] for i in range(0, len(data), step)]
        sizes = sorted((sum(len(t.compress(x)) for x in spans), lang) for lang, t in self.tools.items())
        margin = 1 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0
        return sizes[0][1], margin, margin < self.params.min_margin


def classify(docs: DataFrame, content: dict[str, bytes], text_col: str = "text", into: str = "language", params: Params = Params()) -> DataFrame:
    """``docs`` with a struct column ``into`` (lang_pred, score, rejected); all else stays as it is.

    A null text or one without a letter (Unicode category L) is ``und`` with score 0 and rejected; so is
    all where no language was learned. Ties go to the first language by code point and are rejected. Each row
    is judged by its own text, whole, however long; rows that repeat an id, or have none, are rows like any other.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf(_RESULT)
    def language(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tool = Classifier(content, params)
        for part in parts:
            yield pd.DataFrame([tool(t) for t in part], columns=["lang_pred", "score", "rejected"])

    return docs.withColumn(into, language(F.col(text_col)))
