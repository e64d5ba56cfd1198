"""Token-ID output: zstandard frames, one a document, with a shared dictionary, in blocks with an offset index.

A store is a folder with three tables, written by Spark's own writers so that any file system that
Spark reaches will do and a lost task leaves nothing half-written:

* ``dictionary``: one row: its bytes, their SHA-256 (by which every block names it), its id, format, level.
* ``blocks``: rows sorted by document id. A block's ``payload`` is the frames of its documents one after
  another; ``offsets`` (one more than documents) says where each begins, so one document is read
  without touching the others. Ids are little-endian unsigned 16-bit (32-bit for vocabularies over 65536).
* ``index``: for each block its first document, number of ids and the ids before it.
"""

from __future__ import annotations

import array
import functools
import hashlib
import json
import os
import re
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import hashed_sample, shared_dir, small_batches, table

#: Unicode white space, as in the vocabulary's own rule for splitting text.
_SPACE = "\t-\r \x85\xa0  -     　"
#: ASCII marks but the apostrophe, which can begin a contraction.
_MARKS = "!-&(-/:-@\\[-`{-~"
#: Latin letters.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: A word with the one blank before it and without the marks after it, any other run with its blank, or white
#: space up to that. Byte-level BPE never merges across the ends of these.
_UNIT = re.compile(f" ?[{_LETTERS}]+(?=[{_SPACE}{_MARKS}]|$)| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_LETTERS_ONLY = re.compile(f" ?[{_LETTERS}]+")
#: Byte-level BPE writes a byte as the character of its code where that is visible, else as the next one from 256 on.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_ALPHABET = {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in _VISIBLE)}
BLOCK = "first_doc long, doc_ids array<long>, counts array<long>, offsets array<int>, n_ids long, dictionary string, payload binary"


@dataclass(frozen=True)
class Params:
    """``sample`` documents at most (those of least hash) train the dictionary, ``piece`` bytes of each at most."""

    end_id: int = 0
    dictionary: int = 64 * 1024
    sample: int = 1000
    piece: int = 16 * 1024
    level: int = 3
    block_bytes: int = 1 << 20
    cache: int = 400_000


class Encoder(dict):
    """Serialized ids of whole texts; itself the ids of units met before, the first ``cache`` of them."""

    def __init__(self, path: str, params: Params):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tool, self.room = Tokenizer.from_file(path), params.cache
        self.kind = np.dtype("<u2" if self.tool.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.added = [t.content for t in self.tool.get_added_tokens_decoder().values()]
        self.end = self.serialized([params.end_id])
        self.tokenize = self.tool.model.tokenize
        known = json.loads(self.tool.to_str())
        split = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        #: Only this way of splitting a text into pre-tokens is known to keep units apart; other files take whole texts.
        self.by_unit = (
            split.items() <= (known["pre_tokenizer"] or {}).items() and not known["normalizer"] and known["model"]["type"] == "BPE" and not known["model"].get("dropout")
        )

    def serialized(self, ids: list[int]) -> bytes:
        out = array.array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def whole(self, text: str) -> bytes:
        return self.serialized(self.tool.encode(text, add_special_tokens=False).ids)

    def unit(self, unit: str) -> bytes:
        """A unit of letters is one pre-token, so it goes to the library's model at once, in its byte alphabet."""
        if _LETTERS_ONLY.fullmatch(unit):
            return self.serialized([t.id for t in self.tokenize(unit.encode().decode("latin-1").translate(_BYTE_ALPHABET))])
        return self.whole(unit)

    def __missing__(self, unit: str) -> bytes:
        out = self.unit(unit)
        if self.room:
            self.room -= 1
            self[unit] = out
        return out

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """The serialized ids of each text with the end id; null is an empty text."""
        if not self.by_unit:
            return [self.serialized(x.ids) + self.end for x in self.tool.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
        get = self.__getitem__
        return [
            (b"" if not t else self.whole(t) if any(a in t for a in self.added) else b"".join(map(get, _UNIT.findall(t)))) + self.end for t in texts  # added tokens may cross white space
        ]


@functools.lru_cache(maxsize=2)
def encoder(path: str, params: Params) -> Encoder:
    """One encoder for all tasks that a Python worker runs; what it keeps is bounded."""
    return Encoder(path, params)


def train_dictionary(docs: DataFrame, path: str, id_col: str, text_col: str, params: Params) -> bytes:
    """A zstandard dictionary of the serialized ids of a bounded sample, a sixteenth of it in size at most.

    Rows are chosen by the hash of id and text, equal ones once; of a long one a piece at a place that its ids choose.
    A sample too small to train on is the dictionary itself, as raw content; empty where there is no row.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.xxhash64(F.col(id_col), text).alias("h"), text.alias("t"))
    chosen = table(hashed_sample(rows.select("h"), ["h"], params.sample).distinct(), "sample")

    def encoded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path, params)
        step = tool.kind.itemsize
        for part in parts:
            out = []
            for x in tool(part.column(1).to_pylist()):
                at = zlib.crc32(x) % (max(0, len(x) - params.piece) // step + 1) * step
                out.append(x[at : at + params.piece])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.binary())], names=["h", "ids"])

    some = rows.join(F.broadcast(chosen.withColumnRenamed("h", "x")), F.col("h") == F.col("x"), "left_semi").mapInArrow(encoded, "h long, ids binary")
    samples = sorted(bytes(r["ids"]) for r in some.groupBy("h").agg(F.min("ids").alias("ids")).collect())
    size = min(params.dictionary, sum(map(len, samples)) // 16)
    if size >= 1024 and len(samples) >= 16:
        return zstandard.train_dictionary(size, samples, k=256, d=8, level=params.level).as_bytes()
    raw = b"".join(samples)[: params.dictionary]
    return raw if len(raw) >= 8 else b""


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def write(docs: DataFrame, root: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", params: Params = Params(), partitions: int | None = None) -> str:
    """Write a store of ``docs`` at ``root`` and return it.

    Documents go by ascending id, null ids first; rows that repeat an id follow each other by their number of
    ids and their frames, and can be parted between files, so that no task holds all of them. A null or empty
    text is the end id alone; a very long one is encoded whole, as one frame. Other columns aren't read. An
    empty table gives an empty store.
    """
    spark = docs.sparkSession
    small_batches(spark, 500)
    raw = train_dictionary(docs, tokenizer, id_col, text_col, params)
    name = hashlib.sha256(raw).hexdigest()
    made = [(raw, name, params.level, params.end_id, Encoder(tokenizer, params).kind.str)]
    spark.createDataFrame(made, "bytes binary, sha256 string, level int, end_id int, dtype string").coalesce(1).write.parquet(f"{root}/dictionary")

    def frames(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer, params)
        press = zstandard.ZstdCompressor(level=params.level, dict_data=_dictionary(raw), write_dict_id=False)
        for part in parts:
            ids = tool(part.column(1).to_pylist())
            counts = pa.array([len(x) // tool.kind.itemsize for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), counts, pa.array([press.compress(x) for x in ids], pa.binary())], names=["id", "n", "frame"])

    def blocks(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list = []
        counts: list[int] = []
        held: list[bytes] = []

        def out() -> pd.DataFrame:
            row = (ids[0], list(ids), list(counts), np.cumsum([0, *map(len, held)]).tolist(), sum(counts), name, b"".join(held))
            for x in (ids, counts, held):
                x.clear()
            return pd.DataFrame([row], columns=["first_doc", "doc_ids", "counts", "offsets", "n_ids", "dictionary", "payload"]).astype({"first_doc": "Int64"})

        size = 0
        for part in parts:
            for i, n, frame in zip(part["id"].astype("Int64"), part["n"], part["frame"]):
                ids.append(None if i is pd.NA else int(i))
                counts.append(int(n))
                held.append(frame)
                size += len(frame)
                if size >= params.block_bytes:
                    size = 0
                    yield out()
        if held:
            yield out()

    parts = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).mapInArrow(frames, "id long, n long, frame binary")
    rows = table(rows, "frames")  # so that ranges are found without encoding twice
    rows = rows.withColumns({"hash": F.xxhash64("frame"), "row": F.monotonically_increasing_id()})  # rows with equal frames may go either way
    order = (F.col("id").asc_nulls_first(), "n", "hash", "row")
    rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "n", "frame").mapInPandas(blocks, BLOCK).write.parquet(f"{root}/blocks")
    _index(spark, root).coalesce(1).write.parquet(f"{root}/index")
    return root


def _index(spark: SparkSession, root: str) -> DataFrame:
    """Ids before each block: within the files, which hold ranges of ids and are numbered in their order, and over the files' sums."""
    own = spark.read.parquet(f"{root}/blocks").select("first_doc", "n_ids", F.element_at("doc_ids", -1).alias("last_doc"), F.input_file_name().alias("file"), F.col("_metadata.row_index").alias("row"))
    files = own.groupBy("file").agg(F.sum("n_ids").alias("ids")).withColumn("at", F.regexp_extract("file", r"/part-(\d+)-[^/]*$", 1).cast("long"))
    earlier = Window.orderBy("at", "file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    starts = files.select(F.col("file").alias("f"), F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("file_start"))
    within = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return own.withColumn("here", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(starts, F.col("file") == F.col("f")).select(
        F.element_at(F.split("file", "/"), -1).alias("file"), "row", "first_doc", "last_doc", "n_ids", (F.col("file_start") + F.col("here")).alias("start")
    )


def read(spark: SparkSession, root: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, frame_bytes) of each document, decoded from its frame in the store."""
    small_batches(spark, 64)
    head = spark.read.parquet(f"{root}/dictionary").first()
    raw, kind = bytes(head["bytes"]), np.dtype(head["dtype"])
    if hashlib.sha256(raw).hexdigest() != head["sha256"]:
        raise ValueError("the dictionary is not the one that the store names")

    def decoded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor(dict_data=_dictionary(raw))
        for part in parts:
            out: tuple[list, ...] = ([], [], [], [], [])
            for r in part.to_pylist():
                if r["dictionary"] != head["sha256"]:
                    raise ValueError("a block names another dictionary")
                at = r["start"]
                for i, doc in enumerate(r["doc_ids"]):
                    ids = np.frombuffer(tool.decompress(r["payload"][r["offsets"][i] : r["offsets"][i + 1]]), kind)
                    for column, value in zip(out, (doc, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), r["offsets"][i + 1] - r["offsets"][i])):
                        column.append(value)
                    at += len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["doc_id", "start", "n_tokens", "ids_crc32", "frame_bytes"])

    blocks = spark.read.parquet(f"{root}/blocks").withColumns({"file": F.element_at(F.split(F.input_file_name(), "/"), -1), "row": F.col("_metadata.row_index")})
    index = spark.read.parquet(f"{root}/index").select(F.col("file").alias("f"), F.col("row").alias("r"), "start")
    rows = blocks.join(F.broadcast(index), (F.col("file") == F.col("f")) & (F.col("row") == F.col("r"))) if index.count() <= 1_000_000 else blocks.join(index, (F.col("file") == F.col("f")) & (F.col("row") == F.col("r")))
    return rows.select("doc_ids", "offsets", "dictionary", "payload", "start").mapInArrow(decoded, "doc_id long, start long, n_tokens long, ids_crc32 long, frame_bytes long")


def document(spark: SparkSession, root: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document (each row that has the id), read through the index: one file, its blocks, one frame each."""
    head = spark.read.parquet(f"{root}/dictionary").first()
    tool = zstandard.ZstdDecompressor(dict_data=_dictionary(bytes(head["bytes"])))
    where = spark.read.parquet(f"{root}/index").where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id)).collect()
    out = []
    for at in where:
        block = spark.read.parquet(f"{root}/blocks/{at['file']}").where(F.col("_metadata.row_index") == at["row"]).first()
        for i, doc in enumerate(block["doc_ids"]):
            if doc == doc_id:
                out.append(np.frombuffer(tool.decompress(bytes(block["payload"][block["offsets"][i] : block["offsets"][i + 1]])), np.dtype(head["dtype"])))
    return out


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", params: Params = Params()) -> DataFrame:
    """Write a store in the shared folder and return what ``read`` finds in it."""
    root = shared_dir(docs.sparkSession, "tokens")
    return read(docs.sparkSession, write(docs, root, tokenizer, id_col, text_col, params))
