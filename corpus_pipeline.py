"""A corpus pipeline: documents in, token store out.

Each stage applies one operator to all rows that the stage before it kept, and returns the columns of
documents (the last: the store's index of documents). A stage's result is written as Parquet and read
again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscape.llm import decontaminate, lang_zstd, mixing, simhash, token_store
from cellscape.llm.common import crc_bucket, free, table, with_row_key

#: SQL can't express compression by zstandard dictionaries or byte-level BPE; tests use brute force.
ORACLE_SQL = None


def without(keyed: DataFrame, key: list[str], gone: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of the rows whose key isn't in ``gone``."""
    names = free(keyed, *[f"gone_{k}" for k in key])
    gone = gone.select(*[F.col(k).alias(n) for k, n in zip(key, names)])
    return keyed.join(gone, [F.col(k) == F.col(n) for k, n in zip(key, names)], "left_anti").select(*columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by a margin; those that language ID rejects go, null and letterless texts too."""
    content = lang_zstd.train(docs.where(crc_bucket(F.col("doc_id"), 3) != 1))
    (told,) = free(docs, "language")
    return lang_zstd.classify(docs, content, into=told).where(~F.col(told)["rejected"]).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints: the least id, nulls last, then the first row.

    Rows are told apart by their place in the files, so of rows that repeat an id, or have none, just those go that
    link to the one that stays. Null and wordless texts are one group. Columns stay as they are.
    """
    keyed, key = with_row_key(docs)
    return without(keyed, key, table(simhash.near_duplicates(keyed, carry=key).where("not kept").select(*key), "copies"), docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, each row judged by its own text; null and empty texts stay."""
    keyed, key = with_row_key(docs)
    found = decontaminate.contained(keyed.select(F.struct(*key).alias("row"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_col="row")
    return without(keyed, key, table(found.select("row.*").distinct(), "leaks"), docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each pass over a document that the mix takes, in the order of training; each row is planned by itself."""
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store's documents, read back from its files."""
    import public_tokenizers

    return token_store.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("token_output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each on the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
