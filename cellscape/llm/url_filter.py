"""URL filters: rules first, gradient-boosted trees on lexical features where no rule decides.

The trees learn from labelled URLs; the query takes for these the URLs that a rule decides. Features
are SQL expressions and the trees are Spark ML's, so all work stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, hashed_sample, table

FEATURES = (
    "length", "host_length", "path_length", "query_length", "depth", "labels", "digit_ratio", "entropy", "parameters", "hyphens", "fragment", "suffix_rate", "suffix_count",
)


@dataclass(frozen=True)
class Rule:
    """Verdict for a host and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Params:
    """``sample`` distinct labelled URLs at most (those of least hash) train the trees and suffix statistics."""

    sample: int = 20_000
    trees: int = 12
    depth: int = 4
    seed: int = 7
    prior: float = 8.0


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or none."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    return F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (name, verdict) of the longest rule that fits, or null. Equal lengths: the first by code point."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name))[::-1]:
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Bits a character; 0 for an empty text."""
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / F.greatest(n, F.lit(1))
    chars = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")
    return F.aggregate(chars, F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))


def with_features(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """``urls`` plus struct ``lexical``; a null URL counts as empty."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    count = lambda text, chars: F.length(text) - F.length(F.translate(text, chars, ""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return urls.withColumn(
        "lexical",
        F.struct(
            *[
                x.cast("double").alias(k)
                for k, x in {
                    "length": F.length(url),
                    "host_length": F.length(host),
                    "path_length": F.length(path),
                    "query_length": F.length(query),
                    "depth": count(path, "/"),
                    "labels": count(host, ".") + 1,
                    "digit_ratio": count(url, "0123456789") / F.greatest(F.length(url), F.lit(1)),
                    "entropy": entropy(url),
                    "parameters": F.when(query != "", count(query, "&") + 1).otherwise(0),
                    "hyphens": count(host, "-"),
                    "fragment": F.contains(url, F.lit("#")).cast("int"),
                }.items()
            ],
            F.element_at(F.split(host, r"\."), -1).alias("suffix"),
        ),
    )


def ruled_labels(rows: DataFrame) -> DataFrame:
    """(url, label) of the rows that a rule decides."""
    return rows.where("ruled is not null").select("url", (F.col("ruled.verdict") == "block").cast("int").alias("label"))


@dataclass(frozen=True)
class Model:
    """``trees`` is None where the labels were of one kind or none; then ``prior`` decides."""

    suffixes: DataFrame | None
    trees: GBTClassificationModel | None
    prior: float


def _vectors(rows: DataFrame, suffixes: DataFrame, prior: float, params: Params, own: Column | None = None) -> DataFrame:
    """``rows`` with the feature vector; ``suffixes`` has at most ``Params.sample`` rows, so it is broadcast.

    Rows that the suffixes were counted on give their label as ``own``, and are left out of their own suffix's statistics.
    """
    known = rows.join(F.broadcast(suffixes), F.col("lexical.suffix") == F.col("suffix_key"), "left")
    one = F.lit(0.0) if own is None else F.lit(1.0)
    n, ones = F.coalesce("suffix_n", F.lit(0.0)) - one, F.coalesce("suffix_ones", F.lit(0.0)) - (F.lit(0.0) if own is None else own)
    known = known.withColumns({"suffix_rate": (ones + params.prior * prior) / (n + params.prior), "suffix_count": F.log1p(n)})
    known = known.withColumns({f"gbt_{k}": F.col(k if k.startswith("suffix") else f"lexical.{k}") for k in FEATURES})
    return VectorAssembler(inputCols=[f"gbt_{k}" for k in FEATURES], outputCol="gbt_features").transform(known).drop(*[f"gbt_{k}" for k in FEATURES])


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "label", params: Params = Params()) -> Model:
    """Fit suffix statistics and trees on URLs with label 0 or 1; null labels are ignored."""
    urls = labelled.where(F.col(label_col).isNotNull()).groupBy(F.coalesce(F.col(url_col), F.lit("")).alias("url")).agg(F.max(label_col).cast("double").alias("label"))
    sample = table(with_features(hashed_sample(table(urls, "labelled"), ["url"], params.sample)), "urls")
    n, ones = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    prior = ones / n if n else 0.0
    if prior in (0.0, 1.0):
        return Model(None, None, prior)
    suffixes = table(sample.groupBy(F.col("lexical.suffix").alias("suffix_key")).agg(F.sum("label").alias("suffix_ones"), F.count("*").cast("double").alias("suffix_n")), "suffixes")
    gbt = GBTClassifier(featuresCol="gbt_features", labelCol="label", maxIter=params.trees, maxDepth=params.depth, seed=params.seed)
    return Model(suffixes, gbt.fit(_vectors(sample, suffixes, prior, params, F.col("label")).select("gbt_features", "label")), prior)


def judge(urls: DataFrame, model: Model, url_col: str = "url", into: str = "block_score", params: Params = Params()) -> DataFrame:
    """``urls`` plus ``into``: the trees' probability that the URL is to be blocked."""
    if model.trees is None:
        return urls.withColumn(into, F.lit(model.prior))
    rows = model.trees.transform(_vectors(with_features(urls, url_col), model.suffixes, model.prior, params))
    return rows.select(*urls.columns, F.round(vector_to_array("probability")[1], 6).alias(into))


def held_out_accuracy(labelled: DataFrame, url_col: str = "url", label_col: str = "label", params: Params = Params(), folds: int = 5) -> tuple[float, float, int]:
    """(accuracy, share of the commoner label, URLs) on the hash fold that a model of the other folds has not seen."""
    urls = table(labelled.where(F.col(label_col).isNotNull()).select(F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.col(label_col).alias("label")), "folds")
    out = F.pmod(F.xxhash64("url"), F.lit(folds)) == 0
    judged = judge(urls.where(out), train(urls.where(~out), params=params), params=params)
    right, ones, n = judged.agg(F.avg(((F.col("block_score") > 0.5) == (F.col("label") == 1)).cast("double")), F.avg(F.col("label").cast("double")), F.count("*")).first()
    return (right or 0.0, max(ones or 0.0, 1 - (ones or 0.0)), n)


def filter_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", params: Params = Params()) -> DataFrame:
    """(id, host, path, rule, verdict, block_score) of every row, nulls and repeats included; other columns aren't read.

    A null URL counts as empty, a very long one is measured whole; equal URLs get equal verdicts. Where no rule labels
    any URL, or all labels are alike, the share of blocked ones is every URL's score.
    """
    rows = pages.select(F.col(id_col), F.col(url_col).alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rows = rows.withColumn("ruled", matching_rule(F.col("host"), F.col("path"), rules))
    model = train(ruled_labels(rows), params=params)
    judged = judge(rows, model, params=params)
    own = F.when(F.col("block_score") > 0.5, "block").otherwise("allow")
    return judged.select(id_col, "host", "path", F.col("ruled.name").alias("rule"), F.coalesce("ruled.verdict", own).alias("verdict"), "block_score")
