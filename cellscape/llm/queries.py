"""The registered queries of the training-data operators, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import class_lm, decontaminate, fim, fingerprints, hard_negatives, lang_zstd, license_scan, mixing, nn_descent, secret_scan, simhash, token_store, url_filter
from .common import crc_bucket, table, with_next


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Verdicts by host and path.
URL_RULES = (
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(load(spark, sf_dir, "pages"), URL_RULES)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(load(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.RULES if r.base]
    mine = F.filter("found", lambda x: x["kind"].isin(base))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(secret_scan.digest(mine).cast("binary"), 256).alias("base_sha256"), secret_scan.digest(F.col("found")).alias("spans"),
    )


def op4_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    held = crc_bucket(F.col("doc_id"), 7) == 2
    model = class_lm.train(docs.where(~held))
    return class_lm.score(docs, model).withColumns({"held_out": held, "train_tokens": F.lit(model.tokens).cast("long")})


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    held = crc_bucket(F.col("doc_id"), 3) == 1
    content = lang_zstd.train(docs.where(~held))
    return lang_zstd.classify(docs.select("doc_id", held.alias("held_out"), "text"), content).select(
        "doc_id", "held_out", "language.lang_pred", "language.score", "language.rejected"
    )


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(load(spark, sf_dir, "embeddings"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(load(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id", "kept")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = mixing.word_count(F.col("text"))
    sized = table(load(spark, sf_dir, "documents").select("doc_id", "source", size.alias("mix_size"), F.when(F.col("doc_id").isNull(), F.md5(F.col("text").cast("binary"))).alias("spread")), "sizes")
    planned = table(mixing.plan(sized, spread=["spread"]), "planned")  # so that ranges are found without planning twice
    return mixing.in_order(planned).select(
        "doc_id", F.col("mix_size").alias("size"), "mix.source_size", "mix.target", "mix.taken",
        F.round("mix.position", 9).alias("position"), F.round("mix.last_position", 9).alias("last_position"),
    )


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_store.encode_documents(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = load(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    keyed = fingerprints.with_fingerprint(docs, F.col("text"), "fp")
    n = F.length("text")
    spliced = F.concat(F.substr("text", F.lit(1), n - F.floor(n / 4).cast("int")), F.substr(F.col("next.text"), F.lit(1), F.floor(n / 4).cast("int")))
    edited = with_next(keyed, ["doc_id"], ["text", "fp"], "next").select("doc_id", n.cast("long").alias("n_chars"), "fp", F.col("next.fp").alias("next_fp"), spliced.alias("edited"))
    out = fingerprints.with_fingerprint(edited, F.col("edited"), "edited_fp")
    return out.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("fp")).alias("fingerprint"), fingerprints.as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), fingerprints.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(load(spark, sf_dir, "documents").select("doc_id", "text"))
    output, form = F.col("fim.output"), F.col("fim.form")
    digest = lambda x: F.sha2(x.cast("binary"), 256)
    return made.select("doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars", digest(output).alias("output_sha256"), digest(fim.restored(output, form)).alias("restored_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_url_filter, op2_decontamination, op3_secret_scan, op4_class_lm, op5_language_id,
        op6_embedding_dedup, op7_license_scan, op8_simhash, op9_mixing, op10_token_store,
        op11_fingerprints, op12_fim, op13_hard_negatives,
    )
    return {f.__name__: f for f in found}


#: Brute-force containment: every shingle of every document against every item's; short items are one shingle.
DECONTAMINATION_SQL = r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') FROM benchmark
), k AS (
  SELECT 5 AS k UNION SELECT len(w) FROM w WHERE kind = 'b' AND len(w) BETWEEN 1 AND 4
), s AS (
  SELECT DISTINCT kind, id, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT kind, id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w JOIN k ON k <= len(w) WHERE kind = 'd' OR k = least(5, len(w)))
), n AS (SELECT id, count(*) AS n FROM s WHERE kind = 'b' GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, count(*) AS shared, n.n AS item_shingles, count(*) / n.n AS containment
FROM s d JOIN s b ON d.kind = 'd' AND b.kind = 'b' AND d.s = b.s JOIN n ON n.id IS NOT DISTINCT FROM b.id
GROUP BY d.id, b.id, n.n HAVING count(*) >= 0.8 * n.n - 1e-9
"""

MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(coalesce(cast(doc_id AS VARCHAR), md5(text), '')) AS k
  FROM documents
), o AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM d
), s AS (
  SELECT source, cast(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source
), l AS (
  SELECT *, (rank - 1) % 3 + 1 AS weight, 3 * source_size AS cap, cast(3 * source_size AS DOUBLE) / ((rank - 1) % 3 + 1) AS level FROM s
), w AS (
  SELECT *, cast(sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0) AS DOUBLE) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS line
  FROM l WINDOW b AS (ORDER BY level, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), g AS (
  SELECT source, source_size, rank, least(cast(cap AS DOUBLE), (SELECT arg_min(line, level) FROM w WHERE line <= level) * weight) AS target FROM w
), p AS (
  SELECT o.*, g.source_size, g.target, g.rank, cast(round(g.target) AS BIGINT) AS quota FROM o JOIN g ON o.source IS NOT DISTINCT FROM g.source
), t AS (
  SELECT *, CASE WHEN source_size > 0 THEN quota // source_size ELSE 0 END AS passes FROM p
), x AS (
  SELECT *, passes * size + greatest(0, least(size, quota - passes * source_size - start)) AS taken,
    CASE WHEN target > 0 THEN cast(start AS DOUBLE) / target ELSE 0 END AS share,
    CASE WHEN target > 0 THEN least(1, cast(start + source_size * (passes - CASE WHEN quota - passes * source_size - start > 0 AND size > 0 THEN 0 ELSE 1 END) AS DOUBLE) / target) ELSE 0 END AS last
  FROM t
)
SELECT doc_id, cast(size AS BIGINT) AS size, source_size, target, cast(taken AS BIGINT) AS taken,
  CASE WHEN taken > 0 THEN round(CASE (rank - 1) % 3
    WHEN 0 THEN 2 * share / (1.5 + sqrt(2.25 - 2 * share))
    WHEN 1 THEN share
    ELSE 2 * share / (0.5 + sqrt(0.25 + 2 * share)) END, 9) END AS position,
  CASE WHEN taken > 0 THEN round(CASE (rank - 1) % 3
    WHEN 0 THEN 2 * last / (1.5 + sqrt(2.25 - 2 * last))
    WHEN 1 THEN last
    ELSE 2 * last / (0.5 + sqrt(0.25 + 2 * last)) END, 9) END AS last_position
FROM x
"""


#: Brute force: all pairs of a label, then the least id over links, to the fixed point.
EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: cast(x AS DOUBLE)) AS e FROM embeddings
), e AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND list_dot_product(a.e, a.e) > 0 AND list_dot_product(b.e, b.e) > 0 AND list_cosine_similarity(a.e, b.e) >= 0.98
), r AS (
  SELECT a AS id, b AS other FROM e UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.other
), n AS (SELECT a, count(*) AS n FROM e GROUP BY a), c AS (SELECT id, min(other) AS c FROM r GROUP BY id)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(c, vec_id)) AS component_id, vec_id <= coalesce(c, vec_id) AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.id = vec_id
"""


def _secrets_sql() -> str:
    """The spans of every rule by the lengths of matches and of what lies between them."""
    parts = []
    for i, r in enumerate(secret_scan.RULES):
        pattern = r.pattern.replace("((?i)", "((?i:").replace("api_?key)", "api_?key))").replace("'", "''")
        parts.append(
            f"SELECT doc_id, r, {i} AS place, '{r.kind}' AS kind, {r.least} AS least, regexp_extract_all(t, '{pattern}', 0) AS f, regexp_extract_all(t, '{pattern}', {r.group}) AS g, "
            f"regexp_split_to_array(t, '{pattern.replace('((?i:password|passwd|secret|token|api_?key))', '(?i:password|passwd|secret|token|api_?key)').replace('([A-Za-z0-9+/_.=-]+)', '[A-Za-z0-9+/_.=-]+')}') AS p FROM d"
        )
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({' UNION ALL '.join(parts)}),
x AS (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM m WHERE len(f) > 0),
s AS (SELECT r, doc_id, place, kind, list_sum(list_transform(p[1:i], lambda q: length(q))) + coalesce(list_sum(list_transform(f[1:i - 1], lambda q: length(q))), 0) AS start, length(f[i]) AS n FROM x WHERE length(g[i]) >= least),
a AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || cast(start AS BIGINT) || ':' || cast(start + n AS BIGINT), ',' ORDER BY start, place) FILTER (place < 3) AS base,
  string_agg(kind || ':' || cast(start AS BIGINT) || ':' || cast(start + n AS BIGINT), ',' ORDER BY start, place) AS spans FROM s GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (r)
"""


FIM_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(cast(doc_id AS VARCHAR), '')) AS x FROM documents
), h AS (
  SELECT *, cast(len(u) AS BIGINT) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2, ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), p AS (
  SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * cast(x AS DOUBLE))) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.id AS a, r.id AS r, a.label = r.label AS same, cast(list_dot_product(a.e, r.e) AS BIGINT) AS score FROM v a JOIN v r ON a.id % 100 = 0 AND a.id <> r.id
), p AS (
  SELECT a, r AS p, score AS ps FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, r) AS k FROM s WHERE same) WHERE k <= 5
), n AS (
  SELECT p.a, p.p, ps, s.r, s.score, row_number() OVER (PARTITION BY p.a, p.p ORDER BY s.score DESC, s.r) AS k
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * ps <= 100 * s.score AND 100 * s.score <= 100 * ps
)
SELECT a AS anchor_id, p AS positive_id, cast(k AS INTEGER) AS rank, r AS negative_id, ps AS positive_score, score AS negative_score FROM n WHERE k <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op12_fim": FIM_SQL, "op13_hard_negatives": HARD_NEGATIVES_SQL, "op3_secret_scan": _secrets_sql(), "op6_embedding_dedup": EMBEDDING_SQL, "op2_decontamination": DECONTAMINATION_SQL, "op9_mixing": MIXING_SQL}
