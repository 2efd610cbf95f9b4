"""The registered queries: each applies its operator to whole tables.

They read documents (and labels) under a folder and return the digest columns of their
contracts; the operators themselves have more general interfaces.
"""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import (
    bpe,
    divergence,
    exact_dedup,
    fill_middle,
    lm_scoring,
    packing,
    quality_classifier,
    quality_rules,
    secret_scan,
    simhash,
    token_counts,
    topk_search,
    toxicity,
)
from ordermill.llm.common import remainder


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 4) == 2
    docs = documents(spark, sf_dir).withColumn("held_out", held_out)
    model = toxicity.fit(docs, labels(spark, sf_dir).where(~held_out))
    scored = toxicity.score_toxicity(docs, model, drop_text=True)
    return scored.select("doc_id", "held_out", "score", "predicted", "n_windows")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 5) == 1
    docs = documents(spark, sf_dir).withColumn("held_out", held_out)
    model = lm_scoring.fit(docs.where(~held_out))
    return lm_scoring.score_texts(docs, model, drop_text=True)


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(documents(spark, sf_dir), drop_text=True)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(documents(spark, sf_dir), path, limit=1024, drop_text=True)


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(documents(spark, sf_dir), shingle=3, radius=2)
    return groups.select("doc_id", "fingerprint", "component_id")


def op6_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digest_texts(documents(spark, sf_dir), path, drop_text=True)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(documents(spark, sf_dir), labels(spark, sf_dir))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_texts(documents(spark, sf_dir), path)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 5) == 0
    docs = documents(spark, sf_dir).withColumn("held_out", held_out)
    learned = labels(spark, sf_dir).where(~held_out)
    model = quality_classifier.fit(docs, learned)
    scored = quality_classifier.score_quality(docs, model, drop_text=True)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk_search.top_k(vectors, F.col("id") % 50 == 0)


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(documents(spark, sf_dir), drop_text=True)
    return fill_middle.restore(made).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("fim_text", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_toxicity": op1_toxicity,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_secret_scans": op3_secret_scans,
    "op4_token_counts": op4_token_counts,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_bpe_encoding": op6_bpe_encoding,
    "op7_quality_rules": op7_quality_rules,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_topk_search": op12_topk_search,
    "op13_fill_middle": op13_fill_middle,
}

SQL = ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}) | {
    "op10_exact_dedup": """
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM texts
WINDOW same AS (PARTITION BY norm)
""",
    "op11_source_divergence": r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), terms AS MATERIALIZED (
  SELECT id, lang, source,
         unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs
), kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS n FROM terms GROUP BY lang, term HAVING count(DISTINCT id) >= 30
), groups AS MATERIALIZED (
  SELECT DISTINCT lang, source FROM docs
), counts AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM terms GROUP BY ALL) c
    ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS MATERIALIZED (
  SELECT lang, source, term, n,
         1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER g + 5 * count(*) OVER g) AS p,
         1 + (1000000000::HUGEINT * (lang_n + 5)) // (sum(lang_n) OVER g + 5 * count(*) OVER g) AS q
  FROM counts WINDOW g AS (PARTITION BY lang, source)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(d.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY x.lang, x.source, y.source
  ) d ON d.lang = a.lang AND d.source = a.source AND d.other = b.source
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM ranked
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM numbered WHERE part = 'pair' OR rank <= 50
""",
    "op12_topk_search": """
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS number, vec_id,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.number, q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.number <> c.number
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY number ORDER BY score DESC, vec_id) AS rank
      FROM scores)
WHERE rank <= 5
""",
    "op13_fill_middle": """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
), numbers AS (
  SELECT doc_id, text, length(text) AS n,
         CAST('0x' || substr(digest, 1, 8) AS BIGINT) AS h1,
         CAST('0x' || substr(digest, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(digest, 17, 8) AS BIGINT) AS h3,
         CAST('0x' || substr(digest, 25, 8) AS BIGINT) AS h4
  FROM hashed
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>')
                   OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), parts AS (
  SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle,
         substr(text, b + 1) AS suffix
  FROM cuts
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END)
         AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
""",
}
