"""A training-data pipeline over documents: five stages, each on all that the last one kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. run() writes each stage's rows to the shared folder and reads them again,
so a stage's work is done once and a lost executor costs no earlier stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import exact_dedup, packing, secret_scan, simhash, toxicity
from ordermill.llm.common import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network, learned from the labelled ones, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for the case of A-Z, the one with the largest doc_id."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash fingerprints link, the one with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs, shingle=3, radius=2)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in their texts masked and n_chars counted again."""
    masked = secret_scan.mask_secrets(docs)
    changed = F.char_length("text").cast("long")
    return masked.withColumn(
        "n_chars", F.when(F.contains("text", F.lit(secret_scan.MASK)), changed).otherwise(F.col("n_chars"))
    ).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 4096 tokens."""
    return packing.pack_texts(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scans", mask_secrets),
    ("best_fit_packing", pack),
]

# A trained network, XXH64 fingerprints and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
