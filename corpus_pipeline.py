"""A training corpus from raw documents: each stage's result is written, read again and handed to the next.

Stages take (spark, documents, folder of the tables) and give documents; the last one gives token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotgrid.llm import bpe, jaccard_join, mixing, quality, secret_scan
from spotgrid.sources.shared import stage

VOCABULARY = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a Jaccard of 0.8 or more on five-word shingles, the one of the smallest id stays."""
    return jaccard_join.keep_one(spark, docs, k=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; n_chars follows. No document goes."""
    return secret_scan.redact_secrets(spark, docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources give words by their weights: documents stay, go, or stay twice."""
    return mixing.mixed_documents(spark, docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers), and whether they decode to the text."""
    encoded = bpe.encode_texts(docs, public_tokenizers.path(VOCABULARY))
    return encoded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mix", mix), ("tokens", tokens),
]
#: Compression, the metric join and BPE have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(spark, function(spark, docs, sf_dir), name)
    return docs
