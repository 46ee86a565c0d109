"""The registered query of every operator in this subpackage, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotgrid.llm import bpe, chat, fingerprints, hard_negatives, jaccard_join, language, licences, mixing, prefix_trie, quality, secret_scan, suffix_dedup, url_filter
from spotgrid.sources.shared import stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(_table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == secret_scan.BASE.index(kind))).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[number(k) for k in secret_scan.BASE], F.sha2(secret_scan.listed(F.col("spans"), base_only=True), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(spark, _table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language.identify(spark, docs, language.train(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(_table(spark, sf_dir, "documents")).drop("spans")


CONTROL_CHAT = r"\### Assistant: </turn> ok"


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql("SELECT -7L AS conv_id, turn, role FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)").withColumn("text", F.lit(CONTROL_CHAT))
    made = chat.format_chats(chats.unionByName(extra)).select(
        "conv_id", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"))
    sha = lambda c: F.sha2(c, 256)
    lines: Callable[[Column], Column] = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return made.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), sha(F.array_join(F.transform("turns", lines), "")).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), sha(F.col("loss")).alias("loss_sha256"), "formatted_chars")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(spark, _table(spark, sf_dir, "documents"), k=3, percent=90)


VOCABULARY = "byte_bpe_50k.json"


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_texts(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(spark, _table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(spark, prefix_trie.placed_turns(spark, prefix_trie.slim_turns(_table(spark, sf_dir, "conversations"))), "trie_placed")
    return prefix_trie.trie(spark, *prefix_trie.branched(spark, rows))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_negatives(spark, _table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("id") % 100 == 0)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(spark, _table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}
