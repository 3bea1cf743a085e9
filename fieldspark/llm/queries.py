"""The registered queries of this subpackage: operator N over its whole table as opN_<name>."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm import (
    hnsw, language, mixing, near_dups, pii, prefix_trie, quality, repair, sentencepiece_codec, token_counts, token_files,
    topk, toxicity,
)
from fieldspark.llm.common import documents, table
from fieldspark.session import work_path

# The secret of a real run belongs in the job's configuration.
PII_KEY = "a key of the test run"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.severity(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op2_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec_digests(sentencepiece_codec.encode_decode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model")))


def codec_digests(encoded: DataFrame) -> DataFrame:
    """Size and SHA-256 of the ids, written as decimals with a space between, and of the decoded text."""
    decimals = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimals.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_counts.token_counts(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), mixing.label_weights(table(spark, sf_dir, "labels")))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(documents(spark, sf_dir), near_dups.Banding(words=2))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.judge(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    field = language.fit_languages(docs.where(~held_out))
    return language.predict_languages(docs, field).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 1, path)
    return token_files.id_digests(token_files.read_token_files(spark, path))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(documents(spark, sf_dir), PII_KEY)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.repair_report(conversations, repair.damaged(conversations))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    turns = prefix_trie.with_shared_heads(prefix_trie.turns_of(conversations))
    conv_ids = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    return prefix_trie.prefix_trie(turns, conv_ids)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, query in globals().items() if name.startswith("op")}
