"""A corpus from raw documents: language, near-duplicates, personal data, mixture, token ids.

Each stage takes (spark, docs, sf_dir) and gives the columns of ``documents``, the last one the
digests of the encoded texts. ``run`` writes the result of each stage as Parquet into the shared
folder and hands the reread table to the next, so that a lost executor costs no finished stage.

Defined cases: NULL and empty texts have no language and leave in the first stage. Each row is
judged by its own text, also where rows share a doc_id; rows equal in all columns leave one in the
second stage. A NULL doc_id takes no part in that stage and stays. Empty tables stay empty. Columns
beyond those of ``documents`` are dropped by the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm import language, mixing, near_dups, pii, sentencepiece_codec
from fieldspark.llm.common import documents, table
from fieldspark.llm.queries import PII_KEY, codec_digests
from fieldspark.session import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# A document stays if its words are recognised at least this far: the mean over its words of each
# word's own highest probability, so that texts in several languages stay. If no language can be
# learned, every text with letters stays.
MIN_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a recognisable language."""
    docs = docs.select(*COLUMNS)
    field = language.fit_languages(docs)
    judged = language.with_languages(docs, field)
    return judged.where(F.col("certainty").isNull() | (F.col("certainty") >= MIN_LANGUAGE_SCORE)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group: the one with the smallest doc_id."""
    # A doc_id may be shared by different rows: a hash of the row tells them apart. Only equal rows
    # share it, and those are one document.
    keyed = docs.select(*COLUMNS, F.xxhash64(*COLUMNS).alias("row_key"))
    known = keyed.where("doc_id is not null")
    verdicts = near_dups.near_duplicates(known.select(F.col("row_key").alias("doc_id"), "text"), near_dups.Banding())
    groups = verdicts.select(F.col("doc_id").alias("row_key"), "component_id").distinct()
    first = known.select("row_key", "doc_id").distinct().join(groups, "row_key").groupBy("component_id").agg(
        F.min(F.struct("doc_id", "row_key")).alias("first")
    )
    chosen = known.join(first.select("first.row_key"), "row_key", "left_semi").dropDuplicates(["row_key", *COLUMNS])
    return chosen.select(*COLUMNS).union(docs.where("doc_id is null").select(*COLUMNS))


def pseudonymise_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data; n_chars follows a text that changed its length."""
    replaced = pii.pseudonymise(docs.select(*COLUMNS), PII_KEY)
    length = F.when(F.col("n_replaced") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return replaced.select("doc_id", "text", "lang", "source", length.alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as the mixture wants it."""
    return mixing.mixed(docs, mixing.label_weights(table(spark, sf_dir, "labels"))).select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document taken, as digests."""
    return codec_digests(sentencepiece_codec.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model")))


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("PII", pseudonymise_pii),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]

# The language model, the encoder and the pseudonyms are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
