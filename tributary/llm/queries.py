"""Registered queries of the text operators, with their production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import (bpe, chat, fingerprints, harmonic, licences, lines, near, negatives, oracle, packing, quality,
                           repair, sharding, substring)
from tributary.llm.common import read_table


def op1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document and whether it stays."""
    return lines.line_components(read_table(spark, sf_dir, "documents")).select("doc_id", "line_no", "kept")


def op2_bpe(spark: SparkSession, sf_dir: str, ranks: str | None = None) -> DataFrame:
    """Encodes and decodes every document; ``ranks`` names the vocabulary file."""
    path = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    codec = bpe.broadcast_codec(spark, path, public_tokenizers.PATTERN)
    return bpe.round_trip_digests(read_table(spark, sf_dir, "documents"), codec)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, sf_dir, "documents"), shards=8)


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removal_digests(read_table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read_table(spark, sf_dir, "documents"))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph of every document that is a license notice."""
    docs = read_table(spark, sf_dir, "documents")
    return licences.scan(docs, licences.train_on(docs))


def op7_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three words a shingle and a similarity of 85 in 100, as the query's contract says."""
    return near.near_components(read_table(spark, sf_dir, "documents"), shingle_words=3, threshold=(85, 100))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.judge(docs, model).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                             "n_repeat_words", "base_failed", "kept", "quality")


def op9_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Packs every document; ``tokenizer`` names the tokenizer file."""
    encoder = packing.broadcast_encoder(spark, tokenizer or public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), encoder)


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.conversation_digests(read_table(spark, sf_dir, "conversations"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damages every conversation by a fixed rule and repairs it."""
    return repair.repair_digests(repair.damage(read_table(spark, sf_dir, "conversations")))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth vector is an anchor; the labels of every seventh are moved on by one first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = read_table(spark, sf_dir, "embeddings").withColumn("label", label)
    return negatives.mine(rows, anchors=F.col("vec_id") % 50 == 0)


def op13_harmonic(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Packs every document, cut freely; ``tokenizer`` names the tokenizer file."""
    encoder = packing.broadcast_encoder(spark, tokenizer or public_tokenizers.path("byte_bpe_50k.json"))
    return harmonic.pack_documents(read_table(spark, sf_dir, "documents"), encoder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lines": op1_lines, "op2_bpe": op2_bpe, "op3_sharding": op3_sharding, "op4_substring": op4_substring,
    "op5_fingerprints": op5_fingerprints, "op6_licences": op6_licences, "op7_near": op7_near, "op8_quality": op8_quality, "op9_packing": op9_packing,
    "op10_chat": op10_chat, "op11_repair": op11_repair, "op12_negatives": op12_negatives, "op13_harmonic": op13_harmonic,
}

ORACLE_SQL: dict[str, str] = {
    "op4_substring": oracle.SUBSTRING, "op7_near": oracle.NEAR, "op10_chat": oracle.CHAT, "op12_negatives": oracle.NEGATIVES,
}
