"""Registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stockrisk.llm import alignment, embedding_dedup, language, mixing, order_minhash, perplexity, pii, quality, sentencepieces, sharding, simhash, spelling, style_tree, word_model
from stockrisk.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_pq_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_dedup(table(spark, sf_dir, "embeddings"))


def op2_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.page_report(table(spark, sf_dir, "pages"))


def op3_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digest(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf_dir, "documents"))


def op6_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprint_report(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(table(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_report(table(spark, sf_dir, "documents"))


def op12_ngram_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.rules_report(table(spark, sf_dir, "documents"), word_model.WORD_ORDER)


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte_path, piece_path = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.alignment_report(table(spark, sf_dir, "documents"), byte_path, piece_path)


QUERIES: dict[str, Query] = {
    "op1_pq_near_dedup": op1_pq_near_dedup,
    "op2_site_style_tree": op2_site_style_tree,
    "op3_pii_bootstrap": op3_pii_bootstrap,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_quality_gam": op6_quality_gam,
    "op7_sharding": op7_sharding,
    "op8_order_minhash": op8_order_minhash,
    "op9_language_id": op9_language_id,
    "op10_mix_sources": op10_mix_sources,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_ngram_rules": op12_ngram_rules,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

ORACLE_SQL: dict[str, str] = {}
