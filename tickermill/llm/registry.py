"""The registered queries of the operators, applied to whole tables, and their equivalent SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickermill.llm import (
    bpe,
    decontamination,
    divergence,
    embeddings,
    equivalent_sql,
    language,
    minhash,
    packing,
    pii,
    quality,
    secrets,
    substrings,
    toxicity,
    trie,
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), TOKENIZER)


def op3_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


def op4_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(table(spark, sf_dir, "documents"))


def op5_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"))


def op6_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(table(spark, sf_dir, "documents"))


def op7_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_int8_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_hyperminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_TOKENIZER)


def op12_run_length_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_subword_quality": op1_subword_quality,
    "op2_prefix_bpe": op2_prefix_bpe,
    "op3_weak_supervision_pii": op3_weak_supervision_pii,
    "op4_linked_secrets": op4_linked_secrets,
    "op5_window_dedup": op5_window_dedup,
    "op6_centroid_language": op6_centroid_language,
    "op7_string_tiling": op7_string_tiling,
    "op8_boosted_toxicity": op8_boosted_toxicity,
    "op9_int8_tiles": op9_int8_tiles,
    "op10_hyperminhash_dedup": op10_hyperminhash_dedup,
    "op11_bin_slack_packing": op11_bin_slack_packing,
    "op12_run_length_divergence": op12_run_length_divergence,
    "op13_prefix_trie": op13_prefix_trie,
}

# The others have no SQL form (learned models, tokenizer merges, tilings, spans with learned additions);
# the tests check them by brute force, round trips and held-out accuracy.
ORACLE: dict[str, str] = {
    "op5_window_dedup": equivalent_sql.WINDOW_DEDUP,
    "op9_int8_tiles": equivalent_sql.EMBEDDING_DEDUP,
    "op10_hyperminhash_dedup": equivalent_sql.NEAR_DEDUP,
    "op12_run_length_divergence": equivalent_sql.DIVERGENCE,
    "op13_prefix_trie": equivalent_sql.PREFIX_TRIE,
}
