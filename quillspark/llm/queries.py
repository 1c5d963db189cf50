"""The queries that apply each operator, with production parameters, to its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, cover_dedup, decontaminate, licenses, lm, oracles, pack, prefix_tokens, quality, search, shard, sketch_dedup, suffix_dedup, trie


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tokens.token_counts(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), limit=512)


def op2_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.stratified_shards(table(spark, sf_dir, "documents"), shards=24)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), width=400).drop("spans")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"), window=4096, end_id=2)


def op7_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_dedup.remove_passages(table(spark, sf_dir, "documents"), width=35).drop("spans")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op9_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_dedup.near_duplicates(table(spark, sf_dir, "documents"), n_words=4, similarity=80)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_token_counts, op2_stratified_shards, op3_suffix_dedup, op4_quality_rules, op5_chat_format, op6_pack, op7_cover_dedup, op8_license_scan, op9_sketch_dedup, op10_decontaminate, op11_lm_scores, op12_ranked_search, op13_conversation_trie)}

ORACLE_SQL: dict[str, str] = dict(oracles.ORACLES)
