"""Queries of the operators over the benchmark tables, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import align, chat, cover_tree, exact_dedup, langid, license_scan, merkle, mixing, packing, pii, quality, simhash, token_count
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op5_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.linked_vectors(table(spark, sf_dir, "embeddings"))


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, with_ids=False).drop("ids")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.tampered())


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align.align_tokens(table(spark, sf_dir, "documents"), *paths)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_mix, op2_exact_dedup, op3_pii, op4_chat_format, op5_cover_tree, op6_pack, op7_license_scan, op8_quality, op9_langid, op10_simhash, op11_token_count, op12_merkle, op13_align, pipeline)}
ORACLE: dict[str, str] = {
    "op1_mix": mixing.ORACLE_SQL.strip(),
    "op2_exact_dedup": exact_dedup.ORACLE_SQL.strip(),
    "op4_chat_format": chat.ORACLE_SQL.strip(),
}
