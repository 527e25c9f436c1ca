"""Queries of the corpus operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.staging import Scratch, new_path
from shelfwise.llm import (
    byte_bpe,
    divergence,
    exact_dedup,
    language,
    line_templates,
    minhash,
    mixing,
    near_vectors,
    periodic_runs,
    secrets,
    sharding,
    syncmers,
    url_filter,
)
from shelfwise.llm.sql import oracle_sql as oracle_sql
from shelfwise.llm.tables import read

RANKS = "byte_bpe_50k.tiktoken"


def mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(read(spark, folder, "documents"))
    return mixing.taken_words(mixed).select("doc_id", "size", "source_size", "target", "taken", "source")


def exact_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, folder, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def shard_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Texts are shuffled and written to shards; sizes and sums are those of the texts found there."""
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint").alias("size")
    with Scratch(spark) as scratch:
        path = new_path(spark, "shards")
        scratch.kept.add(path)
        shuffled = sharding.external_shuffle(read(spark, folder, "documents").select("doc_id", "text", size)).drop("size")
        sharding.write_shards(shuffled, path)
    return sharding.read_shards(spark, path, shuffled.schema).select(
        "doc_id", size,
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def near_vectors_query(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_vectors(read(spark, folder, "embeddings"))


def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan_secrets(read(spark, folder, "documents"))


def language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(read(spark, folder, "documents"))


def byte_bpe_query(spark: SparkSession, folder: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path(RANKS))
    return byte_bpe.token_digests(read(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


def minhash_query(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, folder, "documents"), shingle_words=4).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def url_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge_urls(read(spark, folder, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return line_templates.drop_recurring_lines(docs).select(
        "doc_id",
        F.size("dropped_lines").cast("bigint").alias("n_dropped"),
        F.array_join(F.col("dropped_lines").cast("array<string>"), ",").alias("dropped_lines"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def source_audit(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit_sources(read(spark, folder, "documents"))


def fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return syncmers.edited_fingerprints(read(spark, folder, "documents"))


def periodic(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.run_digests(read(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_sources": mix_sources,
        "op2_exact_dedup": exact_dedup_query,
        "op3_shard": shard_documents,
        "op4_near_vectors": near_vectors_query,
        "op5_secrets": secret_scan,
        "op6_language": language_id,
        "op7_byte_bpe": byte_bpe_query,
        "op8_minhash": minhash_query,
        "op9_url_filter": url_rules,
        "op10_line_templates": line_dedup,
        "op11_source_audit": source_audit,
        "op12_fingerprints": fingerprints,
        "op13_periodic_runs": periodic,
    }
