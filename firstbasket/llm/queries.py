"""The registered queries of this package: each applies one operator, with production parameters, to
its whole table and returns the whole result.

None has an SQL counterpart: fingerprints rest on XXH64 with a seed, suffix arrays, trained models, a
tokenizer, random projections, or on iterations to a root, which the check engine's SQL has no functions for or would
need the same code in. ``tests/llm`` holds each against a brute-force version instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    collision_dedup,
    entropy_mix,
    imatch,
    line_chunks,
    ns_kmeans,
    qdwh_whitening,
    rank_order_lang,
    secret_scan,
    simhash,
    suffix_decontam,
    token_histogram,
    transcripts,
    weak_quality,
)

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ranks_path() -> str:
    """The file of a public byte-level vocabulary, where the tokenizers are installed."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_read(spark, sf_dir, "documents"), figures=True)


def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compare_edited(_read(spark, sf_dir, "documents"))


def op4_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.removed_chunks(_read(spark, sf_dir, "documents"))


def op5_token_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_histogram.length_histogram(token_histogram.token_counts(_read(spark, sf_dir, "documents"), ranks_path()))


def op6_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.canonical(_read(spark, sf_dir, "conversations"))


def op7_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entropy_mix.mix(_read(spark, sf_dir, "documents"))


def op8_suffix_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_decontam.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op9_rank_order_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_order_lang.identify(_read(spark, sf_dir, "documents"))


def op10_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op11_ns_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ns_kmeans.kmeans(_read(spark, sf_dir, "embeddings"))


def op12_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qdwh_whitening.whiten(_read(spark, sf_dir, "embeddings"))


def op13_collision_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_simhash, op2_secret_scan, op3_imatch, op4_line_chunks, op5_token_histogram, op6_transcripts, op7_entropy_mix, op8_suffix_decontam,
    op9_rank_order_lang, op10_weak_quality, op11_ns_kmeans, op12_qdwh_whitening, op13_collision_dedup)}
ORACLES: dict[str, str] = {}
