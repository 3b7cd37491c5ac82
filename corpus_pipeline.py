"""Corpus preparation in five stages over ``documents``: classify quality, remove repeated chunks of
lines, drop near-duplicates, drop documents that hold benchmark passages, mix sources to targets.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written and read again as the
next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from firstbasket.llm import entropy_mix, line_chunks, simhash, suffix_decontam, weak_quality
from firstbasket.llm.work import Work

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return weak_quality.drop_rejected(docs, _table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go from the texts."""
    return line_chunks.drop_repeated_chunks(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return suffix_decontam.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words, in whole copies, the mix takes of each document."""
    return entropy_mix.mix(docs)


STAGES: list[tuple[str, Stage]] = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates),
                                   ("decontaminate", decontaminate), ("mix", mix)]
#: Training, suffix arrays and root finding have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, work = _table(spark, sf_dir, "documents"), Work(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = work.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
