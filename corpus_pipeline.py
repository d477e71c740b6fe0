"""The corpus pipeline: five stages, each applying one operator to all that the one before kept.

language       texts without letters, or in none of the learned languages, go
near_dedup     one document of each group of copies and near copies stays
decontaminate  documents that contain a benchmark item go
secrets        secrets are masked; every document stays
pack           documents become pieces of training sequences

Each stage's result is written as Parquet and read as the next one's documents, so
an executor that is lost costs no more than its tasks of the current stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridframe.llm import decontaminate, language_id, near_dedup, packing, secret_scan
from gridframe.llm.common import table
from gridframe.llm.queries import tokenizer_file
from gridframe.shared import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.speaking(docs, language_id.train(docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.first_of_each(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Workers serve all stages: what this one leaves in them would count for the next run's first.
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"), cache_bytes=24 << 20, keep_cache=False, encoded=1 << 20)


STAGES: list[tuple[str, Stage]] = [("language", language), ("near_dedup", near), ("decontaminate", leaks), ("secrets", secrets), ("pack", pack)]

#: SQL can express neither the learned language model nor the packing program.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents: the pieces of the packed sequences."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
