"""The operators' registered queries, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridframe.llm import chat_format, decontaminate, exact_dedup, fingerprints, language_id, merkle, near_dedup, packing, ranked_search, secret_scan, token_counts, token_files, url_filter
from gridframe.llm.common import table
from gridframe.shared import new_path


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), with_ids=False)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), new_path(spark, "token-files"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.formatted(table(spark, sf_dir, "conversations"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_packing, op2_fingerprints, op3_token_counts, op4_decontamination, op5_token_files, op6_near_dedup, op7_chat_format, op8_language_id, op9_secret_scan, op10_url_filter, op11_ranked_search, op12_exact_dedup, op13_merkle_manifest)
}


def fingerprint_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.near_pairs(table(spark, sf_dir, "documents"))


#: Second halves of operators, whose results aren't the operator's query.
MORE: dict[str, Callable[[SparkSession, str], DataFrame]] = {"fingerprint_pairs": fingerprint_pairs}

ORACLE_SQL: dict[str, str] = {"op4_decontamination": decontaminate.ORACLE, "op7_chat_format": chat_format.ORACLE, "op10_url_filter": url_filter.ORACLE, "op11_ranked_search": ranked_search.ORACLE, "op12_exact_dedup": exact_dedup.ORACLE, "op13_merkle_manifest": merkle.ORACLE}
