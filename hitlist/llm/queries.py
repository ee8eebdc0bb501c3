"""Registered queries of the operators: each applies one, with its production parameters,
to its whole tables. ``ORACLE`` has the DuckDB twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hitlist.llm import (
    chat,
    decontaminate,
    html,
    licenses,
    manifest,
    neardup,
    packing,
    pii,
    quality,
    search,
    simhash,
    substrings,
    token_counts,
)
from hitlist.llm.oracle import ORACLE
from hitlist.llm.shared import public_tokenizer, table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.links(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizer("word_bpe_49k.json"), limit=2048
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(table(spark, sf_dir, "documents"))


#: Of the registered queries; a deployment passes its own.
SURROGATE_KEY = "registered-query"


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(docs, SURROGATE_KEY, counts=True)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizer("byte_bpe_50k.json"), public_tokenizer("byte_bpe_50k.tiktoken")
    return packing.pack_documents(table(spark, sf_dir, "documents"), paths)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


#: A conversation whose texts have what a template must escape.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], rows.schema)
    return chat.digests(rows.union(more), public_tokenizer("byte_bpe_50k.json"))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("notices")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), host="source")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(search.index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), k=10)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.audit(table(spark, sf_dir, "documents"))


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_token_counts": op2_token_counts,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_pii_surrogates": op4_pii_surrogates,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_html_extraction": op7_html_extraction,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_license_scans": op9_license_scans,
    "op10_quality_rules": op10_quality_rules,
    "op11_ranked_search": op11_ranked_search,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_simhash_dedup": op13_simhash_dedup,
}

__all__ = ["ORACLE", "QUERIES"]
