"""A corpus from raw documents to packed sequences, in stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of
``documents``: quality rules drop documents, near duplicates keep one of each group,
decontamination cuts benchmark passages (and drops documents that are mostly such), personal
data is replaced, and what is left is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hitlist.llm import decontaminate, neardup, packing, pii, quality
from hitlist.llm.shared import public_tokenizer, stage, table

#: Key of the surrogates; a deployment sets its own.
SURROGATE_KEY = "corpus-pipeline"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, host="source")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.replace(docs, SURROGATE_KEY)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    paths = public_tokenizer("byte_bpe_50k.json"), public_tokenizer("byte_bpe_50k.tiktoken")
    return packing.pack_documents(docs, paths)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_surrogates", personal_data),
    ("best_fit_packing", packed_sequences),
]

#: SQL has neither the tokenizer nor the packing; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``; stages are stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
