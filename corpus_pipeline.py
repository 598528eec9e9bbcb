"""A pipeline from raw documents to packed training sequences, in five stages.

Each stage takes all documents its predecessor kept and returns a table that is written as Parquet and read again
for the next one. All but the last return the columns of ``documents``:

1. toxicity: documents whose score reaches the threshold of their language go;
2. quality rules: documents that fail a rule of the current policy go;
3. near duplicates: one document of each group stays;
4. secrets: secrets inside texts are masked, no document goes;
5. packing: token pieces placed in sequences of 2048 tokens.

Nulls, empty texts, repeated rows and empty tables are treated as the stages' modules say. Extra columns pass
through the first four stages untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trisect.llm import packing, rule_ledger, secret_forest, toxicity_cnn, weighted_minhash
from trisect.llm.queries import word_tokenizer
from trisect.llm.tables import importable, read, stored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return toxicity_cnn.keep_clean(docs, toxicity_cnn.fit(docs, read(spark, sf_dir, "labels")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rule_ledger.keep_passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return weighted_minhash.keep_one_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_forest.redact(docs, secret_forest.fit(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return packing.pack(docs, word_tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", packed),
]

# Training, lattice sampling and tokenising are not SQL; the stages are tested against plain versions instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
