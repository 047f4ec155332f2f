"""The corpus pipeline: five operators in a row, each stage written as Parquet and read again.

Every stage but the last returns the columns of ``documents``; the last returns
them too, a row for each time a document is served, in the order of the mix.
Null texts are rejected by the first stage; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seamline.llm import decontaminate, jaccard, language, mixing, pii
from seamline.llm.common import Stash, table

#: Words of a shingle and per cent of similarity of near copies.
SHINGLE, SIMILAR = 5, 80


def of_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows."""
    return language.of_known_language(docs)


def one_of_a_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    return jaccard.keep_one(docs, Stash(spark), SHINGLE, SIMILAR)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), Stash(spark))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced."""
    return pii.sanitise(docs, Stash(spark))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources at their target weights."""
    return mixing.mixture(docs, Stash(spark))


STAGES = [
    ("language_id", of_known_language),
    ("ngram_jaccard_join", one_of_a_group),
    ("benchmark_decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("source_mixing", mixed),
]

#: No SQL: the first stage is a trained model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stash = Stash(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stash.put(f"{number}-{name}", stage(spark, docs, sf_dir))
        if number:
            stash.drop(f"{number - 1}-{STAGES[number - 1][0]}")
    return docs
