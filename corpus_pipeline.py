"""Corpus pipeline: language ID, exact dedup, n-gram Jaccard join, decontamination, mixing.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame. ``run`` writes each stage's result as Parquet to the run's shared folder and
reads it again for the next. All stages but the last return the columns of documents;
the last adds what the mix takes, one row per document and epoch.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from ebbtide.functions.staging import release_scope, scope, stage
from ebbtide.llm import decontaminate, exact_dedup, language, mixing, ngram_join

# What a stage writes on its way is removed when the next one begins, as its result is written by then.
SCOPE = "pipeline"


def own_scope(function):
    """Removes what earlier stages have staged, unless ``docs`` still reads it, and stages in the pipeline's scope."""

    @functools.wraps(function)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_scope(spark, SCOPE, still_read=docs)
        with scope(spark, SCOPE):
            return function(spark, docs, sf_dir)

    return staged


@own_scope
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; learned from those not held out."""
    model = language.fit(docs.where(~language.held_out()))
    return language.accepted(docs, model)


@own_scope
def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per text, the one with the largest doc_id."""
    return exact_dedup.drop_exact_duplicates(docs)


@own_scope
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per group of near copies, the one with the smallest doc_id."""
    return ngram_join.one_of_each_group(docs)


@own_scope
def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@own_scope
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the source weights take, one row per document and epoch."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing", mix),
]

# Language ID has no SQL counterpart: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    release_scope(spark, SCOPE)
    return docs
