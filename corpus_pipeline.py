"""Corpus pipeline: language, boilerplate lines, near copies, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as
Parquet and read again as the next one's docs.  All stages but the last return the columns
of documents, and every decision takes effect: rejected documents and lines are gone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from locusweave.llm import decontaminate, jaccard_join, langid, line_dedup, packing
from locusweave.llm.runtime import held_out, prepare
from locusweave.sources.tables import owned, remove_path, scratch


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has no language (null, or without a letter) go; the model is fitted on documents not held out."""
    return langid.select_known(docs, langid.fit(docs.where(~held_out("doc_id"))))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of their source go; copies, of which the next stage keeps one, count as one page."""
    return line_dedup.remove(docs, counted=None, copies_once=True)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out of the texts."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "spans")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their places in training sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", benchmark_leaks),
    ("best_fit_packing", sequences),
]

#: Learned languages, linked components and token ids are not expressible in SQL; tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result passes through a table in the shared folder.

    A stage's own tables, and its predecessor's result, go when its result is written; those
    of the last stage, and its input, stay for the reader of what is returned.
    """
    prepare(spark)
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        with owned(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
