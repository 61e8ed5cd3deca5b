"""Corpus pipeline: quality, line duplicates, near duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet in the shared
folder and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontaminate import remove_contaminated
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.near_dedup import keep_one_of_each
from tidemark.llm.packing import pack
from tidemark.llm.quality import resample
from tidemark.llm.queries import PACK_VOCABULARY
from tidemark.llm.text import read_table
from tidemark.llm.vocabulary import vocabulary_path
from tidemark.session import bound_batches, checkpoint_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling takes."""
    bound_batches(spark)
    return resample(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier document has."""
    return dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    bound_batches(spark)
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with the benchmark."""
    return remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining documents as pieces of token sequences."""
    bound_batches(spark)
    return pack(docs, vocabulary_path(PACK_VOCABULARY))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# The models and token ids can't be expressed in SQL; tests/llm/test_pipeline.py compares
# the stages with brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    run_id = spark.sparkContext._jvm.java.util.UUID.randomUUID().toString()
    for i, (name, stage) in enumerate(STAGES[:-1]):
        path = checkpoint_path(spark, "pipeline", run_id, f"{i}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
