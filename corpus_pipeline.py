"""Corpus pipeline: stages over the documents table, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from girolens.llm import bpe, decontaminate, near_dedup, quality, suffix_dedup
from girolens.llm.common import shared_folder, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier (5): documents that it rejects go."""
    return quality.keep(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup (9) on five words at 80 percent: one document of each group stays."""
    return near_dedup.keep(docs, n=5, percent=80)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup (7): strings of 50 bytes that an earlier document has are cut out; every document stays."""
    return suffix_dedup.removals(docs, texts=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (6): documents that hold a benchmark passage go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE (2): doc_id, number of ids, digests of ids and decoded text of every document that is left."""
    return bpe.encode(docs)


#: (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_filter),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", encoding),
]

#: SQL can't express trained trees, signature joins and merges; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. What a stage returns is kept in the shared folder that spark.checkpoint.dir names."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
