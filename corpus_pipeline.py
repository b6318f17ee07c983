"""Corpus cleaning: operators of ``vaportrail.llm`` one after another over the documents.

Quality rules, near-duplicates (one document of each group stays), benchmark
decontamination, personal data, packing. A stage takes the documents that the one
before kept, as rows of a written table, and all but the last return the columns
of ``documents``. Near-duplicates take shingles of five words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaportrail.llm.decontamination import decontaminate
from vaportrail.llm.near_duplicates import distinct_documents
from vaportrail.llm.packing import packed
from vaportrail.llm.personal_data import redacted
from vaportrail.llm.quality import good_documents
from vaportrail.llm.shared import importable, intermediates, table
from vaportrail.session import fresh_path, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and resemble the trusted ones."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near-duplicates."""
    importable(spark)
    return distinct_documents(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is verbatim benchmark."""
    importable(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return redacted(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each training sequence: its size, and the pieces in it in order."""
    importable(spark)
    piece = F.struct("offset", "doc_id", "piece", "start", "length")
    return (
        packed(docs)
        .groupBy("bin_id", "capacity")
        .agg(F.array_sort(F.collect_list(piece)).alias("pieces"), F.sum("length").alias("n_tokens"))
        .withColumn("doc_ids", F.col("pieces.doc_id"))
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]
# A learned threshold, a tree ensemble and best fit are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each from the written rows of the one before.

    Tables that a stage needs on its way are removed when its rows have been written.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with intermediates(spark):
            docs = stored(stage(spark, docs, sf_dir), fresh_path(spark, f"llm-{name}"))
    return docs
