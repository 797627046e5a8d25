"""A corpus from raw documents to a mix, in five stages.

Each stage is written as Parquet, in the session's shared folder, and read again as the
input of the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docquay.llm import decontamination, exact_dedup, jaccard_join, mixing, quality
from docquay.llm.common import read_table, stage_for
from docquay.llm.quality import labelled_documents


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier, fitted on the labelled ones among them, does not reject."""
    labels = read_table(spark, sf_dir, "labels")
    return quality.keep_good(docs, quality.fit_quality(labelled_documents(docs, labels)))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest identifier."""
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked near-duplicates, the document with the smallest identifier."""
    return jaccard_join.keep_first(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontamination.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes from each document that is left."""
    mixed = mixing.mix(docs)
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("mixing sources", source_mix),
]

#: The classifier is not expressible in SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    staging = stage_for(spark)
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = staging.table(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
