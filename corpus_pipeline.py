"""The corpus pipeline: five operators over the documents, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobtide.llm import grades, line_rules, packing, simhash, suffixes
from jobtide.llm.frames import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, expects to be good; all columns stay."""
    ratings = grades.graded(table(spark, sf_dir, "labels"))
    return grades.keep_good(docs, grades.train(docs, ratings))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep, without the lines that fail."""
    return line_rules.keep_clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of linked fingerprints."""
    return simhash.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the bytes that repeat a smaller document."""
    return suffixes.without_repeats(docs)


def packed_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids in windows of at most 1024."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("packing", packed_windows),
]

#: None of these stages can be written in SQL; tests hold the pipeline against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written and read again.

    Nulls, repeated rows and empty tables are treated as each operator's docstring says.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-').lower()}")
    return docs
