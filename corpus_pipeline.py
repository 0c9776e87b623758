"""A training corpus from raw documents: stages of (spark, docs, sf_dir) -> DataFrame.

Every stage works on all documents that its predecessor kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statcube.llm.exact_dedup import drop_copies
from statcube.llm.jaccard_join import drop_near_duplicates
from statcube.llm.language_id import UNKNOWN, has_letters, identify, learn_languages, training_rows
from statcube.llm.packing import pack_documents
from statcube.llm.quality_classifier import learn_quality, quality_score, training_labels
from statcube.llm.shared import ship_package, table
from statcube.sources.scratch import materialize


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, and those whose language is ambiguous, go. If no language could be learned, none is ambiguous."""
    ship_package(spark)
    model = learn_languages(training_rows(docs))
    if not model.languages:
        return docs.filter(has_letters(F.col("text")))
    found = identify(F.col("text"), model)
    return docs.filter((found["lang_pred"] != UNKNOWN) & ~found["ambiguous"])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for label 0 go."""
    ship_package(spark)
    model = learn_quality(docs, training_labels(table(spark, sf_dir, "labels")))
    return docs.filter(quality_score(F.col("text"), model) >= 0.5)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts only one row stays: the largest id, rows without an id last, then the first row."""
    return drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates only one row stays: the least id, rows without an id last, then the first row."""
    ship_package(spark)
    return drop_near_duplicates(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are left, packed into sequences."""
    ship_package(spark)
    return pack_documents(docs, forget=True)


STAGES = [
    ("language_id", language_stage),
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("packing", packing_stage),
]

#: Models and token numbers can't be expressed in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
