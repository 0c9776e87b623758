"""All queries of this subpackage, and their SQL twins where SQL can express them."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from statcube.llm import (
    bpe,
    chat_format,
    exact_dedup,
    hard_negatives,
    jaccard_join,
    language_id,
    packing,
    periodic_runs,
    personal_data,
    quality_classifier,
    quality_rules,
    token_counts,
    url_filters,
)
from statcube.llm.shared import Query, ship_package

_MODULES = (quality_rules, packing, token_counts, language_id, quality_classifier, exact_dedup, bpe, jaccard_join, chat_format, url_filters, personal_data, periodic_runs, hard_negatives)


def shipped(fn: Query) -> Query:
    """The query, after the package has been sent to the executors."""

    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, folder)

    return run


QUERIES = {name: shipped(fn) for m in _MODULES for name, (fn, _) in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, (_, sql) in m.QUERIES.items() if sql is not None}
