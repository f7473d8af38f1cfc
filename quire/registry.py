"""All queries of the engine's own operators, by name, with their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.plans import generated_queries, markup_queries, record_queries, relation_queries, source_queries, text_queries  # noqa: F401  they enter themselves
from quire.plans.catalog import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Welded delimiters of the documents: line scan, run histogram, findings."""
    return QUERIES["c01_dollar_runs"](spark, sf_dir)
