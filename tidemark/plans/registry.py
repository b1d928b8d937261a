"""Names of the queries on the panel operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import agreement_queries, article_queries, job_queries, panel_queries, quality_queries, text_queries  # noqa: F401  they register
from tidemark.plans.names import ORACLES, QUERIES, Query


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of the last session's panel, from rolling features to levels."""
    return QUERIES["ratings_table"](spark, sf_dir)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
