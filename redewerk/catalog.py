"""All queries of the core, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .plans import file_queries, pipeline_queries  # noqa: F401  (they register their queries)
from .plans.queries import REGISTRY


def queries() -> dict:
    return {k: run for k, (run, _, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, _, sql) in REGISTRY.items() if sql is not None}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged transcripts rendered into one line a turn."""
    return REGISTRY["turn_render"][0](spark, sf_dir)
