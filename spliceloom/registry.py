"""All queries of the engine and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .plans import driver

QUERIES = driver.QUERIES
ORACLE_SQL = driver.ORACLE_SQL


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-read events with UMI families."""
    return driver.per_read_families(spark, sf_dir)
