"""Reads of the input tables (one parquet dataset per table name)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Plain parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(base, name))
