"""Scan helpers for the shared parquet tables.

Scans are lazy: Catalyst prunes columns and pushes filters into the parquet
reader, so callers select only what they use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SHARED_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in SHARED_TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))
