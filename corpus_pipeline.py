"""Corpus pipeline over ``documents``: five stages, each written as Parquet and read by the next.

1. quality rules: rejected documents go, frequent lines go from the others
2. near-duplicates: one document of each class stays
3. repeated passages: bytes covered by a 400-byte string that starts anywhere else go
4. secrets: every span found is masked
5. packing: pieces of at most 2048 tokens, packed into sequences

All but the last return the columns of documents. SQL cannot express the stages
(similarity classes, suffix order, tokenizers), so there is no ORACLE_SQL; tests hold
them against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskweave.llm import minhash, packing, quality, secrets, suffix
from riskweave.llm.common import scratch_path, ship_package
from riskweave.sources.tables import table_path

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality.apply_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return minhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return suffix.apply_dedup(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mask_secrets", mask_secrets),
    ("pack_sequences", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written in the shared folder and read again."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
