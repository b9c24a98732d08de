"""

Row changes never overwrite their input: each step writes a new version of
``trades`` to its own path and the next step reads that version, so a failed
or lost step is simply re-run from the previous version. Derived tables are
written once (CREATE TABLE IF NOT EXISTS semantics, A3).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import exposure as C
from ..operators import resolution as B
from ..operators.load import materialize
from ..sources import bindings as bd
from ..sources.tables import read_table


def _version(spark: SparkSession, df: DataFrame, out_dir: str, name: str) -> DataFrame:
    path = os.path.join(out_dir, name)
    materialize(df, path, if_absent=True)
    return spark.read.parquet(path)


def load_and_verify(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """3.1: row counts of the loaded tables and the status breakdown."""
    trades = bd.trades(spark, d)
    return {"row_counts": C.row_counts({"counterparty": bd.counterparty(spark, d),
                                        "date": bd.date_dim(spark, d), "trades": trades}),
            "breakdown": B.resolution_breakdown(trades)}


def reset_resolve_refresh(spark: SparkSession, d: str, out_dir: str, ids: DataFrame,
                          rules: DataFrame) -> dict[str, DataFrame]:
    """3.2: reset listed trades, show the queue, resolve by id, refresh the totals and
    the monthly trend. Every trades version lands in ``out_dir``."""
    v0 = _version(spark, bd.trades(spark, d), out_dir, "trades_v0")
    v1 = _version(spark, B.reset_resolution(v0, ids), out_dir, "trades_v1_reset")
    queue = B.exceptions_queue(v1)
    v2 = _version(spark, B.resolve_by_id(v1, rules), out_dir, "trades_v2_resolved")
    return {"queue": queue, "before": B.resolution_breakdown(v1), "after": B.resolution_breakdown(v2),
            "trend": B.resolution_trend(v2, bd.date_dim(spark, d, last="2001-12-01"))}


def hidden_exposure_to_alert(spark: SparkSession, d: str, out_dir: str) -> DataFrame:
    """3.3: known and hidden exposure -> summary written once -> alerts read back."""
    summary = C.true_exposure_summary(
        C.known_exposure(bd.known_exposure_fact(spark, d)),
        C.hidden_exposure(bd.anomaly_exposure(spark, d), bd.name_variants(spark, d)),
        bd.counterparty_legal(spark, d), bd.legal_entity(spark, d))
    stored = _version(spark, summary, out_dir, "anomaly_summary")
    return C.breach_alerts(stored)


def sample_reset_rules(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Reset and re-resolve every O-status trade of 5-LOW priority (whole table scan)."""
    o = read_table(spark, d, "orders").filter((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW"))
    ids = o.select(F.col("o_orderkey").cast("string").alias("trade_id"))
    rules = o.select(F.col("o_orderkey").cast("string").alias("trade_id"),
                     F.col("o_custkey").cast("string").alias("counterparty_code"))
    return ids, rules

