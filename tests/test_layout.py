"""Physical layout for scale: month partitions prune, buckets co-locate joins."""

import contextlib
import io
import uuid

from pyspark.sql import functions as F

from riskweave.operators import load as A
from riskweave.sources import bindings as bd
from tests.conftest import SF_SMALL


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_month_partitions_are_pruned(spark, tmp_path):
    p = str(tmp_path / "trades_by_month")
    t = bd.trades(spark, SF_SMALL).withColumn("trade_month", F.date_format("trade_date", "yyyy-MM"))
    A.materialize(t, p, partition_by=["trade_month"])
    back = spark.read.parquet(p).filter(F.col("trade_month") == "1996-03")
    plan = _plan(back)
    assert "PartitionFilters: [isnotnull(trade_month" in plan and "1996-03" in plan
    assert back.count() == t.filter(F.col("trade_month") == "1996-03").count()


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    tag = uuid.uuid4().hex[:6]
    t = bd.trades(spark, SF_SMALL).filter(F.col("counterparty_code").isNotNull())
    cp = bd.counterparty(spark, SF_SMALL)
    A.materialize(t, str(tmp_path / "t"), bucket_by=(4, ["counterparty_code"]), table=f"trades_b_{tag}")
    A.materialize(cp, str(tmp_path / "c"), bucket_by=(4, ["counterparty_code"]), table=f"cp_b_{tag}")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table(f"trades_b_{tag}").join(spark.table(f"cp_b_{tag}"), "counterparty_code")
        plan = _plan(j)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == t.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
