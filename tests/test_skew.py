"""A third of all rows on one key: results stay whole and correct.

The skewed table is derived by Spark from the shared tables: every
MATCHED_ORIGINAL trade is re-booked to one counterparty and one name.
"""

from pyspark.sql import functions as F

from riskweave.operators import exposure as C
from riskweave.operators import resolution as B
from riskweave.sources import bindings as bd
from riskweave.session import SCALE_CONF
from tests.conftest import SF_SMALL

HOT = "1"


def _skewed(spark):
    t = bd.trades(spark, SF_SMALL)
    hot = F.col("resolution_status") == "MATCHED_ORIGINAL"
    return t.select(*[F.when(hot, F.lit(HOT)).otherwise(F.col(c)).alias(c) if c == "counterparty_code"
                      else F.when(hot, F.lit("Customer#000000001")).otherwise(F.col(c)).alias(c)
                      if c == "booked_name" else F.col(c) for c in t.columns])


def test_skew_settings_are_on():
    assert SCALE_CONF["spark.sql.adaptive.enabled"] == "true"
    assert SCALE_CONF["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_hot_counterparty_exposure(spark):
    t = _skewed(spark)
    share = t.filter(F.col("counterparty_code") == HOT).count() / t.count()
    assert share > 0.3
    got = {r.canonical_name: (r.exposure, r.trade_count)
           for r in C.exposure_by_counterparty(t, bd.counterparty(spark, SF_SMALL)).collect()}
    want = t.filter("resolution_status = 'MATCHED_ORIGINAL'").agg(
        F.sum("exposure_amount").alias("x"), F.count("*").alias("n")).collect()[0]
    assert got == {"Customer#000000001": (want.x, want.n)}


def test_hot_name_resolution_keeps_every_row(spark):
    t = _skewed(spark)
    out = B.resolve_by_variant(t, bd.name_variants(spark, SF_SMALL))
    assert out.count() == t.count()
    hot = out.filter(F.col("booked_name") == "Customer#000000001")
    assert hot.filter(F.col("counterparty_code") == HOT).count() == hot.count()
    assert set(r.resolution_status for r in hot.select("resolution_status").distinct().collect()) == \
        {"MATCHED_ORIGINAL"}
