
from pyspark.sql import functions as F

from riskweave.operators import risk as H
from riskweave.operators import star as D
from riskweave.plans.bound import REGISTRY
from riskweave.sources import bindings as bd
from tests.conftest import SF_SMALL


def test_trend_counts_add_up(spark):
    bad = REGISTRY["resolution_trend"](spark, SF_SMALL).filter(
        F.col("matched_trades") + F.col("unmatched_trades") != F.col("total_trades")).count()
    assert bad == 0


def test_before_plus_newly_resolved_is_after(spark):
    before = {r.canonical_name: r.before_resolution_exposure
              for r in REGISTRY["exposure_before_resolution"](spark, SF_SMALL).collect()}
    after = {r.canonical_name: r.after_resolution_exposure
             for r in REGISTRY["exposure_after_resolution"](spark, SF_SMALL).collect()}
    t = bd.trades(spark, SF_SMALL).filter(F.col("resolution_status") == "MATCHED_RESOLVED")
    cp = bd.counterparty(spark, SF_SMALL)
    resolved = {r.canonical_name: r.x for r in t.join(cp, "counterparty_code").groupBy("canonical_name")
                .agg(F.sum("exposure_amount").alias("x")).collect()}
    for name, x in after.items():
        assert before.get(name, 0) + resolved.get(name, 0) == x


def test_reset_then_resolve_restores_totals(spark):
    a = sorted(map(tuple, REGISTRY["reset_then_resolve_breakdown"](spark, SF_SMALL).collect()))
    b = sorted(map(tuple, REGISTRY["resolution_breakdown"](spark, SF_SMALL).collect()))
    assert a == b


def test_ee_below_peak_path_and_pfe_rises_with_level(spark):
    net = H.net_exposure(bd.path_values(spark, SF_SMALL))
    mx = net.groupBy("netting_set", "scenario", "time_y").agg(F.max("exposure").cast("double").alias("mx"))
    p90 = H.exposure_profile(net, 100, 0.90).select("netting_set", "scenario", "time_y", "ee",
                                                    F.col("pfe").alias("p90"))
    p99 = H.exposure_profile(net, 100, 0.99).select("netting_set", "scenario", "time_y", F.col("pfe").alias("p99"))
    j = p90.join(p99, ["netting_set", "scenario", "time_y"]).join(mx, ["netting_set", "scenario", "time_y"])
    assert j.filter((F.col("ee") > F.col("mx") + 1e-9) | (F.col("p90") > F.col("p99") + 1e-9)).count() == 0


def test_aggregate_then_join_keeps_each_total(spark):
    a, b = bd.sales_a(spark, SF_SMALL), bd.sales_b(spark, SF_SMALL)
    w = D.aggregate_then_join([(a, {"x": F.sum("amount")}), (b, {"y": F.sum("amount")})], ["order_id"])
    got = w.agg(F.sum("x"), F.sum("y")).collect()[0]
    assert got[0] == a.agg(F.sum("amount")).collect()[0][0]
    assert got[1] == b.agg(F.sum("amount")).collect()[0][0]
