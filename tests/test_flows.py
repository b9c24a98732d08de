"""The three end-to-end flows compose and keep every version."""

import os

from pyspark.sql import functions as F

from riskweave.plans import flows
from riskweave.plans.bound import REGISTRY
from tests.conftest import SF_SMALL


def test_load_and_verify(spark):
    out = flows.load_and_verify(spark, SF_SMALL)
    counts = {r.tbl: r.row_count for r in out["row_counts"].collect()}
    assert counts["trades"] == sum(r.trade_count for r in out["breakdown"].collect())


def test_reset_resolve_refresh_versions(spark, tmp_path):
    ids, rules = flows.sample_reset_rules(spark, SF_SMALL)
    out = flows.reset_resolve_refresh(spark, SF_SMALL, str(tmp_path), ids, rules)
    for v in ("trades_v0", "trades_v1_reset", "trades_v2_resolved"):
        assert os.path.exists(tmp_path / v / "_SUCCESS")
    before = {r.resolution_status: r.trade_count for r in out["before"].collect()}
    after = {r.resolution_status: r.trade_count for r in out["after"].collect()}
    n = ids.count()
    assert before["UNMATCHED"] - n == after["UNMATCHED"]
    assert out["queue"].count() == before["UNMATCHED"]
    assert out["trend"].agg(F.sum("unmatched_trades")).collect()[0][0] == after["UNMATCHED"]


def test_hidden_exposure_to_alert_writes_summary_once(spark, tmp_path):
    alerts = flows.hidden_exposure_to_alert(spark, SF_SMALL, str(tmp_path))
    assert alerts.count() == REGISTRY["breach_alerts"](spark, SF_SMALL).count()
    files = sorted(os.listdir(tmp_path / "anomaly_summary"))
    flows.hidden_exposure_to_alert(spark, SF_SMALL, str(tmp_path))      # second run keeps the table
    assert sorted(os.listdir(tmp_path / "anomaly_summary")) == files
