"""The bindings as SQL views: reference-style SQL gives the operators' answers."""

import subprocess
import sys

from riskweave.operators import exposure as C
from riskweave.operators import resolution as B
from riskweave.sources import bindings as bd
from tests.conftest import ROOT, SF_SMALL


def test_status_breakdown_in_sql_equals_operator(spark):
    bd.register_views(spark, SF_SMALL, prefix="rw_")
    got = spark.sql("""
        SELECT resolution_status, COUNT(*) AS trade_count,
               CAST(SUM(exposure_amount) AS DECIMAL(38,2)) AS total_exposure
        FROM rw_trades GROUP BY resolution_status""").collect()
    want = B.resolution_breakdown(bd.trades(spark, SF_SMALL)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_sql_over_the_views_equals_exposure_operator(spark):
    bd.register_views(spark, SF_SMALL, prefix="rw_")
    got = spark.sql("""
        WITH open_trades AS (SELECT * FROM rw_trades WHERE resolution_status = 'MATCHED_ORIGINAL')
        SELECT canonical_name, count(*) AS trade_count, CAST(sum(exposure_amount) AS DECIMAL(38,2)) AS total
        FROM open_trades NATURAL JOIN (SELECT counterparty_code, canonical_name FROM rw_counterparty)
        GROUP BY ALL""").collect()
    want = C.exposure_by_counterparty(bd.trades(spark, SF_SMALL), bd.counterparty(spark, SF_SMALL)).collect()
    assert got and sorted(map(tuple, got)) == sorted((r.canonical_name, r.trade_count, r.exposure) for r in want)


def test_cli_lists_queries():
    out = subprocess.run([sys.executable, "-m", "riskweave", "list"], cwd=ROOT, capture_output=True, text=True,
                         timeout=120)
    assert out.returncode == 0 and "true_exposure_summary" in out.stdout.split()
