"""Checks recorded in FIXTURES.md section 3 for the bindings at sf0.01."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskweave.operators import risk as H
from riskweave.plans.bound import REGISTRY
from riskweave.sources import bindings as bd
from riskweave.sources import schemas as S
from tests.conftest import SF_CHECK


def test_binding_row_counts(spark):
    d = SF_CHECK
    got = {"trades": bd.trades(spark, d).count(), "counterparty": bd.counterparty(spark, d).count(),
           "date": bd.date_dim(spark, d).count(), "variants": bd.name_variants(spark, d).count(),
           "known": bd.known_exposure_fact(spark, d).count(), "hidden": bd.anomaly_exposure(spark, d).count(),
           "legal": bd.legal_entity(spark, d).count(), "limits": bd.facility_limits(spark, d).count()}
    assert got == {"trades": 15000, "counterparty": 1500, "date": 80, "variants": 4500, "known": 9912,
                   "hidden": 5088, "legal": 3000, "limits": 2756}


def test_resolution_impact_counts(spark):
    got = {r.resolution_impact: r.row_count for r in REGISTRY["resolution_impact_counts"](spark, SF_CHECK).collect()}
    assert got == {"NEW BREACH DETECTED": 1130, "BREACH WORSENED": 1612, "NO CHANGE": 3624}


def test_encumbrance_totals(spark):
    e = REGISTRY["encumbrance_view"](spark, SF_CHECK)
    r = e.agg(F.count("*").alias("n"), F.sum("free_amount").alias("free"),
              F.count(F.when(F.col("pledged_amount") == 0, 1)).alias("nothing_pledged"),
              F.count(F.when(F.col("over_pledged"), 1)).alias("over")).collect()[0]
    assert (r.n, r.free, r.nothing_pledged, r.over) == (1975, Decimal("2485039865.74"), 150, 0)


def test_direct_access_totals(spark):
    r = REGISTRY["direct_access"](spark, SF_CHECK).agg(
        F.sum("reads").alias("reads"), F.countDistinct("consumer_id").alias("consumers")).collect()[0]
    assert (r.reads, r.consumers) == (4031, 150)


def test_profile_refuses_unnetted_input(spark):
    rows = [("ns", "t", "base", 0, 1.0, Decimal(v)) for v in (1, 2, 3)]
    raw = spark.createDataFrame(rows, S.PATH_VALUES).withColumn("exposure", F.col("value"))
    with pytest.raises(Exception):
        H.exposure_profile(raw, n_paths=2).collect()
