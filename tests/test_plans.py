"""Plan checks: no cross products, filters and column pruning reach the scan."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from riskweave.plans.bound import REGISTRY
from tests.conftest import SF_SMALL


def _plan(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_cross_product(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_status_filter_is_pushed_to_the_scan(spark):
    plan = _plan(REGISTRY["known_exposure"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderstatus), Not(EqualTo(o_orderstatus,P))" in plan


def test_columns_are_pruned(spark):
    plan = _plan(REGISTRY["resolution_breakdown"](spark, SF_SMALL))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "orders.parquet" in line]
    # only the two columns the breakdown needs are read, from orders alone
    assert scans and all("ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in s for s in scans)
    assert "customer.parquet" not in plan


@pytest.mark.parametrize("name,table,most", [
    ("exposure_before_resolution", "orders", 1), ("resolution_trend", "orders", 1), ("parent_rollup", "orders", 1),
    ("cva", "lineitem", 0), ("cva_cs01", "lineitem", 0), ("pnl_explain", "lineitem", 2), ("stressed_pfe", "lineitem", 1)])
def test_facts_are_scanned_no_more_than_needed(spark, name, table, most):
    """cva and cva_cs01 write the profile once, so their plan reads it and not the fact."""
    plan = _plan(REGISTRY[name](spark, SF_SMALL))
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x and f"{table}.parquet" in x]
    assert len(scans) <= most


@pytest.mark.parametrize("name", ["exposure_before_resolution", "resolution_breakdown", "collateral_value", "net_exposure"])
def test_partial_aggregate_stands_below_the_first_exchange(spark, name):
    lines = _plan(REGISTRY[name](spark, SF_SMALL)).splitlines()
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x and ("orders" in x or "lineitem" in x))
    above = lines[:scan][::-1]
    exchange = next(i for i, x in enumerate(above) if "Exchange" in x)
    assert any("partial_" in x for x in above[:exchange])


def test_exposure_profile_needs_no_grid_join(spark):
    plan = _plan(REGISTRY["exposure_profile"](spark, SF_SMALL))
    assert "Join" not in plan


def test_summary_joins_fact_sides_without_reshuffle(spark):
    plan = _plan(REGISTRY["true_exposure_summary"](spark, SF_SMALL))
    # known and hidden are each aggregated on (code, date); the left join between
    # them must not add a third exchange on those keys
    assert plan.count("hashpartitioning(counterparty_code") <= 6


@pytest.mark.parametrize("name", ["exposure_before_resolution", "resolution_trend", "hidden_exposure",
                                  "parent_rollup", "exposure_trend"])
def test_fact_is_partially_aggregated_before_its_first_shuffle(spark, name):
    """A hot counterparty must be reduced map-side: the scan side of the first
    exchange over the fact carries a partial aggregate."""
    plan = _plan(REGISTRY[name](spark, SF_SMALL))
    assert "partial_sum" in plan or "partial_count" in plan


@pytest.mark.parametrize("name", ["freshness", "row_count_band", "lineage_diff", "direct_access",
                                  "resolution_trend", "exposure_trend", "collateral_value"])
def test_results_do_not_depend_on_session_time_zone(spark, name):
    def rows():
        return sorted(map(tuple, REGISTRY[name](spark, SF_SMALL).collect()), key=repr)
    base = rows()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        other = rows()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert base == other
