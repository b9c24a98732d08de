"""Semantic-layer refusals (E1-E4) and governance edge cases."""

import pytest
from pyspark.sql import functions as F

from riskweave.operators import governance as G
from riskweave.operators import semantic as E

CONTRACT = {
    "product_id": "p", "grain": ["trade_id", "day"], "allowed": ["desk"], "blocked": ["trader"],
    "default_filters": ["amount IS NOT NULL"],
    "measures": [{"name": "amount", "aggregation": "additive", "safe_aggregation": ["trade_id"]},
                 {"name": "pfe", "aggregation": "native_grain"},
                 {"name": "ratio", "aggregation": "ratio", "numerator": "a", "denominator": "b"}],
    "joinable": [{"product_id": "desks", "join_on": ["desk"]}],
}


@pytest.fixture
def df(spark):
    return spark.createDataFrame([("t1", 1, "D1", "x", 10.0, 5.0, 1.0, 2.0), ("t2", 1, "D1", "y", None, 7.0, 1.0, 8.0),
                                  ("t3", 2, "D2", "x", 4.0, 1.0, 3.0, 4.0)],
                                 "trade_id string, day int, desk string, trader string, amount double, pfe double, "
                                 "a double, b double")


def test_blocked_and_unlisted_dimensions(df):
    with pytest.raises(E.ContractViolation):
        E.measure_query(df, CONTRACT, ["amount"], ["trader"])
    with pytest.raises(E.ContractViolation):
        E.measure_query(df, CONTRACT, ["amount"], ["a"])


def test_unsafe_aggregation_refused(df):
    with pytest.raises(E.ContractViolation):
        E.measure_query(df, CONTRACT, ["amount"], ["desk"])   # sums away 'day', not listed as safe
    out = E.measure_query(df, CONTRACT, ["amount"], ["desk", "day"]).orderBy("desk").collect()
    assert [(r.desk, r.amount) for r in out] == [("D1", 10.0), ("D2", 4.0)]   # default filter applied


def test_native_grain_and_ratio(df):
    with pytest.raises(E.ContractViolation):
        E.aggregate_by_rule(df, CONTRACT, ["pfe"], ["desk"])
    r = {x.desk: x.ratio for x in E.aggregate_by_rule(df, CONTRACT, ["ratio"], ["desk"]).collect()}
    assert r["D1"] == pytest.approx(2.0 / 10.0)   # recomputed from sums, not an average of ratios


def test_safe_join(spark, df):
    desks = spark.createDataFrame([("D1", "Rates"), ("D2", "Credit")], "desk string, name string")
    assert E.safe_join(df, desks, CONTRACT, "desks").count() == 3
    with pytest.raises(E.ContractViolation):
        E.safe_join(df, desks, CONTRACT, "books")
    dup = desks.union(desks)
    with pytest.raises(E.ContractViolation):
        E.safe_join(df, dup, CONTRACT, "desks")


def test_alias_lookup_is_exact(spark):
    tags = spark.createDataFrame([("c", "s", "t", "notional", "source_aliases", "app1:notl,app2:ntl"),
                                  ("c", "s", "t", "notional_usd", "source_aliases", "app1:notl_usd")],
                                 "table_catalog string, table_schema string, table_name string, column_name string, "
                                 "tag_name string, tag_value string")
    assert [r.column_name for r in G.find_canonical_column(tags, "app1", "notl").collect()] == ["notional"]
    assert {(r.app, r.source_column) for r in G.find_aliases(tags, "notional").collect()} == \
        {("app1", "notl"), ("app2", "ntl")}


def test_classification_inherits_through_levels(spark):
    lineage = spark.createDataFrame([("mart", "silver"), ("silver", "raw_pii"), ("silver", "raw_ref"),
                                     ("dash", "mart")], "child string, parent string")
    labels = spark.createDataFrame([("raw_pii", "CONFIDENTIAL", True), ("raw_ref", "PUBLIC", False),
                                    ("dash", "INTERNAL", False)], "product_id string, sensitivity string, pii boolean")
    got = {r.product_id: (r.sensitivity, r.pii) for r in G.inherit_classification(lineage, labels).collect()}
    assert got["dash"] == ("CONFIDENTIAL", True)
    assert got["mart"] == ("CONFIDENTIAL", True)
    assert got["raw_ref"] == ("PUBLIC", False)


def test_active_and_stale_partition_registry(spark):
    import datetime as dt
    reg = spark.createDataFrame([("a", dt.date(2025, 6, 1), True), ("b", dt.date(2023, 1, 1), False),
                                 ("c", None, True)], "consumer_id string, last_validated_date date, business_critical boolean")
    assert [r.consumer_id for r in G.active_consumers(reg, "2025-06-30").collect()] == ["a"]
    assert [r.consumer_id for r in G.stale_consumers(reg, "2025-06-30").collect()] == ["c", "b"]
    assert F is not None
