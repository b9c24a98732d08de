"""Inputs that lose, double or mismatch rows if an operator is careless: NULL keys,
duplicate lookups, missing curves and weights, deep lineage, half-written tables."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskweave.operators import exposure as C
from riskweave.operators import governance as G
from riskweave.operators import load as A
from riskweave.operators import quality as Q
from riskweave.operators import resolution as B
from riskweave.operators import risk as H
from riskweave.operators import semantic as E
from riskweave.operators import star as D
from riskweave.plans.joins import left_join_spread
from riskweave.streaming import start_query


# ---- G5 ------------------------------------------------------------------------

def labels(spark, rows):
    return spark.createDataFrame(rows, "product_id string, sensitivity string, pii boolean")


def effective(spark, edges, own):
    out = G.inherit_classification(spark.createDataFrame(edges, "child string, parent string"), labels(spark, own))
    return {r.product_id: (r.sensitivity, r.pii) for r in out.collect()}


def test_lineage_of_any_depth_and_cycles(spark):
    edges = [(f"n{i}", f"n{i - 1}") for i in range(1, 31)] + [("a", "b"), ("b", "a"), ("b", "n30"), ("x", "x")]
    got = effective(spark, edges, [("n0", "RESTRICTED", True), ("n9", "PUBLIC", False)])
    assert all(got[f"n{i}"] == ("RESTRICTED", True) for i in range(31))
    assert got["a"] == got["b"] == ("RESTRICTED", True) and "x" not in got


def test_unlabelled_and_unknown_labels(spark):
    got = effective(spark, [("c", "p"), ("c", "q"), ("d", "u"), (None, "p"), ("e", None)],
                    [("p", "PUBLIC", False), ("q", "SECRET", None), ("u", None, None), ("u", None, False)])
    assert got["c"] == got["q"] == ("RESTRICTED", False)   # a label that is not in the order fails closed
    assert got["p"] == ("PUBLIC", False) and got["d"] == got["u"] == (None, False)


# ---- missing market data -----------------------------------------------------------

def quotes(spark):
    return spark.createDataFrame([("A", 1.0, 100.0), ("A", 10.0, 100.0)], "curve_id string, tenor_y double, spread_bp double")


def test_flows_without_a_curve_are_counted(spark):
    flows = spark.createDataFrame([("t", "A", 1.0, 100.0), ("t", "Z", 1.0, 40.0)],
                                  "trade_id string, curve_id string, time_y double, amount double")
    (r,) = H.discounted_pv(flows, quotes(spark), risk_free=0.0).collect()
    assert r.pv == pytest.approx(100 / 1.01) and (r.flows_without_curve, r.amount_without_curve) == (1, 40.0)


def test_exposure_without_a_pd_is_counted(spark):
    prof = spark.createDataFrame([("n", "A", 1.0, 10.0), ("n", "Z", 1.0, 7.0), ("m", "Z", 2.0, 3.0)],
                                 "netting_set string, curve_id string, time_y double, ee double")
    got = {r.netting_set: r for r in H.cva_on_quotes(prof, quotes(spark)).collect()}
    assert got["n"].cva > 0 and (got["n"].times_without_pd, got["n"].ee_without_pd) == (1, 7.0)
    assert got["m"].cva is None and got["m"].times_without_pd == 1
    both = {r.netting_set: r for r in H.cva_cs01(prof, quotes(spark)).collect()}
    assert both["n"].cva_base == pytest.approx(got["n"].cva) and both["n"].cva_cs01 > 0
    assert (both["n"].times_without_pd, both["m"].ee_without_pd) == (1, 3.0)


def test_correlation_table_and_missing_weight(spark):
    s = spark.createDataFrame([("A", "f", 3.0), ("A", "g", -2.0), ("A", "h", 5.0)], "curve_id string, k string, cs01 double")
    w = spark.createDataFrame([("f", 1.0), ("g", 2.0)], "k string, risk_weight double")
    rho = spark.createDataFrame([("f", "g", 0.25), ("g", "f", 0.25), ("f", "f", 1.0)], "factor_k string, factor_l string, rho double")
    (r,) = H.weighted_capital(s, w, rho, factor="k").collect()
    assert r.bucket_capital == pytest.approx((9 + 16 - 2 * 0.25 * 12) ** 0.5)
    assert (r.factors, r.factors_without_weight, r.sensitivity_without_weight) == (2, 1, 5.0)


def test_a_bucket_without_any_weight_has_no_capital(spark):
    s = spark.createDataFrame([("A", "f", 3.0), ("B", "h", 5.0)], "curve_id string, k string, cs01 double")
    w = spark.createDataFrame([("f", 1.0)], "k string, risk_weight double")
    table = spark.createDataFrame([("f", "g", 0.25)], "factor_k string, factor_l string, rho double")
    for rho in (table, 0.25):
        got = {r.curve_id: (r.ws_total, r.factors, r.bucket_capital) for r in H.weighted_capital(s, w, rho, factor="k").collect()}
        assert got == {"A": (3.0, 1, 3.0), "B": (None, 0, 0.0)}


def test_sensitivity_without_a_move_is_counted(spark):
    sens = spark.createDataFrame([("t", "A", 1.0, 2.0), ("t", "Z", 1.0, 9.0)], "trade_id string, curve_id string, tenor_y double, cs01 double")
    moves = spark.createDataFrame([("A", 1.0, 3.0)], "curve_id string, tenor_y double, move_bp double")
    act = spark.createDataFrame([("t", 7.0), ("u", 1.0)], "trade_id string, pnl double")
    got = {r.trade_id: tuple(r)[1:] for r in H.pnl_explain(sens, moves, act).collect()}
    assert got == {"t": (6.0, 1, 7.0, 1.0), "u": (None, 0, 1.0, 1.0)}


# ---- names without a key -------------------------------------------------------------

VARIANTS = "variant_name string, counterparty_code string, is_canonical boolean"


def test_names_without_letters_match_nothing(spark):
    v = spark.createDataFrame([("***", "1", True), ("\u4e09\u83f1\u5546\u4e8b", "2", True)], VARIANTS)
    t = spark.createDataFrame([("a", "---"), ("b", "\u65e5\u672c\u9280\u884c"), ("c", "\u4e09\u83f1 \u5546\u4e8b"), ("d", None)],
                              "trade_id string, booked_name string").selectExpr(
        "*", "CAST(NULL AS string) AS counterparty_code", "'UNMATCHED' AS resolution_status")
    got = {r.trade_id: r.counterparty_code for r in B.resolve_by_key(t, v).collect()}
    assert got == {"a": None, "b": None, "c": "2", "d": None}
    assert {r.booked_name for r in B.fuzzy_candidates(t, v).collect()} == {"\u4e09\u83f1 \u5546\u4e8b"}


# ---- NULL keys and duplicate lookups ------------------------------------------------------

def test_null_grain_is_one_group(spark):
    a = spark.createDataFrame([(None, 1), (None, 2), ("k", 3)], "g string, x int")
    b = spark.createDataFrame([(None, 10), ("z", 20)], "g string, y int")
    got = {r.g: (r.sx, r.sy) for r in D.aggregate_then_join([(a, {"sx": F.sum("x")}), (b, {"sy": F.sum("y")})], ["g"]).collect()}
    assert got == {None: (3, 10), "k": (3, None), "z": (None, 20)}


def test_reconcile_presence_is_not_the_value(spark):
    a = spark.createDataFrame([("k", None), (None, 1.0), ("a", 2.0), ("n", None)], "g string, v double")
    b = spark.createDataFrame([("k", 5.0), (None, 1.0), ("b", 2.0), ("n", None)], "g string, v double")
    got = {r.g: r.status for r in D.reconcile(a, b, ["g"], "v").collect()}
    assert got == {"k": "DIFFERS", None: "EQUAL", "a": "ONLY_IN_A", "b": "ONLY_IN_B", "n": "EQUAL"}


DAY = dt.date(2024, 1, 31)


def test_duplicate_rates_and_codes_never_double_rows(spark):
    rates = spark.createDataFrame([("EUR", DAY, Decimal("1.1")), ("EUR", DAY, Decimal("1.1")), ("GBP", DAY, Decimal("1.2")),
                                   ("GBP", DAY, Decimal("1.3"))], "currency string, business_date date, rate decimal(10,4)")
    x = spark.createDataFrame([(c, DAY, Decimal(10)) for c in ("EUR", "GBP", "USD", "CHF")], "currency string, business_date date, amount decimal(18,2)")
    got = {r.currency: (r.amount_reporting, r.fx_missing, r.fx_conflict)
           for r in A.convert_currency(x, rates, "amount", "currency", "business_date", "USD").collect()}
    assert got == {"EUR": (Decimal(11), False, False), "GBP": (None, True, True), "USD": (Decimal(10), False, False), "CHF": (None, True, False)}
    view = C.encumbrance_view(x, x.limit(0), rates).collect()
    assert len(view) == 4 and {r.currency for r in view if r.fx_missing} == {"GBP", "CHF"}
    codes = spark.createDataFrame([("s", "a", "A"), ("s", "a", "A"), ("s", "b", "B"), ("s", "b", "C")], "source_system string, source_code string, core_code string")
    y = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", "c")], "src string, code string")
    got = sorted((r.code, r.core_code, r.unmapped, r.ambiguous) for r in A.conform_values(y, "code", codes, "src").collect())
    assert got == [("a", "A", False, False), ("b", None, True, True), ("c", None, True, False)]


def test_rows_without_a_key_are_spread(spark):
    left = spark.range(1000).select("id", F.when(F.col("id") < 3, F.col("id").cast("string")).alias("k"))
    right = spark.createDataFrame([("0", "x"), ("9", "y")], "k string, v string")
    out = left_join_spread(left, right, ["k"])
    assert out.count() == 1000 and [r.v for r in out.filter("v IS NOT NULL").collect()] == ["x"]
    spread = out.select("id", "v").columns == ["id", "v"] and set(out.columns) == {"k", "id", "v"}
    assert spread and "_spread" in out._jdf.queryExecution().executedPlan().toString()


# ---- calendars -----------------------------------------------------------------------------

def test_weekends_are_no_gaps_and_stopped_feeds_are_missing(spark):
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    rows = [("p", at(5, 11)), ("p", at(8, 11)), ("p", at(8, 23)), ("q", at(5, 11)), ("q", at(6, 12))]   # 5 January is a Friday
    loads = spark.createDataFrame(rows, "product_id string, load_time timestamp_ntz")
    got = {(r.product_id, r.business_date.day): r.status for r in Q.freshness(loads, as_of="2024-01-09").collect()}
    assert got == {("p", 5): "ON_TIME", ("p", 8): "ALERT", ("p", 9): "MISSING",     # the reload at 18:00 local counts
                   ("q", 5): "ON_TIME", ("q", 6): "ON_TIME", ("q", 8): "MISSING", ("q", 9): "MISSING"}
    assert {(r.product_id, r.business_date.day) for r in Q.freshness(loads).collect()} == set(got) - {("p", 9), ("q", 9)}
    band = {(r.product_id, r.business_date.day): (r.prev_count, r.verdict)
            for r in Q.row_count_band(loads, "load_time", ["product_id"], as_of="2024-01-09").collect()}
    assert band[("p", 8)] == (1, "OUT_OF_BAND") and ("p", 6) not in band and band[("q", 6)] == (None, "OFF_CALENDAR")
    assert band[("q", 8)] == (1, "OUT_OF_BAND") and band[("q", 9)] == (0, "OK")
    bank = spark.createDataFrame([(dt.date(2024, 1, 5),), (dt.date(2024, 1, 9),)], "business_date date")
    assert {r.business_date.day for r in Q.freshness(loads.filter("product_id = 'q'"), calendar=bank, as_of="2024-01-09")
            .filter("status = 'MISSING'").collect()} == {9}


# ---- contracts, registry, writes --------------------------------------------------------------

def test_contract_fails_closed(spark):
    df = spark.createDataFrame([("a", "x", 1.0, 2.0)], "id string, trader string, v double, w double")
    c = {"grain": ["id"], "allowed": [], "blocked": ["trader"], "measures": [
        {"name": "v", "aggregation": "additive"}, {"name": "r", "aggregation": "ratio", "numerator": "v", "denominator": "w"}]}
    for measure, by, where in (("v", [], None), ("r", [], None), ("v", ["id"], {"trader": "x"}), ("v", ["id"], {"w": [2.0]})):
        with pytest.raises(E.ContractViolation):
            E.measure_query(df, c, [measure], by, where)
    assert E.measure_query(df, c, ["v"], ["id"], {"id": ["a", "b"]}).count() == 1


def test_validations_after_as_of_are_not_active(spark):
    reg = spark.createDataFrame([("a", dt.date(2025, 7, 1), True), ("b", dt.date(2025, 6, 30), True)],
                                "consumer_id string, last_validated_date date, business_critical boolean")
    assert [r.consumer_id for r in G.active_consumers(reg, "2025-06-30").collect()] == ["b"]
    assert [r.consumer_id for r in G.stale_consumers(reg, "2025-06-30").collect()] == ["a"]


def test_a_half_written_table_is_written_again(spark, tmp_path):
    p = tmp_path / "t"
    os.makedirs(p / "_temporary" / "0")
    A.materialize(spark.range(3), str(p))
    A.materialize(spark.range(9), str(p))
    assert spark.read.parquet(str(p)).count() == 3


def test_positional_append(spark):
    a, b = spark.createDataFrame([(1, "x")], "k long, n string"), spark.createDataFrame([(2, "y")], "id int, name string")
    out = A.append_rows(a, b, by="position")
    assert out.columns == ["k", "n"] and sorted(map(tuple, out.collect())) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        A.append_rows(a, b.select("id"), by="position")


def test_unmapped_columns_are_kept_or_named(spark):
    src = {"a": spark.createDataFrame([(1, 2)], "x int, extra int")}
    assert A.conform_union(src, {"a": {"x": "k"}}).columns == ["k", "extra", "source_app"]
    with pytest.warns(UserWarning, match="extra"):
        assert A.conform_union(src, {"a": {"x": "k"}}, keep_unmapped=False).columns == ["k", "source_app"]


def test_streams_need_a_path(spark):
    with pytest.raises(ValueError):
        start_query(spark.readStream.format("rate").load(), "no_path")


# ---- repeated lookup rows and NULL keys of single operators ------------------------------------------

def test_a_move_listed_twice_and_trades_without_a_number(spark):
    sens = spark.createDataFrame([("t", "A", 1.0, 2.0), (None, "A", 1.0, 1.0), ("u", "B", 1.0, 4.0)], "trade_id string, curve_id string, tenor_y double, cs01 double")
    moves = spark.createDataFrame([("A", 1.0, 3.0), ("A", 1.0, 3.0), ("B", 1.0, 1.0), ("B", 1.0, 2.0)], "curve_id string, tenor_y double, move_bp double")
    act = spark.createDataFrame([("t", 7.0), (None, 9.0)], "trade_id string, pnl double")
    got = {r.trade_id: tuple(r)[1:] for r in H.pnl_explain(sens, moves, act).collect()}
    assert got == {"t": (6.0, 0, 7.0, 1.0), None: (3.0, 0, 9.0, 6.0), "u": (None, 1, None, 0.0)}


def test_a_weight_or_correlation_listed_twice(spark):
    s = spark.createDataFrame([("A", "f", 3.0), ("A", "g", -2.0), ("B", "f", 1.0), (None, "f", 2.0), (None, "g", 1.0), ("C", "h", 1.0)], "curve_id string, k string, cs01 double")
    w = spark.createDataFrame([("f", 1.0), ("f", 1.0), ("g", 2.0), ("h", 1.0), ("h", 3.0)], "k string, risk_weight double")
    table = lambda rows: spark.createDataFrame(rows, "factor_k string, factor_l string, rho double")
    both = [("f", "g", 0.25), ("g", "f", 0.25)]
    got = {r.curve_id: r for r in H.weighted_capital(s, w, table(both * 2), factor="k").collect()}
    assert got["A"].bucket_capital == pytest.approx((9 + 16 - 2 * 0.25 * 12) ** 0.5) and (got["A"].ws_total, got["A"].factors) == (-1.0, 2)
    assert got[None].bucket_capital == pytest.approx((4 + 4 + 2 * 0.25 * 4) ** 0.5)
    assert (got["C"].factors, got["C"].factors_without_weight) == (0, 1)
    odd = {r.curve_id: r.bucket_capital for r in H.weighted_capital(s, w, table([*both, ("f", "g", 0.5)]), factor="k").collect()}
    assert odd["A"] is None and odd[None] is None and odd["B"] == 1.0


def test_two_entities_of_a_counterparty_double_nothing(spark):
    le = spark.createDataFrame([("L2", "P2", "e2", "c", False), ("L1", "P1", "e1", "c", False), ("L1", "P1", "e1", "c", False), ("L0", "P1", "P1", "c", True)],
                               "lei_code string, ultimate_parent_name string, legal_entity_name string, counterparty_code string, is_ultimate_parent boolean")
    x = spark.createDataFrame([("c", Decimal(10))], "counterparty_code string, exposure_amount decimal(18,2)")
    top = B.parent_rollup(x, le).filter("rollup_level = 7").first()
    assert (top.total_exposure, top.trade_count) == (Decimal(10), 1)
    (r,) = B.parent_lookup(x, le).collect()
    assert (r.ultimate_parent_name, r.legal_entity_name) == ("P1", "e1")
    known = x.selectExpr("counterparty_code", "DATE'2024-01-31' AS as_of_date", "CAST(exposure_amount AS decimal(38,2)) AS known_exposure")
    hidden = known.limit(0).selectExpr("counterparty_code", "as_of_date", "known_exposure AS hidden_exposure", "0L AS variant_count", "0L AS source_system_count")
    dim = x.selectExpr("counterparty_code", "'n' AS counterparty_legal_name", "CAST(1 AS decimal(18,2)) AS threshold_principal")
    assert C.true_exposure_summary(known, hidden, dim, le).count() == 1


def test_groups_without_a_name_are_listed_once(spark):
    rows = [(None, dt.datetime(2024, 1, 8, 11)), (None, dt.datetime(2024, 1, 10, 11)), ("p", dt.datetime(2024, 1, 8, 11))]
    loads = spark.createDataFrame(rows, "product_id string, load_time timestamp_ntz")
    got = sorted((r.product_id or "", r.business_date.day, r.status) for r in Q.freshness(loads, as_of="2024-01-10").collect())
    assert got == [("", 8, "ON_TIME"), ("", 9, "MISSING"), ("", 10, "ON_TIME"), ("p", 8, "ON_TIME"), ("p", 9, "MISSING"), ("p", 10, "MISSING")]
    band = sorted((r.product_id or "", r.business_date.day, r.row_count, r.verdict or "") for r in Q.row_count_band(loads, "load_time", ["product_id"], as_of="2024-01-09").collect())
    assert band == [("", 8, 1, ""), ("", 9, 0, "OUT_OF_BAND"), ("p", 8, 1, ""), ("p", 9, 0, "OUT_OF_BAND")]


def test_lineage_without_an_upstream_equals_itself(spark):
    df = lambda rows: spark.createDataFrame(rows, "product_id string, upstream string")
    got = {tuple(r) for r in G.lineage_diff(df([("a", None), ("b", None), (None, "t")]), df([("a", None), ("c", None), (None, "t")])).collect()}
    assert got == {("b", None, "DECLARED_NOT_READ"), ("c", None, "READ_NOT_DECLARED")}
