"""Golden unit tests on tiny inline tables (invented entities), numbers from FIXTURES.md."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskweave.functions.columns import name_key
from riskweave.operators import exposure as C
from riskweave.operators import load as A
from riskweave.operators import quality as Q
from riskweave.operators import resolution as B
from riskweave.operators import risk as H
from riskweave.operators import star as D
from riskweave.sources import schemas as S

T_SCHEMA = ("trade_id string, trade_date date, counterparty_code string, booked_name string, "
            "source_system string, margin_type string, exposure_amount decimal(18,2), "
            "call_amount decimal(18,2), resolution_status string")


def _d(x):
    return Decimal(str(x))


def trades(spark, rows):
    import datetime as dt
    full = [(r[0], dt.date(2026, 1, 31), r[1], r[2], "SYS", "VM", _d(r[3]), None, r[4]) for r in rows]
    return spark.createDataFrame(full, T_SCHEMA)


@pytest.fixture
def base(spark):
    return trades(spark, [
        ("T1", "AAA", "Alpha Bank", 10.0, "MATCHED_ORIGINAL"),
        ("T2", "AAA", "Alpha Bnk", 5.0, "MATCHED_RESOLVED"),
        ("T3", None, "ALPHA BANK LTD", 2.5, "UNMATCHED"),
        ("T4", None, "Unknown Co", 1.5, "UNMATCHED"),
        ("T5", "BBB", "Beta Holdings", 7.0, "MATCHED_ORIGINAL"),
    ])


def test_resolution_breakdown(base):
    got = {r.resolution_status: (r.trade_count, r.total_exposure) for r in B.resolution_breakdown(base).collect()}
    assert got == {"MATCHED_ORIGINAL": (2, _d("17.00")), "MATCHED_RESOLVED": (1, _d("5.00")),
                   "UNMATCHED": (2, _d("4.00"))}


def test_entity_search_is_plain_substring(spark):
    dim = spark.createDataFrame([("GSX", "Gold Sax", "Gold Sax GS Co"), ("HHX", "Hold Bank", "Hold Bank HOLDINGS")],
                                "counterparty_code string, canonical_name string, entity_search_field string")
    assert sorted(r.counterparty_code for r in B.entity_search(dim, "gs").collect()) == ["GSX", "HHX"]


def test_resolve_by_name_rewrites_all_rows_of_the_name(spark, base):
    rules = spark.createDataFrame([("ALPHA BANK LTD", "AAA"), ("Alpha Bank", "AAA")],
                                  "booked_name string, counterparty_code string")
    out = {r.trade_id: (r.counterparty_code, r.resolution_status) for r in B.resolve_by_name(base, rules).collect()}
    assert out["T3"] == ("AAA", "MATCHED_RESOLVED")
    assert out["T1"] == ("AAA", "MATCHED_RESOLVED")   # already matched rows are rewritten too
    assert out["T4"] == (None, "UNMATCHED")


def test_two_rules_for_one_name_are_not_applied(spark, base):
    rules = spark.createDataFrame([("Unknown Co", "AAA"), ("Unknown Co", "BBB")],
                                  "booked_name string, counterparty_code string")
    out = {r.trade_id: r.resolution_status for r in B.resolve_by_name(base, rules).collect()}
    assert out["T4"] == "UNMATCHED"


def test_reset_then_resolve_restores_rows(spark, base):
    ids = spark.createDataFrame([("T2",), ("T5",)], "trade_id string")
    rules = spark.createDataFrame([("T2", "AAA"), ("T5", "BBB")], "trade_id string, counterparty_code string")
    reset = B.reset_resolution(base, ids)
    assert reset.filter("resolution_status = 'UNMATCHED'").count() == 4
    back = B.resolve_by_id(reset, rules)
    got = {r.trade_id: (r.counterparty_code, r.resolution_status) for r in back.collect()}
    assert got["T2"] == ("AAA", "MATCHED_RESOLVED") and got["T5"] == ("BBB", "MATCHED_RESOLVED")


def test_extend_search_text_keeps_null(spark):
    dim = spark.createDataFrame([("A", "x"), ("B", None)], "counterparty_code string, entity_search_field string")
    adds = spark.createDataFrame([("A", "y z"), ("B", "w")], "counterparty_code string, text string")
    got = {r.counterparty_code: r.entity_search_field for r in B.extend_search_text(dim, adds).collect()}
    assert got == {"A": "x y z", "B": None}


def test_resolve_by_variant_statuses_and_ambiguity(spark, base):
    v = spark.createDataFrame([
        ("V1", "AAA", "Alpha Bank", True), ("V2", "AAA", "Alpha Bnk", False),
        ("V3", "BBB", "Beta Holdings", True), ("V4", "AAA", "Unknown Co", False),
        ("V5", "BBB", "Unknown Co", False)],
        "variant_id string, counterparty_code string, variant_name string, is_canonical boolean")
    got = {r.trade_id: (r.counterparty_code, r.resolution_status, r.is_ambiguous)
           for r in B.resolve_by_variant(base, v).collect()}
    assert got["T1"] == ("AAA", "MATCHED_ORIGINAL", False)
    assert got["T2"] == ("AAA", "MATCHED_RESOLVED", False)
    assert got["T3"] == (None, "UNMATCHED", False)
    assert got["T4"] == (None, "UNMATCHED", True)


def test_name_key_variants(spark):
    df = spark.createDataFrame([("Goldmann-Sachs & Co",), ("G0LDMANN SACHS CO",), ("goldmann.sachs co",)], "n string")
    keys = {r.k for r in df.select(name_key("n").alias("k")).collect()}
    assert keys == {"GOLDMANNSACHSCO"}


def test_fuzzy_candidates_match_brute_force(spark):
    names = spark.createDataFrame([("Goldmann Sachs",), ("JP Morgon",), ("Chase",), ("Zzz",)], "booked_name string")
    v = spark.createDataFrame([("AAA", "Goldman Sachs"), ("BBB", "JP Morgan"), ("CCC", "Chase"), ("DDD", "Chaser")],
                              "counterparty_code string, variant_name string")
    for d in (1, 2):
        got = {(r.booked_name, r.counterparty_code, r.distance)
               for r in B.fuzzy_candidates(names, v, max_distance=d, k=1).collect()}
        # brute force: all pairs, best distance per name
        pairs = (names.crossJoin(v)  # fixture-sized brute force only
                      .select("booked_name", "counterparty_code",
                              F.levenshtein(name_key("booked_name"), name_key("variant_name")).alias("d"))
                      .filter(F.col("d") <= d).collect())
        best = {}
        for p in pairs:
            best[p.booked_name] = min(best.get(p.booked_name, 99), p.d)
        want = {(p.booked_name, p.counterparty_code, p.d) for p in pairs if p.d == best[p.booked_name]}
        assert got == want


def test_resolution_trend_rounding(spark):
    import datetime as dt
    rows = [("T%d" % i, dt.date(2026, 1, 31), "AAA" if i < 9 else None, "n", "S", "VM",
             _d("1000000.00"), None, "MATCHED_ORIGINAL" if i < 9 else "UNMATCHED") for i in range(13)]
    t = spark.createDataFrame(rows, T_SCHEMA)
    dd = spark.createDataFrame([(dt.date(2026, 1, 31), "January", 1, "Q1-2026", 2026)], S.DATE_DIM)
    r = B.resolution_trend(t, dd).collect()[0]
    assert (r.total_trades, r.matched_trades, r.unmatched_trades) == (13, 9, 4)
    assert r.resolution_rate_pct == 69.2 and r.lost_exposure_pct == 30.8 and r.total_exposure_m == 13.0


def test_exposure_before_after(spark, base):
    dim = spark.createDataFrame([("AAA", "Alpha Bank", "P", "SEC", _d(12), "x"),
                                 ("BBB", "Beta Holdings", "Q", "EMIR", _d(30), "y")], S.COUNTERPARTY)
    before = {r.canonical_name: r.exposure for r in C.exposure_by_counterparty(base, dim).collect()}
    after = {r.canonical_name: r.exposure for r in C.exposure_by_counterparty(base, dim, B.MATCHED).collect()}
    assert before == {"Alpha Bank": _d("10.00"), "Beta Holdings": _d("7.00")}
    assert after["Alpha Bank"] == _d("15.00")


def test_breach_boundaries(spark):
    import datetime as dt
    known = spark.createDataFrame([("A", dt.date(2026, 4, 30), _d(100)), ("B", dt.date(2026, 4, 30), _d(100)),
                                   ("C", dt.date(2026, 4, 30), _d(150)), ("N", dt.date(2026, 4, 30), _d(999))],
                                  "counterparty_code string, as_of_date date, known_exposure decimal(38,2)")
    hidden = spark.createDataFrame([("A", dt.date(2026, 4, 30), _d(0), 1, 1), ("B", dt.date(2026, 4, 30), _d(1), 1, 1)],
                                   "counterparty_code string, as_of_date date, hidden_exposure decimal(38,2), "
                                   "variant_count long, source_system_count long")
    dim = spark.createDataFrame([("A", "a", _d(100)), ("B", "b", _d(100)), ("C", "c", _d(100)), ("N", "n", None)],
                                "counterparty_code string, counterparty_legal_name string, threshold_principal decimal(18,2)")
    le = spark.createDataFrame([(c, "P", False) for c in "ABCN"],
                               "counterparty_code string, ultimate_parent_name string, is_ultimate_parent boolean")
    got = {r.counterparty_code: (r.status_before_resolution, r.resolution_impact)
           for r in C.true_exposure_summary(known, hidden, dim, le).collect()}
    assert got["A"] == ("Within Threshold", "NO CHANGE")        # equal to threshold is no breach
    assert got["B"] == ("Within Threshold", "NEW BREACH DETECTED")
    assert got["C"] == ("BREACH", "BREACH WORSENED")            # worsened needs no hidden exposure
    assert got["N"] == ("Within Threshold", "NO CHANGE")        # NULL threshold falls to ELSE


def test_hidden_exposure_counts_variant_systems(spark):
    import datetime as dt
    d = dt.date(2026, 4, 30)
    an = spark.createDataFrame([("A1", "V2", "AAA", d, _d(15.2)), ("A2", "V3", "AAA", d, _d(10)),
                                ("A3", "V3", "AAA", d, _d(1))],
                               "anomaly_id string, variant_id string, counterparty_code string, as_of_date date, "
                               "base_total_exposure decimal(18,2)")
    v = spark.createDataFrame([("V2", "SUMMIT"), ("V3", "EXCEL")], "variant_id string, source_system string")
    r = C.hidden_exposure(an, v).collect()[0]
    assert (r.hidden_exposure, r.variant_count, r.source_system_count) == (_d("26.20"), 2, 2)


def test_margin_call_rows_obey_rules(spark):
    rows = [(_d(33.2), _d(37.5), _d(-4.3), _d(23.2), _d(23.2), _d(10), None, False),
            (_d(44.8), _d(50.1), _d(-5.3), _d(34.8), _d(32.0), _d(10), _d(2.8), True),
            (_d(5), _d(6), _d(-1), None, None, _d(10), None, False)]
    df = spark.createDataFrame(rows, "base_total_exposure decimal(18,2), itm_exposure decimal(18,2), "
                               "otm_exposure decimal(18,2), base_call_amount decimal(18,2), agreed_amount decimal(18,2), "
                               "threshold_principal decimal(18,2), dispute_amount decimal(18,2), is_disputed boolean")
    r = C.margin_call_check(df).collect()[0]
    assert r.rows_checked == 3 and r.exposure_split_breaks == 0 and r.call_amount_breaks == 0
    assert r.dispute_amount_breaks == 0 and r.dispute_flag_breaks == 0


def test_aggregate_then_join_stops_doubled_sum(spark):
    exp = spark.createDataFrame([("cp", "1Y", 4.0)], "cp string, tenor string, exposure double")
    sens = spark.createDataFrame([("cp", "1Y", 1.0), ("cp", "1Y", 2.0)], "cp string, tenor string, delta double")
    naive = exp.join(sens, ["cp", "tenor"]).agg(F.sum("exposure")).collect()[0][0]
    safe = D.aggregate_then_join([(exp, {"exposure": F.sum("exposure")}), (sens, {"delta": F.sum("delta")})],
                                 ["cp", "tenor"]).collect()[0]
    assert naive == 8.0 and safe.exposure == 4.0 and safe.delta == 3.0


def test_star_join_refuses_duplicate_dimension_keys(spark, base):
    dim = spark.createDataFrame([("AAA", "x"), ("AAA", "y")], "counterparty_code string, name string")
    with pytest.raises(ValueError):
        D.star_join(base, [(dim, "counterparty_code", "left")])


def test_orphan_keys_reports_nulls_apart(spark, base):
    dim = spark.createDataFrame([("AAA",)], "counterparty_code string")
    got = sorted((r.trade_id, r.reason) for r in D.orphan_keys(base, dim, "counterparty_code").collect())
    assert got == [("T3", "NULL_KEY"), ("T4", "NULL_KEY"), ("T5", "NOT_IN_DIMENSION")]


def test_check_constraints_null_passes(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "x double")
    got = {r.check_name: r.failed_rows for r in Q.check_constraints(df, {"non_negative": "x >= 0"}).collect()}
    assert got == {"non_negative": 1}


def test_row_count_band_counts_empty_day(spark):
    import datetime as dt
    rows = [("p", dt.datetime(2024, 1, 1, 9))] * 10 + [("p", dt.datetime(2024, 1, 3, 9))] * 10
    df = spark.createDataFrame(rows, "product_id string, load_time timestamp")
    got = [(r.business_date.day, r.row_count, r.verdict)
           for r in Q.row_count_band(df, "load_time", ["product_id"]).orderBy("business_date").collect()]
    assert got == [(1, 10, None), (2, 0, "OUT_OF_BAND"), (3, 10, "OUT_OF_BAND")]


def test_quarantine_split(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "id int, x double")
    good, bad = Q.quarantine_split(df, {"pos": "x > 0", "small": "x < 3"})
    assert sorted(r.id for r in good.collect()) == [3]
    assert {r.id: r.failed_rules for r in bad.collect()} == {1: ["small"], 2: ["pos"]}


def test_apply_schema_rejects_bad_values(spark):
    df = spark.createDataFrame([("1", "2026-01-31", "12.345")], "a string, d string, m string")
    from pyspark.sql.types import DateType, DecimalType, IntegerType, StructField, StructType
    schema = StructType([StructField("a", IntegerType()), StructField("d", DateType()),
                         StructField("m", DecimalType(18, 2))])
    r = A.apply_schema(df, schema).collect()[0]
    assert r.a == 1 and str(r.d) == "2026-01-31" and r.m == _d("12.35")
    bad = spark.createDataFrame([("x", "2026-01-31", "1")], "a string, d string, m string")
    with pytest.raises(Exception):
        A.apply_schema(bad, schema).collect()


def test_materialize_if_absent_keeps_old_rows(spark, tmp_path):
    p = str(tmp_path / "t")
    A.materialize(spark.range(3), p)
    A.materialize(spark.range(10), p)
    assert spark.read.parquet(p).count() == 3
    A.materialize(spark.range(10), p, if_absent=False)
    assert spark.read.parquet(p).count() == 10


def test_interpolation_flat_outside(spark):
    q = spark.createDataFrame([("c", 1.0, 80.0), ("c", 3.0, 90.0), ("c", 5.0, 100.0), ("c", 10.0, 130.0)],
                              S.CURVE_QUOTES)
    pts = spark.createDataFrame([("c", 7.0), ("c", 0.5), ("c", 12.0), ("c", 3.0)], "curve_id string, tenor_y double")
    got = {r.tenor_y: r.spread_bp for r in H.interpolate_curve(pts, q).collect()}
    assert got[7.0] == pytest.approx(112.0) and got[0.5] == 80.0 and got[12.0] == 130.0 and got[3.0] == 90.0


def test_survival_from_spread(spark):
    q = spark.createDataFrame([("c", 5.0, 100.0)], S.CURVE_QUOTES)
    r = H.survival_curve(q, 0.4).collect()[0]
    assert r.hazard == pytest.approx(0.016667, abs=1e-6) and r.survival == pytest.approx(0.92, abs=1e-4)


def test_cs01_and_net_sensitivity(spark):
    v = spark.createDataFrame([("bond", "base", 1000000.0), ("bond", "cs_1bp", 999800.0),
                               ("cds", "base", 50000.0), ("cds", "cs_1bp", 50220.0)],
                              "trade_id string, scenario string, pv double")
    got = {r.trade_id: r.cs01 for r in H.cs01(v).collect()}
    assert got == {"bond": pytest.approx(-200.0), "cds": pytest.approx(220.0)}
    s = spark.createDataFrame([("bond", "cp", 5.0, -200.0), ("cds", "cp", 5.0, 220.0)],
                              "trade_id string, counterparty_code string, tenor_y double, cs01 double")
    assert H.aggregate_sensitivity(s, ["counterparty_code"]).collect()[0].net_cs01 == pytest.approx(20.0)


def test_netting_then_floor(spark):
    v = spark.createDataFrame([("ns", "t1", "base", 0, 1.0, _d(1050000)), ("ns", "t2", "base", 0, 1.0, _d(-800000)),
                               ("ns2", "t1", "base", 0, 1.0, _d(-1050000)), ("ns2", "t2", "base", 0, 1.0, _d(800000))],
                              S.PATH_VALUES)
    got = {r.netting_set: r.exposure for r in H.net_exposure(v).collect()}
    assert got == {"ns": _d("250000.00"), "ns2": _d("0.00")}


def test_exposure_profile_zero_fills_missing_paths(spark):
    rows = [("ns", "t", "base", p, 1.0, _d(v)) for p, v in enumerate([10, 20, 30, 40])]
    prof = H.exposure_profile(H.net_exposure(spark.createDataFrame(rows, S.PATH_VALUES)), n_paths=5, level=0.5)
    r = prof.collect()[0]
    assert r.ee == pytest.approx(20.0)       # (10+20+30+40+0)/5
    assert r.pfe == pytest.approx(20.0)      # median of 0,10,20,30,40
    assert r.peak_pfe == r.pfe


def test_cva_worked_example(spark):
    prof = spark.createDataFrame([("ns", "c", 1.0, 300000.0), ("ns", "c", 3.0, 500000.0), ("ns", "c", 5.0, 700000.0)],
                                 "netting_set string, curve_id string, time_y double, ee double")
    dpd = spark.createDataFrame([("c", 1.0, 0.0167), ("c", 3.0, 0.03), ("c", 5.0, 0.03)],
                                "curve_id string, tenor_y double, dpd double")
    undisc = H.cva(prof, dpd, lgd=0.6, risk_free=0.0).collect()[0].cva
    assert undisc == pytest.approx(3006 + 9000 + 12600)
    disc = H.cva(prof, dpd, lgd=0.6, risk_free=0.04).collect()[0].cva
    assert disc == pytest.approx(21248, abs=2)


def test_weighted_sensitivity(spark):
    s = spark.createDataFrame([("c", 1.0, 20.0)], "curve_id string, tenor_y double, cs01 double")
    w = spark.createDataFrame([("0-1Y", 0.10)], "tenor_bucket string, risk_weight double")
    r = H.weighted_capital(s, w, rho=0.5).collect()[0]
    assert r.ws_total == pytest.approx(2.0) and r.bucket_capital == pytest.approx(2.0)


def test_weighted_capital_closed_form_matches_pairs(spark):
    vals = [("c", 0.5, 10.0), ("c", 3.0, -4.0), ("c", 7.0, 6.0), ("c", 20.0, 1.0)]
    s = spark.createDataFrame(vals, "curve_id string, tenor_y double, cs01 double")
    w = spark.createDataFrame([("0-1Y", 0.1), ("1-5Y", 0.2), ("5-10Y", 0.3), ("10Y+", 0.4)],
                              "tenor_bucket string, risk_weight double")
    ws = [10 * 0.1, -4 * 0.2, 6 * 0.3, 1 * 0.4]
    rho = 0.3
    k2 = sum(a * b * (1.0 if i == j else rho) for i, a in enumerate(ws) for j, b in enumerate(ws))
    assert H.weighted_capital(s, w, rho).collect()[0].bucket_capital == pytest.approx(k2 ** 0.5)


def test_quarantine_write_splits_in_one_pass(spark, tmp_path):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "id int, x double")
    p = str(tmp_path / "q")
    Q.quarantine_write(df, {"pos": "x > 0", "small": "x < 3"}, p)
    back = spark.read.parquet(p)
    good = sorted(r.id for r in back.filter("quarantine = 'good'").collect())
    bad = {r.id: r.failed_rules for r in back.filter("quarantine = 'bad'").collect()}
    assert good == [3] and bad == {1: ["small"], 2: ["pos"]}


def test_bond_pv_at_risk_free_plus_spread(spark):
    # 5y annual 5% bond, flat 100 bp spread over 4% -> discounted at 5% -> par
    cf = spark.createDataFrame([("bond", "c", float(t), _d(105 if t == 5 else 5)) for t in range(1, 6)],
                               "trade_id string, curve_id string, time_y double, amount decimal(18,2)")
    q = spark.createDataFrame([("c", 1.0, 100.0), ("c", 10.0, 100.0)], S.CURVE_QUOTES)
    assert H.discounted_pv(cf, q, risk_free=0.04).collect()[0].pv == pytest.approx(100.0, abs=1e-9)


def test_cds_at_its_own_spread_is_near_zero(spark):
    q = spark.createDataFrame([("c", 1.0, 100.0), ("c", 5.0, 100.0)], S.CURVE_QUOTES)
    r = H.cds_legs(q, maturity=5, recovery=0.4, risk_free=0.04).collect()[0]
    assert r.premium_leg > 0 and r.protection_leg > 0
    assert abs(r.buyer_value) < 0.05 * r.premium_leg


def test_stressed_pfe_side_by_side(spark):
    prof = spark.createDataFrame([("ns", "base", 1.0, 10.0, 20.0, 0.95), ("ns", "stressed", 1.0, 15.0, 35.0, 0.95)],
                                 "netting_set string, scenario string, time_y double, ee double, pfe double, "
                                 "level double")
    r = H.stressed_pfe(prof, "2026-04-30").collect()[0]
    assert (r.base_pfe, r.stressed_pfe, r.pfe_increase, str(r.valuation_date)) == (20.0, 35.0, 15.0, "2026-04-30")


def test_exposure_trend_labels(spark):
    import datetime as dt
    rows = [("A", dt.date(2026, 4, d), _d(x)) for d, x in ((15, 33.2), (30, 44.8))] + \
           [("A", dt.date(2026, 5, 15), _d(38.6)), ("A", dt.date(2026, 5, 30), _d(38.6))]
    df = spark.createDataFrame(rows, "counterparty_code string, as_of_date date, base_total_exposure decimal(18,2)")
    got = [r.direction for r in C.exposure_trend(df).orderBy("as_of_date").collect()]
    assert got == [None, "UP", "DOWN", "FLAT"]


def test_fanout_and_reconcile(spark):
    a = spark.createDataFrame([(1, _d(10)), (2, _d(5)), (3, _d(7))], "order_id int, amount decimal(18,2)")
    b = spark.createDataFrame([(1, _d(4)), (1, _d(6)), (2, _d(4)), (4, _d(1))], "order_id int, amount decimal(18,2)")
    f = {r.order_id: (r.right_rows, r.joined_rows) for r in D.fanout_check(a, b, ["order_id"]).collect()}
    assert f == {1: (2, 2)}
    t = D.fanout_total(a, b, ["order_id"]).collect()[0]
    assert (t.left_rows, t.joined_rows, t.multiplying_keys) == (3, 3, 1)
    st = {r.order_id: r.status for r in D.reconcile(a, b, ["order_id"], "amount", 0.5).collect()}
    assert st == {1: "EQUAL", 2: "DIFFERS", 3: "ONLY_IN_A", 4: "ONLY_IN_B"}


def test_currency_conversion_missing_rate(spark):
    import datetime as dt
    d = dt.date(2026, 4, 30)
    df = spark.createDataFrame([("USD", d, _d(100)), ("CAD", d, _d(100)), ("EUR", d, _d(100))],
                               "ccy string, business_date date, amount decimal(18,2)")
    fx = spark.createDataFrame([("CAD", d, _d("0.7300"))], "currency string, business_date date, rate decimal(10,4)")
    got = {r.ccy: (r.amount_reporting, r.fx_missing)
           for r in A.convert_currency(df, fx, "amount", "ccy", "business_date", "USD").collect()}
    assert got["USD"] == (_d("100.000000"), False)
    assert got["CAD"] == (_d("73.000000"), False)
    assert got["EUR"] == (None, True)
