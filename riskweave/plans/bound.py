"""Operators bound to the shared tables: the registered queries.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame that reads whole
tables; lazy but for ``star_join`` and ``safe_join`` (uniqueness checks), ``cva`` and
``cva_cs01`` (the profile is written once), ``inherit_classification`` (a loop to the
fixpoint) and ``materialize`` (a write), which run jobs when called. Parameters (search terms, statuses, dates) are fixed values of
the query, not row caps.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checksum as S
from ..operators import clustering as K
from ..operators import exposure as C
from ..operators import hierarchy as T
from ..operators import incremental as I
from ..operators import matching as M
from ..operators import quality as Q
from ..operators import resolution as B
from ..operators import versions as V
from ..sources import bindings as bd
from ..session import ensure_checkpoint_dir, write_scratch
from ..sources.tables import read_table
from .joins import grown

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Source asset codes (order priorities) to the core liquidity taxonomy.
# '5-LOW' is left unmapped on purpose.
ASSET_TAXONOMY = [
    ("SRC", "1-URGENT", "HQLA_L1"),
    ("SRC", "2-HIGH", "HQLA_L1"),
    ("SRC", "3-MEDIUM", "HQLA_L2A"),
    ("SRC", "4-NOT SPECIFIED", "HQLA_L2B"),
]


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# ---- B: entity resolution ----------------------------------------------------

@query("entity_search")
def q_entity_search(spark, d):
    return B.entity_search(bd.counterparty(spark, d), "furniture")


def _name_rules(spark, d):
    """Analyst rules: the booked spelling of BUILDING-segment customers' unmatched trades."""
    c = read_table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return c.select(F.concat(F.upper("c_name"), F.lit(" LTD")).alias("booked_name"),
                    F.col("c_custkey").cast("string").alias("counterparty_code"))


@query("resolve_by_name")
def q_resolve_by_name(spark, d):
    return B.resolve_by_name(bd.trades(spark, d), _name_rules(spark, d))


def _id_rules(spark, d):
    o = read_table(spark, d, "orders").filter(
        (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"))
    return o.select(F.col("o_orderkey").cast("string").alias("trade_id"),
                    F.col("o_custkey").cast("string").alias("counterparty_code"))


@query("resolve_by_id")
def q_resolve_by_id(spark, d):
    return B.resolve_by_id(bd.trades(spark, d), _id_rules(spark, d))


def _reset_ids(spark, d):
    o = read_table(spark, d, "orders").filter(
        (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW"))
    return o.select(F.col("o_orderkey").cast("string").alias("trade_id"))


@query("reset_resolution")
def q_reset_resolution(spark, d):
    return B.reset_resolution(bd.trades(spark, d), _reset_ids(spark, d))


@query("reset_then_resolve_breakdown")
def q_reset_then_resolve(spark, d):
    """B4 then B3 on the same ids restores the status totals."""
    t = bd.trades(spark, d)
    ids = _reset_ids(spark, d)
    o = read_table(spark, d, "orders").filter(
        (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW"))
    rules = o.select(F.col("o_orderkey").cast("string").alias("trade_id"),
                     F.col("o_custkey").cast("string").alias("counterparty_code"))
    return B.resolution_breakdown(B.resolve_by_id(B.reset_resolution(t, ids), rules))


@query("extend_search_text")
def q_extend_search_text(spark, d):
    t = bd.trades(spark, d)
    o = read_table(spark, d, "orders").filter(F.col("o_orderstatus") == "P")
    adds = (o.join(t.select("trade_id", "booked_name"),
                   o.o_orderkey.cast("string") == F.col("trade_id"))
             .select(F.col("o_custkey").cast("string").alias("counterparty_code"),
                     F.col("booked_name").alias("text")))
    return B.extend_search_text(bd.counterparty(spark, d), adds)


@query("resolve_by_variant")
def q_resolve_by_variant(spark, d):
    return B.resolve_by_variant(bd.trades(spark, d), bd.name_variants(spark, d))


@query("resolve_by_key")
def q_resolve_by_key(spark, d):
    return B.resolve_by_key(bd.trades(spark, d), bd.name_variants(spark, d))


@query("fuzzy_candidates")
def q_fuzzy_candidates(spark, d):
    """Unmatched booked names with and without spelling slips against all variant
    spellings; a name without a candidate is listed with distance NULL."""
    names = bd.misspelt_names(spark, d)
    found = B.fuzzy_candidates(names, bd.name_variants(spark, d), max_distance=1, k=1)
    return names.distinct().join(grown(found), "booked_name", "left")


@query("exceptions_queue")
def q_exceptions_queue(spark, d):
    return B.exceptions_queue(bd.trades(spark, d))


@query("unmatched_by_name")
def q_unmatched_by_name(spark, d):
    return B.unmatched_by_name(bd.trades(spark, d))


@query("resolution_breakdown")
def q_resolution_breakdown(spark, d):
    return B.resolution_breakdown(bd.trades(spark, d, names=False))


@query("resolution_breakdown_after_rules")
def q_breakdown_after(spark, d):
    return B.resolution_breakdown(B.resolve_by_name(bd.trades(spark, d), _name_rules(spark, d)))


@query("resolution_trend")
def q_resolution_trend(spark, d):
    return B.resolution_trend(bd.trades(spark, d, names=False), bd.date_dim(spark, d))


@query("parent_lookup")
def q_parent_lookup(spark, d):
    t = bd.trades(spark, d, names=False).filter(F.col("counterparty_code").isNotNull())
    return B.parent_lookup(t.select("trade_id", "counterparty_code", "exposure_amount"),
                           bd.legal_entity(spark, d, listed=True))


@query("parent_rollup")
def q_parent_rollup(spark, d):
    t = bd.trades(spark, d, names=False).filter(F.col("resolution_status").isin(*B.MATCHED))
    return B.parent_rollup(t, bd.legal_entity(spark, d, listed=True))


def _canonical_issuers(spark, d):
    return bd.issuer_variants(spark, d).filter("is_canonical").withColumnRenamed("variant_name", "canonical_name")


@query("similar_names")
def q_similar_names(spark, d):
    """Booked issuer names and the canonical names that hold 80 % of the lighter one's weight."""
    return M.similar_names(bd.issuer_bookings(spark, d), _canonical_issuers(spark, d), 0.8, "overlap")


@query("similar_names_jaccard")
def q_similar_names_jaccard(spark, d):
    return M.similar_names(bd.issuer_bookings(spark, d), _canonical_issuers(spark, d), 0.6, "jaccard")


@query("abbreviation_matches")
def q_abbreviation_matches(spark, d):
    return M.abbreviation_matches(bd.issuer_bookings(spark, d), bd.issuer_variants(spark, d))


def _name_links(spark, d):
    """Links of booked names to canonical ones, and to each other, by how much they share."""
    booked, canon = bd.issuer_bookings(spark, d).select("booked_name"), _canonical_issuers(spark, d)
    near = M.similar_names(booked, canon, 0.5, "overlap").select(F.col("booked_name").alias("a"), F.col("canonical_name").alias("b"), F.col("similarity").alias("weight"))
    same = M.similar_names(booked, booked.withColumnRenamed("booked_name", "name"), 0.5, "jaccard", name="name").filter("booked_name < name")
    return near, same.select(F.col("booked_name").alias("a"), F.col("name").alias("b"), F.col("similarity").alias("weight"))


def _record_links(spark, d):
    near, same = _name_links(spark, d)
    return near.unionByName(same)


@query("cluster_records")
def q_cluster_records(spark, d):
    """Booked and canonical issuer names as clusters of one canonical name at most."""
    near, same = _name_links(spark, d)
    links = write_scratch(K.strongest_to_names(near).unionByName(same), "record-links")
    return K.cluster_records(links, _canonical_issuers(spark, d).select(F.col("canonical_name").alias("record")))


@query("as_of_join")
def q_as_of_join(spark, d):
    """The margin rule in force when each trade was booked."""
    return V.as_of_join(bd.trades_dated(spark, d), bd.rule_versions(spark, d), ["counterparty_code"], "booked_on", ["rule"], valid_to="valid_to")


@query("resolve_names")
def q_resolve_names(spark, d):
    """Every booked name through the rules in order, with its bookings and their amount."""
    b = bd.issuer_bookings(spark, d)
    per = b.groupBy("booked_name").agg(F.count("*").alias("bookings"), F.sum("exposure_amount").cast("decimal(38,2)").alias("exposure"))
    return per.join(grown(M.resolve_names(b, bd.issuer_variants(spark, d))), "booked_name")


@query("ownership_closure")
def q_ownership_closure(spark, d):
    return T.ownership_closure(bd.ownership_edges(spark, d))


@query("consolidated_exposure")
def q_consolidated_exposure(spark, d):
    return T.consolidated_exposure(bd.entity_amounts(spark, d), bd.ownership_edges(spark, d))


# ---- C: exposure and breaches -------------------------------------------------

@query("exposure_before_resolution")
def q_exposure_before(spark, d):
    return C.exposure_by_counterparty(bd.trades(spark, d, names=False), bd.counterparty(spark, d),
                                      (B.MATCHED_ORIGINAL,), "before_resolution_exposure")


@query("exposure_after_resolution")
def q_exposure_after(spark, d):
    return C.exposure_by_counterparty(bd.trades(spark, d, names=False), bd.counterparty(spark, d),
                                      B.MATCHED, "after_resolution_exposure")


@query("known_exposure")
def q_known_exposure(spark, d):
    return C.known_exposure(bd.known_exposure_fact(spark, d))


@query("hidden_exposure")
def q_hidden_exposure(spark, d):
    return C.hidden_exposure(bd.anomaly_exposure(spark, d), bd.name_variants(spark, d))


def _summary(spark, d):
    return C.true_exposure_summary(
        C.known_exposure(bd.known_exposure_fact(spark, d)),
        C.hidden_exposure(bd.anomaly_exposure(spark, d), bd.name_variants(spark, d)),
        bd.counterparty_legal(spark, d), bd.legal_entity(spark, d, listed=True))


@query("true_exposure_summary")
def q_true_exposure_summary(spark, d):
    return _summary(spark, d)


@query("resolution_impact_counts")
def q_resolution_impact_counts(spark, d):
    return _summary(spark, d).groupBy("resolution_impact").agg(F.count("*").alias("row_count"))


@query("breach_alerts")
def q_breach_alerts(spark, d):
    return C.breach_alerts(_summary(spark, d))


@query("incremental_true_exposure")
def q_incremental_true_exposure(spark, d):
    """C4 after three change sets (late facts, code changes, resets) on a stored summary."""
    store = I.ExposureStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/true-exposure-{uuid.uuid4().hex}", buckets=4)
    dims = bd.name_variants(spark, d), bd.counterparty_legal(spark, d), bd.legal_entity(spark, d, listed=True)
    (_, load), *changes = bd.exposure_change_sets(spark, d)
    store.refresh_summary(*dims, store.create(I.exposure_entries(*load)))
    for number, (before, after) in enumerate(changes, 1):
        images = [I.exposure_entries(*x) if any(p is not None for p in x) else None for x in (before, after)]
        store.refresh(I.change_set(*images), number, *dims)
    return store.summary()


@query("row_counts")
def q_row_counts(spark, d):
    return C.row_counts({"counterparty": bd.counterparty(spark, d), "date": bd.date_dim(spark, d),
                         "trades": bd.trades(spark, d), "legal_entity": bd.legal_entity(spark, d),
                         "name_variants": bd.name_variants(spark, d),
                         "anomaly_exposure": bd.anomaly_exposure(spark, d)})


@query("limit_utilisation")
def q_limit_utilisation(spark, d):
    t = bd.trades(spark, d, names=False).filter(F.col("resolution_status").isin(*B.MATCHED))
    return C.limit_utilisation(t, bd.facility_limits(spark, d))


@query("exposure_trend")
def q_exposure_trend(spark, d):
    return C.exposure_trend(bd.known_exposure_fact(spark, d))


@query("margin_call_check")
def q_margin_call_check(spark, d):
    return C.margin_call_check(bd.reported_margin(spark, d))


@query("collateral_value")
def q_collateral_value(spark, d):
    return C.collateral_value(bd.positions(spark, d))


def _encumbrance(spark, d):
    taxonomy = spark.createDataFrame(ASSET_TAXONOMY, "source_system string, source_code string, core_code string")
    return C.encumbrance_view(bd.liquidity_buffer(spark, d), bd.pledged_collateral(spark, d),
                              bd.fx_rates(spark, d), reporting_currency="NATION_0", taxonomy=taxonomy)


@query("encumbrance_view")
def q_encumbrance_view(spark, d):
    return _encumbrance(spark, d)


ENCUMBRANCE_CHECKS = {
    "amounts_non_negative": "buffer_amount >= 0 AND pledged_amount >= 0",
    "pledged_within_buffer": "pledged_amount <= buffer_amount",
    "reporting_rate_present": "NOT fx_missing",
}


@query("encumbrance_checks")
def q_encumbrance_checks(spark, d):
    """F1 on C12: the contract's checks on the encumbrance view, one pass."""
    return Q.check_constraints(_encumbrance(spark, d), ENCUMBRANCE_CHECKS)


# ---- A: load and conform ----------------------------------------------------------

from pyspark.sql.types import (DateType, DecimalType, LongType, StringType,  # noqa: E402
                               StructField, StructType)

from ..operators import load as A  # noqa: E402
from ..operators import star as D  # noqa: E402

ORDER_SCHEMA = StructType([
    StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
    StructField("o_orderstatus", StringType()), StructField("o_totalprice", DecimalType(18, 2)),
    StructField("o_orderdate", DateType()), StructField("o_orderpriority", StringType())])

PARTY_MAPS = {
    "crm": {"c_custkey": "party_id", "c_name": "party_name", "c_nationkey": "nation_id",
            "c_acctbal": "balance"},
    "erp": {"s_suppkey": "party_id", "s_name": "party_name", "s_nationkey": "nation_id",
            "s_acctbal": "balance"},
}



@query("apply_schema")
def q_apply_schema(spark, d):
    raw = read_table(spark, d, "orders")
    landed = raw.select(*[F.col(f.name).cast("string").alias(f.name) for f in ORDER_SCHEMA.fields])
    return A.apply_schema(landed, ORDER_SCHEMA)


@query("append_rows")
def q_append_rows(spark, d):
    t = bd.trades(spark, d)
    return A.append_rows(t.filter(F.col("resolution_status") != B.UNMATCHED),
                         t.filter(F.col("resolution_status") == B.UNMATCHED), by="name")


@query("append_rows_by_position")
def q_append_rows_by_position(spark, d):
    """Suppliers under the customers' columns, matched by position."""
    c = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    s = read_table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return A.append_rows(c, s, by="position")


@query("materialize")
def q_materialize(spark, d):
    """Exposure per status written once, and read back; a second write leaves it as it is."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/status-totals-{uuid.uuid4().hex}"
    totals = B.resolution_breakdown(bd.trades(spark, d, names=False))
    A.materialize(totals, path)
    A.materialize(totals.limit(0), path)
    return spark.read.parquet(path)


@query("conform_columns")
def q_conform_columns(spark, d):
    df, _unmapped = A.conform_columns(read_table(spark, d, "customer"), PARTY_MAPS["crm"])
    return df


@query("conform_union")
def q_conform_union(spark, d):
    return A.conform_union({"crm": read_table(spark, d, "customer"),
                            "erp": read_table(spark, d, "supplier")}, PARTY_MAPS, keep_unmapped=False)


MARGIN_CHECKS = {
    "exposure_below_400k": "base_total_exposure < 400000",
    "call_fully_agreed": "agreed_amount = base_call_amount",
}


def _quarantine(spark, d):
    m = bd.collateral_exposure(spark, d).select(
        "event_id", "counterparty_code", "base_total_exposure", "base_call_amount", "agreed_amount")
    return Q.quarantine_split(m, MARGIN_CHECKS)


@query("quarantine_good")
def q_quarantine_good(spark, d):
    return _quarantine(spark, d)[0]


@query("quarantine_bad")
def q_quarantine_bad(spark, d):
    bad = _quarantine(spark, d)[1]
    return bad.withColumn("failed_rules", F.array_join("failed_rules", ","))


@query("convert_currency")
def q_convert_currency(spark, d):
    return A.convert_currency(bd.liquidity_buffer(spark, d), bd.fx_rates(spark, d), "amount",
                              "currency", "business_date", reporting="NATION_0")


@query("conform_values")
def q_conform_values(spark, d):
    mapping = spark.createDataFrame(ASSET_TAXONOMY, "source_system string, source_code string, core_code string")
    return A.conform_values(bd.pledged_collateral(spark, d), "asset_code", mapping, "source_system")


# ---- D: star schema and safe combination ------------------------------------------

@query("star_join")
def q_star_join(spark, d):
    dims = [(bd.counterparty(spark, d).select("counterparty_code", "canonical_name", "regulatory_regime"),
             "counterparty_code", "left"),
            (bd.date_dim(spark, d).select("trade_date", "month_name"), "trade_date", "inner")]
    return D.star_join(bd.trades(spark, d), dims,
                       ["canonical_name", "regulatory_regime", "month_name"])


def _sales_parts(spark, d):
    return [(bd.sales_a(spark, d), {"amount_a": F.sum("amount").cast("decimal(38,2)")}),
            (bd.sales_b(spark, d), {"amount_b": F.sum("amount").cast("decimal(38,2)"),
                                    "lines": F.count("*")})]


@query("aggregate_then_join")
def q_aggregate_then_join(spark, d):
    return D.aggregate_then_join(_sales_parts(spark, d), ["order_id"])


@query("grain_check")
def q_grain_check(spark, d):
    return D.grain_check(bd.trades(spark, d, names=False), ["counterparty_code", "trade_date"])


@query("fanout_check")
def q_fanout_check(spark, d):
    return D.fanout_check(bd.sales_a(spark, d), bd.sales_b(spark, d), ["order_id"])


@query("fanout_total")
def q_fanout_total(spark, d):
    return D.fanout_total(bd.sales_a(spark, d), bd.sales_b(spark, d), ["order_id"])


@query("orphan_keys")
def q_orphan_keys(spark, d):
    return D.orphan_keys(bd.sales_a(spark, d), bd.sales_b(spark, d), "order_id")


@query("flat_daily_fact")
def q_flat_daily_fact(spark, d):
    t = bd.trades(spark, d, names=False).withColumnRenamed("trade_date", "business_date")
    p = (bd.positions(spark, d).withColumnRenamed("agreement_id", "counterparty_code")
         .withColumn("business_date", F.last_day("as_of_date")))
    m = bd.collateral_exposure(spark, d).withColumn("business_date", F.last_day("as_of_date"))
    facts = [(t, {"exposure": F.sum("exposure_amount").cast("decimal(38,2)"), "trades": F.count("*")}),
             (m, {"call_amount": F.sum("base_call_amount").cast("decimal(38,2)"),
                  "calls": F.count("base_call_amount")}),
             (p, {"market_value": F.sum("market_value").cast("decimal(38,2)"), "positions": F.count("*")})]
    dims = [(bd.counterparty(spark, d).select("counterparty_code", "canonical_name", "regulatory_regime"),
             "counterparty_code"),
            (bd.date_dim(spark, d).select(F.col("trade_date").alias("business_date"), "quarter_name"),
             "business_date")]
    return D.flat_daily_fact(facts, ["counterparty_code", "business_date"], dims)


@query("reconcile")
def q_reconcile(spark, d):
    return D.reconcile(bd.line_amounts(spark, d, ("A", "N")), bd.line_amounts(spark, d, ("N", "R")),
                       ["order_id"], "amount", 0.01)


@query("reconcile_summary")
def q_reconcile_summary(spark, d):
    r = q_reconcile(spark, d)
    return r.groupBy("status").agg(F.count("*").alias("row_count"))


@query("reconcile_by_checksum")
def q_reconcile_by_checksum(spark, d):
    """Line amounts against what another system reports, comparing only key ranges that differ."""
    return S.reconcile_by_checksum(bd.sales_b(spark, d), bd.sales_a_reported(spark, d), ["order_id"], "amount")


# ---- F: quality and freshness --------------------------------------------------------

POSITION_CHECKS = {
    "market_value_non_negative": "market_value >= 0",
    "haircut_in_range": "haircut >= 0 AND haircut <= 0.1",
    "haircut_below_5pct": "haircut < 0.05",
}


@query("check_constraints")
def q_check_constraints(spark, d):
    return Q.check_constraints(bd.positions(spark, d), POSITION_CHECKS)


@query("row_count_band")
def q_row_count_band(spark, d):
    return Q.row_count_band(bd.loads_listed(spark, d), "load_time", by=["product_id"], pct=10.0, as_of=LOADS_AS_OF)


LOADS_AS_OF = "2024-02-02"   # three business days after the last load


@query("freshness")
def q_freshness(spark, d):
    f = Q.freshness(bd.loads_listed(spark, d), as_of=LOADS_AS_OF)
    return f.select("product_id", "business_date", "last_load_seconds", "loads", "status")


# ---- H: risk measures --------------------------------------------------------------

from ..operators import allocation as L  # noqa: E402
from ..operators import risk as H  # noqa: E402
from ..operators import sketch as X  # noqa: E402

N_PATHS = 100            # paths per (netting set, scenario, time) in the path binding
PFE_LEVEL = 0.95
VALUATION_DATE = "2024-12-31"
# Risk weight per tenor bucket (10Y+ has none) and the correlations between buckets; some are listed twice.
RISK_WEIGHTS = [("0-1Y", 0.10), ("1-5Y", 0.08), ("5-10Y", 0.06), ("1-5Y", 0.08)]
BUCKET_RHO = [("0-1Y", "1-5Y", 0.8), ("0-1Y", "1-5Y", 0.8), ("1-5Y", "0-1Y", 0.8), ("1-5Y", "5-10Y", 0.7), ("5-10Y", "1-5Y", 0.7),
              ("0-1Y", "5-10Y", 0.5), ("5-10Y", "0-1Y", 0.5)]


def _r(c, n=6):
    return F.round(F.col(c), n).alias(c)


def _sens_points(spark, d):
    return bd.sensitivities(spark, d).select("curve_id", "tenor_y").distinct()


@query("interpolate_curve")
def q_interpolate_curve(spark, d):
    out = H.interpolate_curve(_sens_points(spark, d), bd.curve_quotes(spark, d))
    return out.select("curve_id", "tenor_y", _r("spread_bp"))


@query("shock_curve")
def q_shock_curve(spark, d):
    return H.shock_curve(bd.curve_quotes(spark, d))


@query("survival_curve")
def q_survival_curve(spark, d):
    s = H.survival_curve(bd.curve_quotes(spark, d), recovery=0.4)
    return s.select("curve_id", "tenor_y", "spread_bp", _r("hazard", 10), _r("survival", 10))


@query("incremental_pd")
def q_incremental_pd(spark, d):
    p = H.incremental_pd(H.survival_curve(bd.curve_quotes(spark, d), recovery=0.4))
    return p.select("curve_id", "tenor_y", _r("survival", 10), _r("dpd", 10))


@query("discounted_pv")
def q_discounted_pv(spark, d):
    pv = H.discounted_pv(bd.cashflows(spark, d), bd.curve_quotes(spark, d), risk_free=0.04)
    return pv.select("trade_id", _r("pv", 4), "flows_without_curve", _r("amount_without_curve", 2))


@query("cds_legs")
def q_cds_legs(spark, d):
    legs = H.cds_legs(bd.curve_quotes(spark, d), maturity=5, recovery=0.4, risk_free=0.04)
    return legs.select("curve_id", _r("premium_leg", 8), _r("protection_leg", 8), _r("buyer_value", 8))


@query("cs01")
def q_cs01(spark, d):
    """H7 over H5 under the base and +1bp curves (H2)."""
    shocked = H.shock_curve(bd.curve_quotes(spark, d)).drop("shift_bp")
    return H.cs01(H.discounted_pv(bd.cashflows(spark, d), shocked, risk_free=0.04, by=["scenario"])).select("trade_id", _r("base_value", 4), _r("shocked_value", 4), _r("cs01", 4))


# Fixed values of the query: stress sets as parts of the curves, with an added and a relative shift.
STRESS_SETS = [
    ("CREDIT_2008", None, None, 3.0, 120.0, 50.0), ("CREDIT_2008", None, 5.0, None, 60.0, 25.0),
    ("PANDEMIC_2020", None, None, None, 40.0, 20.0), ("PANDEMIC_2020", None, None, 1.0, 30.0, None),
    ("REGIONAL", "Brand#1", None, None, 200.0, None), ("REGIONAL", "Brand#2", 3.0, 5.0, None, 100.0), ("REGIONAL", "Brand#2", 5.0, None, 10.0, 10.0),
    ("TIGHTER", None, 1.0, 10.0, None, -30.0),
]


def _stress_sets(spark):
    return spark.createDataFrame(STRESS_SETS, "scenario string, curve_id string, tenor_from double, tenor_to double, shift_bp double, shift_pct double")


@query("stress_curves")
def q_stress_curves(spark, d):
    return H.stress_curves(bd.curve_quotes(spark, d), _stress_sets(spark)).select("curve_id", "tenor_y", "scenario", _r("spread_bp"), _r("shift_bp"))


@query("stressed_pv")
def q_stressed_pv(spark, d):
    """H5 under every stress set, against the quoted curves."""
    curves = H.stress_curves(bd.curve_quotes(spark, d), _stress_sets(spark)).drop("shift_bp")
    pv = H.discounted_pv(bd.cashflows(spark, d), curves, risk_free=0.04, by=["scenario"])
    v = H.stressed_values(pv.filter("scenario IS NOT NULL"))
    change = F.round("change", 4)
    return v.select("trade_id", "scenario", _r("stressed_value", 4), _r("base_value", 4), F.when(change == 0, F.lit(0.0)).otherwise(change).alias("change"))


@query("aggregate_sensitivity")
def q_aggregate_sensitivity(spark, d):
    return H.aggregate_sensitivity(bd.sensitivities(spark, d), ["counterparty_code", "curve_id", "tenor_bucket"])


@query("sensitivity_hierarchy")
def q_sensitivity_hierarchy(spark, d):
    return H.sensitivity_hierarchy(bd.sensitivities(spark, d), ["counterparty_code", "curve_id", "tenor_bucket"])


@query("net_exposure")
def q_net_exposure(spark, d):
    return H.net_exposure(bd.path_values(spark, d))


def _profile(spark, d):
    return H.exposure_profile(H.net_exposure(bd.path_values(spark, d)), N_PATHS, PFE_LEVEL)


@query("exposure_profile")
def q_exposure_profile(spark, d):
    return _profile(spark, d).select("netting_set", "scenario", "time_y", _r("ee", 4), _r("pfe", 4),
                                     "level", _r("peak_pfe", 4))


@query("stressed_pfe")
def q_stressed_pfe(spark, d):
    s = H.stressed_pfe(_profile(spark, d), VALUATION_DATE)
    return s.select("netting_set", "time_y", "level", _r("base_pfe", 4), _r("stressed_pfe", 4),
                    _r("base_ee", 4), _r("stressed_ee", 4), _r("base_mtm", 4), _r("stressed_mtm", 4),
                    _r("pfe_increase", 4), "valuation_date")


@query("exposure_profile_sketch")
def q_exposure_profile_sketch(spark, d):
    """H10 from sketches of two halves of the paths, merged."""
    net = H.net_exposure(bd.path_values(spark, d))
    halves = [X.exposure_sketch(net.filter(F.col("path_id") % 2 == i)) for i in (0, 1)]
    p = X.profile_from_sketch(X.merge_sketches(*halves), N_PATHS, PFE_LEVEL)
    return p.select("netting_set", "scenario", "time_y", _r("ee", 4), _r("pfe", 4), _r("mtm", 4), "level", "paths")


@query("ee_contributions")
def q_ee_contributions(spark, d):
    return L.ee_contributions(bd.path_values(spark, d), N_PATHS).withColumn("ee_contribution", F.round("ee_contribution", 4))


@query("pfe_contributions")
def q_pfe_contributions(spark, d):
    return L.pfe_contributions(bd.path_values(spark, d), N_PATHS, PFE_LEVEL).withColumn("pfe_contribution", F.round("pfe_contribution", 4))


@query("cva_contributions")
def q_cva_contributions(spark, d):
    """Base scenario; the grid of times is that of the set's profile."""
    values = bd.path_values(spark, d).filter(F.col("scenario") == "base")
    curve = F.concat(F.lit("Brand#"), ((F.col("netting_set").cast("int") % 25) + 1).cast("string"))
    times = values.select("netting_set", "time_y").distinct().withColumn("curve_id", curve)
    c = L.cva_contributions(L.ee_contributions(values, N_PATHS), times, bd.curve_quotes(spark, d))
    return c.withColumn("cva_contribution", F.round("cva_contribution", 4))


def _base_profile_with_curve(spark, d):
    p = _profile(spark, d).filter(F.col("scenario") == "base")
    curve = F.concat(F.lit("Brand#"), ((F.col("netting_set").cast("int") % 25) + 1).cast("string"))
    return p.select("netting_set", curve.alias("curve_id"), "time_y", "ee")


@query("cva")
def q_cva(spark, d):
    c = H.cva_on_quotes(_base_profile_with_curve(spark, d), bd.curve_quotes(spark, d), lgd=0.6, recovery=0.4, risk_free=0.04)
    return c.select("netting_set", _r("cva", 4), "times_without_pd", _r("ee_without_pd", 4))


@query("cva_cs01")
def q_cva_cs01(spark, d):
    c = H.cva_cs01(_base_profile_with_curve(spark, d), bd.curve_quotes(spark, d), lgd=0.6, recovery=0.4)
    return c.select("netting_set", _r("cva_base", 4), _r("cva_shocked", 4), _r("cva_cs01", 4), "times_without_pd",
                    _r("ee_without_pd", 4))


@query("weighted_capital")
def q_weighted_capital(spark, d):
    w = spark.createDataFrame(RISK_WEIGHTS, "tenor_bucket string, risk_weight double")
    rho = spark.createDataFrame(BUCKET_RHO, "factor_k string, factor_l string, rho double")
    k = H.weighted_capital(bd.sensitivities(spark, d), w, rho)
    return k.select("curve_id", _r("ws_total", 6), "factors", _r("bucket_capital", 6), "factors_without_weight",
                    F.round(F.col("sensitivity_without_weight").cast("double"), 2).alias("sensitivity_without_weight"))


@query("pnl_explain")
def q_pnl_explain(spark, d):
    quotes = bd.curve_quotes(spark, d)
    steeper = quotes.withColumn("spread_bp", F.col("spread_bp") + F.col("tenor_y") * 0.5)
    moves = H.factor_moves(bd.sensitivity_points(spark, d), quotes, steeper)
    moves = moves.unionByName(moves.filter("tenor_y > 10"))          # as a feed that sends long tenors twice
    numbered = F.when(F.col("trade_id").cast("long") % 997 != 0, F.col("trade_id"))   # some trades have no number yet
    both = quotes.withColumn("scenario", F.lit("before")).unionByName(steeper.withColumn("scenario", F.lit("after")))
    pv = H.discounted_pv_by_scenario(bd.cashflows(spark, d), both, ["before", "after"], risk_free=0.04)
    actual = pv.select("trade_id", (F.col("pv_after") - F.col("pv_before")).alias("pnl"))
    p = H.pnl_explain(bd.sensitivities(spark, d).withColumn("trade_id", numbered), moves, actual.withColumn("trade_id", numbered))
    return p.select("trade_id", _r("predicted_pnl", 4), _r("actual_pnl", 4), _r("unexplained_pnl", 4), "sens_without_move")


# ---- E: semantic layer -----------------------------------------------------------------

from ..operators import governance as G  # noqa: E402
from ..operators import semantic as E  # noqa: E402

SENS_CONTRACT = {
    "product_id": "credit_sensitivities",
    "grain": ["trade_id", "line_id"],
    "allowed": ["counterparty_code", "curve_id", "tenor_y"],
    "blocked": ["line_id"],
    "default_filters": ["cs01 IS NOT NULL"],
    "measures": [
        {"name": "cs01", "aggregation": "additive", "safe_aggregation": ["trade_id", "line_id"],
         "unit": "per bp"},
    ],
}

TRADES_CONTRACT = {
    "product_id": "trades",
    "grain": ["trade_id"],
    "allowed": ["source_system", "margin_type", "resolution_status", "counterparty_code", "trade_date"],
    "blocked": ["booked_name"],
    "default_filters": ["resolution_status <> 'UNMATCHED'"],
    "measures": [
        {"name": "exposure_amount", "aggregation": "additive", "safe_aggregation": ["trade_id"]},
        {"name": "largest_call", "column": "call_amount", "aggregation": "max"},
        {"name": "call_ratio", "aggregation": "ratio", "numerator": "call_amount",
         "denominator": "exposure_amount", "safe_aggregation": ["trade_id"]},
    ],
    "joinable": [{"product_id": "counterparty", "join_on": ["counterparty_code"]}],
}


@query("measure_query")
def q_measure_query(spark, d):
    return E.measure_query(bd.sensitivities(spark, d), SENS_CONTRACT, ["cs01"],
                           by=["counterparty_code", "curve_id"])


@query("safe_aggregation")
def q_safe_aggregation(spark, d):
    """Totals at each grouping that the contract allows; a refused one has no rows."""
    sens, out = bd.sensitivities(spark, d), None
    contract = {**SENS_CONTRACT, "measures": [{**SENS_CONTRACT["measures"][0], "safe_aggregation": ["line_id"]}]}
    for by in (["counterparty_code"], ["trade_id"], ["trade_id", "curve_id"]):
        try:
            got = E.measure_query(sens, contract, ["cs01"], by)
        except E.ContractViolation:
            continue
        got = got.select(F.lit("+".join(by)).alias("grouping"), F.concat_ws("|", *by).alias("key"), "cs01")
        out = got if out is None else out.unionByName(got)
    return out


@query("aggregate_by_rule")
def q_aggregate_by_rule(spark, d):
    out = E.measure_query(bd.trades(spark, d, names=False), TRADES_CONTRACT,
                          ["exposure_amount", "largest_call", "call_ratio"], by=["source_system", "margin_type"])
    return out.select("source_system", "margin_type",
                      F.col("exposure_amount").cast("decimal(38,2)").alias("exposure_amount"),
                      "largest_call", F.round("call_ratio", 8).alias("call_ratio"))


@query("safe_join")
def q_safe_join(spark, d):
    cp = bd.counterparty(spark, d).select("counterparty_code", "canonical_name", "regulatory_regime")
    return E.safe_join(bd.trades(spark, d), cp, TRADES_CONTRACT, "counterparty")


# ---- G: governance tables -------------------------------------------------------------

AS_OF = "2025-06-30"


@query("find_canonical_column")
def q_find_canonical_column(spark, d):
    return G.find_canonical_column(bd.column_tags(spark, d), "app2", "x_7")


@query("find_aliases")
def q_find_aliases(spark, d):
    return G.find_aliases(bd.column_tags(spark, d))


@query("active_consumers")
def q_active_consumers(spark, d):
    return G.active_consumers(bd.consumer_registry(spark, d), AS_OF, 365)


@query("stale_consumers")
def q_stale_consumers(spark, d):
    return G.stale_consumers(bd.consumer_registry(spark, d), AS_OF, 365)


# Sensitivity of each source catalog (app_b holds personal data).
CATALOG_LABELS = [("app_a", "CONFIDENTIAL", False), ("app_b", "RESTRICTED", True),
                  ("warehouse", "INTERNAL", False)]


def _lineage(spark, d):
    """Consumers read tables; each consumer feeds a report per user group (two levels)."""
    log = bd.query_log(spark, d)
    table = F.concat_ws(".", "table_catalog", "table_name")
    reads = log.select(F.col("consumer_id").alias("child"), table.alias("parent"))
    ev = read_table(spark, d, "events").select("user_id")
    feeds = ev.select(F.concat(F.lit("report_"), (F.col("user_id") % 10).cast("string")).alias("child"),
                      F.concat(F.lit("k"), F.col("user_id").cast("string")).alias("parent"))
    return reads.unionByName(feeds)


def _labels(spark, d):
    lab = spark.createDataFrame(CATALOG_LABELS, "table_catalog string, sensitivity string, pii boolean")
    tables = bd.query_log(spark, d).select("table_catalog", "table_name").distinct()
    return (tables.join(lab, "table_catalog")
                  .select(F.concat_ws(".", "table_catalog", "table_name").alias("product_id"),
                          "sensitivity", "pii"))


@query("inherit_classification")
def q_inherit_classification(spark, d):
    """Consumers under tables, reports under consumers, and a chain of the part sizes (two
    a level) in order under app_b's signups; suppliers under nations have no label above."""
    level = F.ceil(F.col("p_size") / 2).cast("int").alias("level")
    chain = read_table(spark, d, "part").select(level).distinct().select(
        F.concat(F.lit("size_"), F.col("level").cast("string")).alias("child"),
        F.when(F.col("level") == 1, F.lit("app_b.t_signup"))
         .otherwise(F.concat(F.lit("size_"), (F.col("level") - 1).cast("string"))).alias("parent"))
    s = read_table(spark, d, "supplier").select(
        F.concat(F.lit("supplier_"), F.col("s_suppkey").cast("string")).alias("child"),
        F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")).alias("parent"))
    return G.inherit_classification(_lineage(spark, d).unionByName(chain).unionByName(s), _labels(spark, d))


@query("column_closure")
def q_column_closure(spark, d):
    """What the tagged columns feed, and where their very values arrive."""
    return G.column_closure(bd.column_edges(spark, d), bd.tagged_columns(spark, d))


@query("lineage_diff")
def q_lineage_diff(spark, d):
    """Declared = a consumer's purchases state the view and purchase tables as upstream;
    observed = the whole query log, where reads of unnamed tables (signups) have no upstream;
    declarations leave a place without an upstream too."""
    log = bd.query_log(spark, d)
    observed = log.select(F.col("consumer_id").alias("product_id"), F.when(F.col("table_name") != "t_signup", F.concat_ws(
        ".", "table_catalog", "table_name")).alias("upstream"))
    buyers = (read_table(spark, d, "events").filter(F.col("event_type") == "purchase")
              .select(F.concat(F.lit("k"), F.col("user_id").cast("string")).alias("product_id")))
    declared = buyers.select("product_id", F.explode(F.array(F.lit("warehouse.t_view"), F.lit("warehouse.t_purchase"),
                                                             F.lit("warehouse.t_refund"), F.lit(None))).alias("upstream"))
    return G.lineage_diff(declared, observed)


@query("consumer_coverage")
def q_consumer_coverage(spark, d):
    """Products are the catalogs of the query-log binding; registrations are signups,
    subscriptions purchases and group memberships views, each mapped the same way."""
    log = bd.query_log(spark, d).select(F.col("table_catalog").alias("product_id"), "consumer_id")
    ev = read_table(spark, d, "events").select("user_id", "event_type")
    et = F.col("event_type")
    product = (F.when(et == "error", F.lit("app_a")).when(et == "signup", F.lit("app_b"))
                .otherwise(F.lit("warehouse")).alias("product_id"))
    cid = F.concat(F.lit("k"), F.col("user_id").cast("string")).alias("consumer_id")
    src = {"registry": ev.filter(et == "signup").select(product, cid),
           "query_log": log,
           "subscriptions": ev.filter(et == "purchase").select(product, cid),
           "group_members": ev.filter(et == "view").select(product, cid)}
    return G.consumer_coverage(src)


@query("direct_access")
def q_direct_access(spark, d):
    out = G.direct_access(bd.query_log(spark, d), "warehouse")
    return out.withColumn("last_read", F.date_format("last_read", "yyyy-MM-dd HH:mm:ss"))


# ---- D7 (needs the exposure profile) ----------------------------------------------------

@query("counterparty_summary")
def q_counterparty_summary(spark, d):
    exp = bd.collateral_exposure(spark, d).select(
        "counterparty_code", F.col("base_total_exposure").alias("exposure_amount"))
    pfe = (_profile(spark, d).filter(F.col("scenario") == "base")
           .select(F.col("netting_set").alias("counterparty_code"), F.round("pfe", 4).alias("pfe")))
    return D.counterparty_summary(exp, pfe, bd.counterparty(spark, d))
