"""Bind the shared TPC-H-style tables to the risk schemas.

Each function returns a lazy DataFrame derived only from the shared parquet
tables, so every downstream operator's work grows with the data. Literal
codes below are fixed values of the binding (not tuning knobs):

- order status F -> MATCHED_ORIGINAL, O -> MATCHED_RESOLVED, P -> UNMATCHED
- counterparty threshold 500000.00; margin threshold 200000.00
- variant suffixes -C canonical (S1), -S blank for '#' (S2), -U upper (S3)
- curve tenors 1, 3, 5, 10 years; spread = 50 + 10 * tenor + brand number
- facility limits: A = 50 x balance, B = 25 x balance
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import dealt, grown
from .tables import read_table

# Timestamps stay TIMESTAMP_NTZ as stored (wall-clock), so no result depends on
# the session time zone.

MONEY = "decimal(18,2)"
STATUS_ORIGINAL = "MATCHED_ORIGINAL"
STATUS_RESOLVED = "MATCHED_RESOLVED"
STATUS_UNMATCHED = "UNMATCHED"
CP_THRESHOLD = 500000
MARGIN_THRESHOLD = 200000
CURVE_TENORS = (1, 3, 5, 10)
CALENDAR = ("1994-08-01", "2001-03-01")   # months of the date dimension
ISSUER_FORMS = ("LLC", "BANK NA", "HOLDINGS PLC", "& CO")
ISSUER_LONG_FORMS = ("LIMITED LIABILITY COMPANY", "BANK NATIONAL ASSOCIATION", "HOLDINGS PUBLIC LIMITED COMPANY", "AND COMPANY")
UNQUOTED = 5                              # brands whose number leaves this on division by 10 have no curve


def money(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


def _key(c: str) -> Column:
    return F.col(c).cast("string")


def _status(col: str = "o_orderstatus") -> Column:
    s = F.col(col)
    return (F.when(s == "F", F.lit(STATUS_ORIGINAL))
             .when(s == "O", F.lit(STATUS_RESOLVED))
             .when(s == "P", F.lit(STATUS_UNMATCHED)))


def _month_end(c: str) -> Column:
    return F.last_day(F.col(c).cast("date"))


def _year_end(c: str) -> Column:
    return F.make_date(F.year(F.col(c).cast("date")), F.lit(12), F.lit(31))


def trades(spark: SparkSession, d: str, names: bool = True) -> DataFrame:
    """b_trades: one trade per order, booked under a name that depends on status.
    Without ``names`` the customer table is not read, and booked_name is absent."""
    o = read_table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        "o_orderdate", "o_orderpriority")
    st = F.col("o_orderstatus")
    exposure = money("o_totalprice")
    booked = []
    if names:
        c = read_table(spark, d, "customer").select("c_custkey", "c_name")
        o = o.join(grown(c), o.o_custkey == c.c_custkey)
        booked = [F.when(st == "F", F.col("c_name"))
                   .when(st == "O", F.translate("c_name", "#", " "))
                   .when(st == "P", F.concat(F.upper("c_name"), F.lit(" LTD")))
                   .alias("booked_name")]
    return o.select(
        _key("o_orderkey").alias("trade_id"),
        _month_end("o_orderdate").alias("trade_date"),
        F.when(st != "P", _key("o_custkey")).alias("counterparty_code"),
        *booked,
        F.col("o_orderpriority").alias("source_system"),
        F.when(F.col("o_orderkey") % 4 == 0, F.lit("IM")).otherwise(F.lit("VM"))
         .alias("margin_type"),
        exposure.alias("exposure_amount"),
        F.when(exposure > 100000, (exposure - 100000).cast(MONEY)).alias("call_amount"),
        _status().alias("resolution_status"),
    )


def counterparty(spark: SparkSession, d: str) -> DataFrame:
    """b_counterparty: customer with nation as parent and region as regime."""
    c = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read_table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, d, "region").select("r_regionkey", "r_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    return j.select(
        _key("c_custkey").alias("counterparty_code"),
        F.col("c_name").alias("canonical_name"),
        F.col("n_name").alias("ultimate_parent"),
        F.col("r_name").alias("regulatory_regime"),
        F.lit(CP_THRESHOLD).cast(MONEY).alias("threshold_amount"),
        F.concat_ws(" ", "c_name", F.translate("c_name", "#", " "), "c_mktsegment")
         .alias("entity_search_field"),
    )


def counterparty_legal(spark: SparkSession, d: str) -> DataFrame:
    """Second counterparty form: legal name and principal threshold (customer only;
    it needs no nation or region join)."""
    c = read_table(spark, d, "customer").select("c_custkey", "c_name")
    return c.select(_key("c_custkey").alias("counterparty_code"),
                    F.col("c_name").alias("counterparty_legal_name"),
                    F.lit(CP_THRESHOLD).cast(MONEY).alias("threshold_principal"))


def date_dim(spark: SparkSession, d: str, last: str = CALENDAR[1]) -> DataFrame:
    """b_date: month ends from CALENDAR's first month to ``last``; later trades are not in it."""
    lo, hi = (F.lit(x).cast("date") for x in (CALENDAR[0], last))
    dates = spark.range(1).select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH"))).alias("_m")).select(
        F.last_day("_m").alias("trade_date"))
    t = F.col("trade_date")
    return dates.select(
        t,
        F.date_format(t, "MMMM").alias("month_name"),
        F.month(t).alias("month_number"),
        F.concat(F.lit("Q"), F.quarter(t).cast("string"), F.lit("-"), F.year(t).cast("string"))
         .alias("quarter_name"),
        F.year(t).alias("year_number"),
    )


def name_variants(spark: SparkSession, d: str) -> DataFrame:
    """b_variants: canonical, blank-for-# and upper-case spelling per customer."""
    c = read_table(spark, d, "customer").select("c_custkey", "c_name")
    key = _key("c_custkey")

    def v(suffix, name, system, vtype, canonical, impact):
        return F.struct(
            F.concat(key, F.lit(suffix)).alias("variant_id"),
            name.alias("variant_name"), F.lit(system).alias("source_system"),
            F.lit(vtype).alias("variant_type"), F.lit(canonical).alias("is_canonical"),
            F.lit(impact).alias("risk_impact"))

    rows = F.array(
        v("-C", F.col("c_name"), "S1", "Canonical", True, "NONE"),
        v("-S", F.translate("c_name", "#", " "), "S2", "Punctuation", False, "HIGH"),
        v("-U", F.upper("c_name"), "S3", "Uppercase", False, "MEDIUM"))
    return (c.select(key.alias("counterparty_code"), F.col("c_name").alias("canonical_name"),
                     F.explode(rows).alias("v"))
             .select("v.variant_id", "counterparty_code", "v.variant_name", "v.source_system",
                     "v.variant_type", "v.is_canonical", "canonical_name", "v.risk_impact"))


def collateral_exposure(spark: SparkSession, d: str, known_only: bool = False) -> DataFrame:
    """b_margin (all orders) / b_known (status != P, dated 31 December)."""
    o = read_table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    if known_only:
        o = o.filter(F.col("o_orderstatus") != "P")
        as_of = _year_end("o_orderdate")
    else:
        as_of = F.col("o_orderdate").cast("date")
    price = money("o_totalprice")
    thr = F.lit(MARGIN_THRESHOLD).cast(MONEY)
    call = F.when(price > thr, (price - thr).cast(MONEY))
    agreed = F.when(F.col("o_orderkey") % 3 == 0, (call - 1000).cast(MONEY)).otherwise(call)
    return o.select(
        _key("o_orderkey").alias("event_id"),
        F.concat(F.lit("AGR-"), _key("o_custkey")).alias("agreement_id"),
        _key("o_custkey").alias("counterparty_code"),
        as_of.alias("as_of_date"),
        F.lit(1).alias("csa_type_key"),
        F.lit("VM").alias("margin_type"),
        F.when(call.isNull(), F.lit("No Call")).otherwise(F.lit("Agreed")).alias("call_status"),
        F.lit("Call").alias("action"),
        F.lit("USD").alias("reporting_currency"),
        price.alias("base_total_exposure"),
        (price * 2).cast(MONEY).alias("itm_exposure"),
        (-price).cast(MONEY).alias("otm_exposure"),
        call.alias("base_call_amount"),
        agreed.alias("agreed_amount"),
        F.lit(None).cast(MONEY).alias("im_requirement"),
        thr.alias("threshold_principal"),
        thr.alias("threshold_counterparty"),
        F.lit(250000).cast(MONEY).alias("min_transfer_principal"),
        F.lit(250000).cast(MONEY).alias("min_transfer_cp"),
        F.when(call != agreed, (call - agreed).cast(MONEY)).alias("dispute_amount"),
        F.when(call != agreed, F.lit(7)).otherwise(F.lit(0)).alias("dispute_age"),
        F.coalesce(call != agreed, F.lit(False)).alias("is_disputed"),
    )


def known_exposure_fact(spark: SparkSession, d: str) -> DataFrame:
    return collateral_exposure(spark, d, known_only=True)


def anomaly_exposure(spark: SparkSession, d: str) -> DataFrame:
    """b_hidden: status P orders booked under the -S (even key) or -U (odd) variant."""
    o = (read_table(spark, d, "orders")
         .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                 "o_orderdate", "o_orderpriority")
         .filter(F.col("o_orderstatus") == "P"))
    suffix = F.when(F.col("o_orderkey") % 2 == 0, F.lit("-S")).otherwise(F.lit("-U"))
    return o.select(
        _key("o_orderkey").alias("anomaly_id"),
        F.concat(_key("o_custkey"), suffix).alias("variant_id"),
        _key("o_custkey").alias("counterparty_code"),
        F.lit(None).cast("string").alias("booked_name"),
        _year_end("o_orderdate").alias("as_of_date"),
        F.lit("VM").alias("margin_type"),
        money("o_totalprice").alias("base_total_exposure"),
        F.lit(None).cast(MONEY).alias("base_call_amount"),
        F.lit(0).cast(MONEY).alias("im_requirement"),
        F.col("o_orderpriority").alias("source_system"),
        F.lit(False).alias("is_resolved"),
    )


def exposure_change_sets(spark: SparkSession, d: str) -> list[tuple[tuple, tuple]]:
    """b_known and b_hidden as three change sets bring them about: ((known, hidden) before,
    (known, hidden) after) of the changed facts, the first being the initial load.

    1-URGENT orders come late; 2-HIGH orders of status O were booked under the neighbouring
    customer (key with its last bit flipped) and are moved; 5-LOW orders of status O are
    reset: they go back from known to hidden exposure, under their -S variant."""
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    late, moved = F.col("o_orderpriority") == "1-URGENT", (F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "O")
    reset = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "O")
    is_p = F.col("o_orderstatus") == "P"

    def known(rows, key="o_custkey"):
        code = _key("o_custkey") if key == "o_custkey" else F.col("o_custkey").bitwiseXOR(F.lit(1)).cast("string")
        return rows.select(code.alias("counterparty_code"), _year_end("o_orderdate").alias("as_of_date"),
                           money("o_totalprice").alias("base_total_exposure"))

    def hidden(rows, suffix=None):
        suffix = F.lit(suffix) if suffix else F.when(F.col("o_orderkey") % 2 == 0, F.lit("-S")).otherwise(F.lit("-U"))
        return rows.select(
            _key("o_custkey").alias("counterparty_code"), _year_end("o_orderdate").alias("as_of_date"),
            F.concat(_key("o_custkey"), suffix).alias("variant_id"), money("o_totalprice").alias("base_total_exposure"))

    first = o.filter(~late)
    load = known(first.filter(~is_p & ~moved)).unionByName(known(first.filter(moved), "flipped")), hidden(first.filter(is_p))
    return [((None, None), load),
            ((None, None), (known(o.filter(late & ~is_p)), hidden(o.filter(late & is_p)))),
            ((known(o.filter(moved), "flipped"), None), (known(o.filter(moved)), None)),
            ((known(o.filter(reset)), None), (None, hidden(o.filter(reset), "-S")))]


def legal_entity(spark: SparkSession, d: str, listed: bool = False) -> DataFrame:
    """b_legal: per customer one entity row and one ultimate-parent row (its nation).
    ``listed`` is b_legal_listed: rows as an entity register lists them, those of every third
    customer twice, and a second entity (a branch, under another parent) for every fifth."""
    c = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = read_table(spark, d, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    parent_lei = F.concat(F.lit("LEI-N"), _key("n_nationkey"))

    def row(lei, name, etype, is_parent, parent=None):
        return F.struct(lei.alias("lei_code"), (F.lit(parent) if parent else F.col("n_name")).alias("ultimate_parent_name"),
                        name.alias("legal_entity_name"), F.lit(etype).alias("entity_type"), F.lit(is_parent).alias("is_ultimate_parent"))

    own = row(F.concat(F.lit("LEI-C"), _key("c_custkey")), F.col("c_name"), "Bank", False)
    top = row(parent_lei, F.col("n_name"), "Holding Company", True)
    rows = F.array(own, top)
    if listed:
        branch = row(F.concat(F.lit("LEI-X"), _key("c_custkey")), F.concat("c_name", F.lit(" BRANCH")), "Bank", False, "BRANCH HOLDING")
        third, fifth = F.col("c_custkey") % 3 == 0, F.col("c_custkey") % 5 == 0
        rows = F.array_compact(F.array(own, top, F.when(third, own), F.when(third, top), F.when(fifth, branch)))
    return (j.select(parent_lei.alias("ultimate_parent_lei"), F.col("n_name").alias("incorporation_country"),
                     _key("c_custkey").alias("counterparty_code"), F.explode(rows).alias("r"))
             .select("r.lei_code", "ultimate_parent_lei", "r.ultimate_parent_name",
                     "r.legal_entity_name", "counterparty_code", "r.entity_type",
                     "incorporation_country", F.lit("N/A").alias("regulatory_jurisdiction"),
                     "r.is_ultimate_parent"))


def ownership_edges(spark: SparkSession, d: str) -> DataFrame:
    """b_owners: one level of ownership a row. Suppliers S own each other in one long chain
    (S0 is its own parent, as ultimate parents are), customers C in a tree of two children a
    node under customer 0, which the last supplier owns; every fourth customer has a second
    parent of a lesser share. Nations N of a region own each other in rings, parts P stand
    under nations; some rows come twice, and some name no parent."""
    name = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    s = read_table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"))
    c = read_table(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_nationkey")
    n = read_table(spark, d, "nation").select(F.col("n_nationkey").alias("k"))
    p = read_table(spark, d, "part").select(F.col("p_partkey").alias("k"), "p_size")
    row = lambda df, a, b, share: df.select(a.alias("child"), b.alias("parent"), F.lit(share).alias("share"))
    k = F.col("k")
    last = s.agg(F.max("k").alias("k"))
    second = row(c.filter(k % 4 == 1), name("C", k), name("N", F.col("c_nationkey")), 0.3)
    parts = [
        row(s, name("S", k), name("S", F.greatest(k - 1, F.lit(0))), 1.0),
        row(c.filter(k > 0), name("C", k), name("C", F.floor((k - 1) / 2).cast("long")), 0.6),
        row(last, F.lit("C0"), name("S", k), 0.9), second, second,
        row(n, name("N", k), name("N", (k + 5) % 25), 0.5),
        row(p, name("P", k), F.when(k % 50 != 0, name("N", F.col("p_size") % 25)), 0.2)]
    return reduce(DataFrame.unionByName, parts)


def entity_amounts(spark: SparkSession, d: str) -> DataFrame:
    """b_entity_amounts: orders as exposures of customers, line prices as exposures of suppliers,
    part prices as exposures of parts."""
    o = read_table(spark, d, "orders").select(F.concat(F.lit("C"), _key("o_custkey")).alias("entity"), money("o_totalprice").alias("amount"))
    li = read_table(spark, d, "lineitem").select(F.concat(F.lit("S"), _key("l_suppkey")).alias("entity"), money("l_extendedprice").alias("amount"))
    p = read_table(spark, d, "part").select(F.concat(F.lit("P"), _key("p_partkey")).alias("entity"), money("p_retailprice").alias("amount"))
    return o.unionByName(li).unionByName(p)


def rule_versions(spark: SparkSession, d: str) -> DataFrame:
    """b_rule_versions: each 1-URGENT order puts a margin rule of its customer in force from its
    date, for 400 days or (every third order) without end; some come twice."""
    o = read_table(spark, d, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_custkey", "o_orderdate")
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    v = o.select(_key("o_custkey").alias("counterparty_code"), day.alias("valid_from"), F.when(k % 3 != 0, F.date_add(day, 400)).alias("valid_to"),
                 F.concat(F.lit("RULE-"), (k % 7).cast("string")).alias("rule"), k.alias("_k"))
    return v.unionByName(v.filter("_k % 5 = 0")).drop("_k")


def trades_dated(spark: SparkSession, d: str) -> DataFrame:
    """b_dated: trades by order day; trades of status P have no counterparty."""
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return o.select(_key("o_orderkey").alias("trade_id"), F.when(F.col("o_orderstatus") != "P", _key("o_custkey")).alias("counterparty_code"),
                    F.col("o_orderdate").cast("date").alias("booked_on"), money("o_totalprice").alias("exposure_amount"))


def sales_a_reported(spark: SparkSession, d: str) -> DataFrame:
    """b_sales_reported: line prices per order as another system reports them: lines of every 211th
    order are a cent off, every 307th order is missing, one line of every 401st has no amount."""
    k, n = F.col("order_id"), F.col("line_id")
    off = F.when(k % 211 == 0, (F.col("amount") + F.lit(0.01).cast("decimal(3,2)")).cast(MONEY)).when(~((k % 401 == 0) & (n == 1)), F.col("amount"))
    return sales_b(spark, d).filter(k % 307 != 0).withColumn("amount", off)


def column_edges(spark: SparkSession, d: str) -> DataFrame:
    """b_column_edges: each part is a column of the product of its brand, fed by the columns of half
    and a third of its number; columns of a size divisible by 5 are hashes, by 7 sums of them."""
    p = read_table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    up = p.select(F.col("p_partkey").alias("_u"), F.col("p_brand").alias("upstream_product"))
    fed = p.select("*", F.explode(F.array_distinct(F.array(F.floor(F.col("p_partkey") / 2), F.floor(F.col("p_partkey") / 3)))).alias("_u"))
    how = F.when(F.col("p_size") % 5 == 0, F.lit("hash")).when(F.col("p_size") % 7 == 0, F.lit("sum")).when(F.col("_u") * 2 == F.col("p_partkey"), F.lit("identity")).otherwise(F.lit("rename"))
    return fed.join(up, "_u").select(
        F.col("p_brand").alias("product_id"), F.concat(F.lit("col_"), _key("p_partkey")).alias("column_name"), "upstream_product",
        F.concat(F.lit("col_"), _key("_u")).alias("upstream_column"), how.alias("transform"))


def tagged_columns(spark: SparkSession, d: str) -> DataFrame:
    """b_tagged: the columns of parts of the largest size, as those tagged personal."""
    p = read_table(spark, d, "part").filter(F.col("p_size") == 50)
    return p.select(F.col("p_brand").alias("product_id"), F.concat(F.lit("col_"), _key("p_partkey")).alias("column_name"))


def facility_limits(spark: SparkSession, d: str) -> DataFrame:
    """b_limits: two facilities per customer with a positive balance."""
    c = (read_table(spark, d, "customer").select("c_custkey", "c_acctbal")
         .filter(F.col("c_acctbal") > 0))
    bal = money("c_acctbal")
    rows = F.array(F.struct(F.lit("A").alias("facility_id"), (bal * 50).cast(MONEY).alias("limit_amount")),
                   F.struct(F.lit("B").alias("facility_id"), (bal * 25).cast(MONEY).alias("limit_amount")))
    return (c.select(_key("c_custkey").alias("counterparty_code"), F.explode(rows).alias("l"))
             .select("counterparty_code", "l.facility_id", "l.limit_amount"))


def _orders_by_nation(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = read_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, d, "nation").select("n_nationkey", "n_name")
    return o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)


def fx_rates(spark: SparkSession, d: str) -> DataFrame:
    """b_fx: a rate per (currency, month end) where business exists; nations >= 20 have none."""
    j = _orders_by_nation(spark, d).filter(F.col("n_nationkey") < 20)
    rate = ((F.col("n_nationkey") + 100).cast("decimal(10,2)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(10,4)")
    # one rate per (currency, date): grouped on the join keys, so the FX join reuses this exchange
    return (j.groupBy(F.col("n_name").alias("currency"), _month_end("o_orderdate").alias("business_date"))
             .agg(F.max(rate).alias("rate")))


def liquidity_buffer(spark: SparkSession, d: str) -> DataFrame:
    """b_buffer: every order as a buffer amount in its customer's nation currency."""
    j = _orders_by_nation(spark, d)
    return j.select(
        _key("o_orderkey").alias("position_id"),
        _month_end("o_orderdate").alias("business_date"),
        F.col("n_name").alias("currency"),
        F.col("o_orderpriority").alias("asset_code"),
        F.lit("SRC").alias("source_system"),
        money("o_totalprice").alias("amount"))


def pledged_collateral(spark: SparkSession, d: str) -> DataFrame:
    """b_pledged: status P orders as pledged collateral."""
    j = _orders_by_nation(spark, d).filter(F.col("o_orderstatus") == "P")
    return j.select(
        _key("o_orderkey").alias("position_id"),
        _month_end("o_orderdate").alias("business_date"),
        F.col("n_name").alias("currency"),
        F.col("o_orderpriority").alias("asset_code"),
        F.lit("SRC").alias("source_system"),
        money("o_totalprice").alias("amount"))


def path_values(spark: SparkSession, d: str) -> DataFrame:
    """b_paths: revalued trade values per netting set, scenario, path and time."""
    li = read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    price = money("l_extendedprice")
    return li.select(
        _key("l_suppkey").alias("netting_set"),
        _key("l_orderkey").alias("trade_id"),
        F.when(F.col("l_linestatus") == "F", F.lit("base"))
         .when(F.col("l_linestatus") == "O", F.lit("stressed")).alias("scenario"),
        (F.col("l_orderkey") % 100).alias("path_id"),
        (F.year(F.col("l_shipdate").cast("date")) - 1994).cast("double").alias("time_y"),
        F.when(F.col("l_returnflag") == "R", -price).otherwise(price).cast(MONEY).alias("value"))


def curve_quotes(spark: SparkSession, d: str) -> DataFrame:
    """b_quotes: one spread curve per brand at tenors 1, 3, 5, 10; brands 5, 15, 25 have none."""
    brands = read_table(spark, d, "part").select("p_brand").distinct()
    tenor = F.explode(F.array(*[F.lit(float(t)) for t in CURVE_TENORS]))
    brand_no = F.element_at(F.split("p_brand", "#"), 2).cast("int")
    return (brands.select(F.col("p_brand").alias("curve_id"), brand_no.alias("brand_no"),
                          tenor.alias("tenor_y"))
                  .filter(F.col("brand_no") % 10 != UNQUOTED)
                  .select("curve_id", "tenor_y",
                          (F.lit(50.0) + F.col("tenor_y") * 10 + F.col("brand_no")).alias("spread_bp")))


def sensitivities(spark: SparkSession, d: str) -> DataFrame:
    """b_sens: CS01 per trade line on the brand curve at the part-size tenor."""
    li = read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
    p = read_table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    j = li.join(p, li.l_partkey == p.p_partkey)
    q = F.col("l_quantity")
    return j.select(
        _key("l_orderkey").alias("trade_id"),
        F.col("l_linenumber").alias("line_id"),
        _key("l_suppkey").alias("counterparty_code"),
        F.col("p_brand").alias("curve_id"),
        F.col("p_size").cast("double").alias("tenor_y"),
        F.when(F.col("l_returnflag") == "R", -q).otherwise(q).alias("cs01"))


def sensitivity_points(spark: SparkSession, d: str) -> DataFrame:
    """The (curve, tenor) points that sensitivities can have: brand and size of the parts."""
    return read_table(spark, d, "part").select(
        F.col("p_brand").alias("curve_id"), F.col("p_size").cast("double").alias("tenor_y")).distinct()


def reported_margin(spark: SparkSession, d: str) -> DataFrame:
    """b_reported: b_margin as a source reported it, with slips in some events: a wrong split
    (event number divisible by 97), no call amount (89), a wrong dispute (83), a flag that
    contradicts the dispute (79)."""
    m = collateral_exposure(spark, d)
    slip = lambda k: F.col("event_id").cast("long") % k == 0
    return (m.withColumn("itm_exposure", F.when(slip(97), (F.col("itm_exposure") + 1).cast(MONEY)).otherwise(F.col("itm_exposure")))
             .withColumn("base_call_amount", F.when(~slip(89), F.col("base_call_amount")))
             .withColumn("dispute_amount", F.when(slip(83), F.lit(5).cast(MONEY)).otherwise(F.col("dispute_amount")))
             .withColumn("is_disputed", F.col("is_disputed") != slip(79)))


def line_amounts(spark: SparkSession, d: str, flags: tuple[str, ...]) -> DataFrame:
    """Line prices of some return flags, as one of two books to reconcile: A and N lines are
    booked, N and R lines settled."""
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_returnflag")
    return li.filter(F.col("l_returnflag").isin(*flags)).select(
        F.col("l_orderkey").alias("order_id"), money("l_extendedprice").alias("amount"))


def misspelt_names(spark: SparkSession, d: str) -> DataFrame:
    """Unmatched booked names without their legal suffix, misspelt by order number: as
    booked (0), a letter dropped (1), a letter changed (2), two letters dropped and one
    changed (3)."""
    t = trades(spark, d).filter(F.col("resolution_status") == STATUS_UNMATCHED)
    name, k = F.regexp_replace("booked_name", " LTD$", ""), F.col("trade_id").cast("long") % 4
    return t.select(F.when(k == 1, F.regexp_replace(name, "CUSTOMER", "CUSTMER"))
                     .when(k == 2, F.regexp_replace(name, "CUSTOMER", "CUSTONER"))
                     .when(k == 3, F.regexp_replace(name, "CUSTOMER", "CSTNER")).otherwise(name).alias("booked_name"))


def _letters_of(c: str) -> Column:
    """A number as a word: its digits from the last to the first as letters A to J."""
    return F.translate(F.reverse(_key(c)), "0123456789", "ABCDEFGHIJ")


def issuer_variants(spark: SparkSession, d: str) -> DataFrame:
    """b_issuers: each part as an issuer, named by a word of its own, its name, its type and a
    legal form, and the same name in mixed case as a second variant."""
    p = dealt(read_table(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_size"), "p_partkey")
    form = F.element_at(F.array(*[F.lit(x) for x in ISSUER_FORMS]), (F.col("p_size") % 4 + 1).cast("int"))
    name = F.concat_ws(" ", _letters_of("p_partkey"), F.upper("p_name"), F.upper("p_type"), form)
    rows = F.array(F.struct(name.alias("variant_name"), F.lit(True).alias("is_canonical")),
                   F.struct(F.lower(name).alias("variant_name"), F.lit(False).alias("is_canonical")))
    return p.select(_key("p_partkey").alias("counterparty_code"), F.explode(rows).alias("v")).select("counterparty_code", "v.*")


def issuer_bookings(spark: SparkSession, d: str) -> DataFrame:
    """b_bookings: each part's price booked under a variant of its issuer's name, by part number:
    truncated (0), with a place (1), its legal form spelt out (2), words in another order (3),
    without its own word (4), a code of beginnings (5), with other punctuation (6)."""
    p = dealt(read_table(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice"), "p_partkey")
    word, name, kind = _letters_of("p_partkey"), F.upper("p_name"), F.upper("p_type")
    long_form = F.element_at(F.array(*[F.lit(x) for x in ISSUER_LONG_FORMS]), (F.col("p_size") % 4 + 1).cast("int"))
    form = F.element_at(F.array(*[F.lit(x) for x in ISSUER_FORMS]), (F.col("p_size") % 4 + 1).cast("int"))
    first = lambda w: F.substring(w, 1, 1)
    code = F.concat(F.substring(word, 1, 3), first(name), first(F.element_at(F.split(name, " "), 2)), first(kind), F.when(
        F.col("p_size") % 4 == 3, F.lit("_CO")).when(F.col("p_size") % 4 == 1, F.lit("B")).otherwise(F.lit("")))
    k = F.col("p_partkey") % 7
    booked = (F.when(k == 0, F.concat_ws(" ", word, name)).when(k == 1, F.concat_ws(" ", word, name, kind, F.lit("LONDON")))
               .when(k == 2, F.concat_ws(" ", word, name, kind, long_form)).when(k == 3, F.concat_ws(" ", kind, name, word))
               .when(k == 4, F.concat_ws(" ", name, kind)).when(k == 5, code)
               .otherwise(F.concat_ws("-", word, F.translate(name, " ", "_"), kind, form)))
    return p.select(_key("p_partkey").alias("booking_id"), booked.alias("booked_name"), money("p_retailprice").alias("exposure_amount"))


def cashflows(spark: SparkSession, d: str) -> DataFrame:
    """b_cashflows: a cash flow per line at year = line number, on the brand curve."""
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    p = read_table(spark, d, "part").select("p_partkey", "p_brand")
    j = li.join(p, li.l_partkey == p.p_partkey)
    return j.select(
        _key("l_orderkey").alias("trade_id"),
        F.col("p_brand").alias("curve_id"),
        F.col("l_linenumber").cast("double").alias("time_y"),
        money("l_extendedprice").alias("amount"))


def loads(spark: SparkSession, d: str) -> DataFrame:
    """b_loads: each event is a load of the product named by its type."""
    e = read_table(spark, d, "events").select("event_id", "event_type", "ts")
    return e.select(F.col("event_type").alias("product_id"),
                    F.col("ts").alias("load_time"),
                    F.col("event_id").alias("load_id"))


def loads_listed(spark: SparkSession, d: str) -> DataFrame:
    """b_loads_listed: b_loads whose error events name no product."""
    return loads(spark, d).withColumn("product_id", F.when(F.col("product_id") != "error", F.col("product_id")))


def column_tags(spark: SparkSession, d: str) -> DataFrame:
    """b_tags: each part is a canonical column with two source aliases."""
    p = read_table(spark, d, "part").select("p_partkey", "p_type")
    k = _key("p_partkey")
    return p.select(
        F.lit("warehouse").alias("table_catalog"), F.lit("core").alias("table_schema"),
        F.lit("parts").alias("table_name"),
        F.concat(F.lit("col_"), k).alias("column_name"),
        F.lit("source_aliases").alias("tag_name"),
        F.concat(F.col("p_type"), F.lit(":c"), k, F.lit(",app2:x_"),
                 (F.col("p_partkey") % 50).cast("string")).alias("tag_value"))


def consumer_registry(spark: SparkSession, d: str) -> DataFrame:
    """b_registry: each supplier is a registered consumer of one product."""
    s = read_table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    key = F.col("s_suppkey")
    return s.select(
        F.col("s_name").alias("consumer_id"),
        F.when(key % 2 == 0, F.lit("dashboard")).otherwise(F.lit("pipeline")).alias("consumer_type"),
        F.concat(F.lit("owner_"), _key("s_nationkey")).alias("consumer_owner"),
        F.lit("bi").alias("consumer_platform"),
        F.concat(F.lit("product_"), (F.col("s_nationkey") % 5).cast("string")).alias("producer_product"),
        F.lit("1.0.0").alias("producer_version"),
        F.lit("2023-01-01").cast("date").alias("registered_date"),
        F.when(key % 11 != 0,
               F.date_add(F.lit("2024-01-01").cast("date"), ((key * 7) % 730).cast("int")))
         .alias("last_validated_date"),
        (F.col("s_acctbal") > 5000).alias("business_critical"))


def positions(spark: SparkSession, d: str) -> DataFrame:
    """b_positions: each line is a collateral position of agreement = supplier."""
    li = read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_discount", "l_shipdate")
    return li.select(
        F.concat(_key("l_orderkey"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("position_id"),
        _key("l_suppkey").alias("agreement_id"),
        F.col("l_shipdate").cast("date").alias("as_of_date"),
        money("l_extendedprice").alias("market_value"),
        F.col("l_discount").cast("decimal(4,2)").alias("haircut"))


def query_log(spark: SparkSession, d: str) -> DataFrame:
    """b_query_log: each event is a read; errors hit app_a, signups app_b."""
    e = read_table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    et = F.col("event_type")
    return e.select(
        F.col("event_id").alias("query_id"),
        F.concat(F.lit("k"), _key("user_id")).alias("consumer_id"),
        F.when(et == "error", F.lit("app_a")).when(et == "signup", F.lit("app_b"))
         .otherwise(F.lit("warehouse")).alias("table_catalog"),
        F.concat(F.lit("t_"), et).alias("table_name"),
        F.col("ts").alias("read_time"))


def sales_a(spark: SparkSession, d: str) -> DataFrame:
    """b_sales_a: order price per order."""
    return read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"), money("o_totalprice").alias("amount"))


def sales_b(spark: SparkSession, d: str) -> DataFrame:
    """b_sales_b: line prices per line (aggregated per order by the operators)."""
    return read_table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_id"),
        money("l_extendedprice").alias("amount"))


VIEW_BUILDERS = {
    "trades": trades, "counterparty": counterparty, "counterparty_legal": counterparty_legal,
    "date_dim": date_dim, "name_variants": name_variants, "collateral_exposure": collateral_exposure,
    "known_exposure_fact": known_exposure_fact, "anomaly_exposure": anomaly_exposure,
    "legal_entity": legal_entity, "facility_limits": facility_limits, "fx_rates": fx_rates,
    "liquidity_buffer": liquidity_buffer, "pledged_collateral": pledged_collateral,
    "path_values": path_values, "curve_quotes": curve_quotes, "sensitivities": sensitivities,
    "cashflows": cashflows, "loads": loads, "column_tags": column_tags,
    "consumer_registry": consumer_registry, "positions": positions, "query_log": query_log,
    "sales_a": sales_a, "sales_b": sales_b, "reported_margin": reported_margin,
}


def register_views(spark: SparkSession, d: str, prefix: str = "") -> list[str]:
    """Register every binding as a temporary view, so the risk tables can also be
    queried with Spark SQL text (the views are lazy; nothing is computed here)."""
    names = []
    for name, build in VIEW_BUILDERS.items():
        build(spark, d).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
