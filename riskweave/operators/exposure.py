"""C. Exposure and breach analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import (NEW_BREACH, WORSENED, breach_status, money_sum, ratio,
                                 resolution_impact, round_double)
from ..plans.joins import full_join, unique_lookup
from .load import conform_values
from .resolution import MATCHED_ORIGINAL, own_entity


def exposure_by_counterparty(trades: DataFrame, dim: DataFrame,
                             statuses=(MATCHED_ORIGINAL,), label: str = "exposure") -> DataFrame:
    """Exposure and trade count per counterparty with its regime and threshold.

    One status gives the 'before resolution' view, both matched statuses the
    'after' view. Trades are summed per code first (partial aggregation absorbs a
    hot counterparty), then only one row per code meets the dimension.
    """
    per_code = (trades.filter(F.col("resolution_status").isin(*statuses))
                      .groupBy("counterparty_code")
                      .agg(F.sum("exposure_amount").alias("_x"), F.count("trade_id").alias("_n")))
    j = per_code.join(dim.select("counterparty_code", "canonical_name", "regulatory_regime",
                                 "threshold_amount"), "counterparty_code")
    return (j.groupBy("canonical_name", "regulatory_regime", "threshold_amount")
             .agg(F.sum("_x").cast("decimal(38,2)").alias(label), F.sum("_n").alias("trade_count"))
             .orderBy(F.col(label).desc(), "canonical_name"))


def known_exposure(fact: DataFrame, codes=None) -> DataFrame:
    """Known exposure per counterparty and date (optionally for some codes)."""
    if codes is not None:
        fact = fact.filter(F.col("counterparty_code").isin(*codes))
    return (fact.groupBy("counterparty_code", "as_of_date")
                .agg(money_sum("base_total_exposure").alias("known_exposure")))


def hidden_exposure(anomaly: DataFrame, variants: DataFrame) -> DataFrame:
    """Exposure booked under variant names per counterparty and date, with the
    number of distinct variants and of distinct source systems of those variants
    (the variant table's system, not the fact's).

    The fact is reduced to (code, date, variant) before the join with variants. A variant
    listed several times is counted at one of its rows, so that systems are the only
    distinct count: two of them would multiply the rows (Expand) before they are shuffled.
    """
    per_variant = (anomaly.groupBy("counterparty_code", "as_of_date", "variant_id")
                          .agg(F.sum("base_total_exposure").alias("_x"), F.count("*").alias("_n")))
    nv = variants.select("variant_id", F.col("source_system").alias("_variant_system"))
    each = Window.partitionBy("counterparty_code", "as_of_date", "variant_id").orderBy("_variant_system")
    j = per_variant.join(nv, "variant_id").withColumn("_nth", F.row_number().over(each))
    return (j.groupBy("counterparty_code", "as_of_date")
             .agg(F.sum("_x").cast("decimal(38,2)").alias("hidden_exposure"),
                  F.count(F.when(F.col("_nth") == 1, 1)).alias("variant_count"),
                  F.countDistinct("_variant_system").alias("source_system_count")))


def true_exposure_summary(known: DataFrame, hidden: DataFrame, dim: DataFrame,
                          legal_entity: DataFrame) -> DataFrame:
    """C4 + C5: known + hidden exposure per counterparty and date with breach statuses.

    Starts from known exposure: hidden exposure on a date without a known row is
    dropped, as in the reference.

    Join order is chosen for the shuffle plan: known and hidden are both
    aggregated on (code, date), so their left join reuses both aggregation
    exchanges; the two dimensions are combined at counterparty grain first and
    meet the fact once (broadcast by AQE when measured small). A counterparty of several
    non-parent entities has one row a date (``own_entity``).
    """
    cp = dim.select("counterparty_code", "counterparty_legal_name", "threshold_principal")
    le = own_entity(legal_entity).select("counterparty_code", "ultimate_parent_name")
    j = (known.join(hidden, ["counterparty_code", "as_of_date"], "left")
              .join(cp.join(le, "counterparty_code"), "counterparty_code"))
    k, th = F.col("known_exposure"), F.col("threshold_principal")
    h = F.coalesce(F.col("hidden_exposure"), F.lit(0).cast("decimal(38,2)"))
    total = (k + h).cast("decimal(38,2)")
    return j.select(
        "counterparty_code", "counterparty_legal_name", "ultimate_parent_name", "as_of_date",
        k.alias("known_exposure"), h.cast("decimal(38,2)").alias("hidden_exposure"),
        total.alias("true_total_exposure"), th.alias("threshold"),
        F.coalesce(F.col("variant_count"), F.lit(0)).alias("name_variants_found"),
        F.coalesce(F.col("source_system_count"), F.lit(0)).alias("source_systems_affected"),
        breach_status(k, th).alias("status_before_resolution"),
        breach_status(total, th).alias("status_after_resolution"),
        resolution_impact(k, total, th).alias("resolution_impact"))


def breach_alerts(summary: DataFrame) -> DataFrame:
    """Rows whose impact is a new or worsened breach, by date then code."""
    return (summary.filter(F.col("resolution_impact").isin(NEW_BREACH, WORSENED))
                   .orderBy("as_of_date", "counterparty_code")
                   .select("counterparty_legal_name", "ultimate_parent_name", "as_of_date",
                           "known_exposure", "hidden_exposure", "true_total_exposure", "threshold",
                           "name_variants_found", "source_systems_affected",
                           "status_before_resolution", "status_after_resolution", "resolution_impact"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per named table with its row count."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("tbl"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def limit_utilisation(exposure: DataFrame, limits: DataFrame, key: str = "counterparty_code",
                      amount: str = "exposure_amount") -> DataFrame:
    """Exposure against limits. Limits live at key + facility and are summed to the
    key first; exposure is summed to the key too, so neither side fans out the other."""
    x = exposure.groupBy(key).agg(F.sum(amount).cast("decimal(38,2)").alias("exposure"))
    lim = limits.groupBy(key).agg(F.sum("limit_amount").cast("decimal(38,2)").alias("limit_amount"),
                                  F.count("*").alias("facility_count"))
    j = x.join(lim, key, "left")
    e, l = F.col("exposure"), F.col("limit_amount")
    return j.select(
        key, "exposure", "limit_amount", F.coalesce("facility_count", F.lit(0)).alias("facility_count"),
        (l - e).cast("decimal(38,2)").alias("headroom"),
        F.when(e > l, (e - l).cast("decimal(38,2)")).otherwise(F.lit(0).cast("decimal(38,2)"))
         .alias("over_limit"),
        round_double(ratio(e, l), 6).alias("utilisation"),
        F.when(l.isNull(), F.lit("NO LIMIT")).when(e > l, F.lit("BREACH"))
         .otherwise(F.lit("OK")).alias("limit_status"))


def exposure_trend(fact: DataFrame, key: str = "counterparty_code", date: str = "as_of_date",
                   amount: str = "base_total_exposure") -> DataFrame:
    """Change against the previous date and a direction label.

    Summed to (key, date) before the window, so a window partition holds one
    row per date of one key, however skewed the raw fact is.
    """
    per = fact.groupBy(key, date).agg(F.sum(amount).cast("decimal(38,2)").alias("exposure"))
    w = Window.partitionBy(key).orderBy(date)
    prev = F.lag("exposure").over(w)
    chg = (F.col("exposure") - F.col("prev_exposure")).cast("decimal(38,2)")
    return (per.withColumn("prev_exposure", prev)
               .withColumn("change", chg)
               .withColumn("direction", F.when(F.col("change") > 0, F.lit("UP"))
                                         .when(F.col("change") < 0, F.lit("DOWN"))
                                         .when(F.col("change") == 0, F.lit("FLAT"))))


def margin_call_check(fact: DataFrame) -> DataFrame:
    """Row rules of the collateral fact, one pass, count of rows breaking each.

    exposure = ITM + OTM; call = exposure - threshold when above it, else NULL;
    dispute = call - agreed when they differ; is_disputed = dispute present.
    """
    x, thr = F.col("base_total_exposure"), F.col("threshold_principal")
    call, agreed, disp = F.col("base_call_amount"), F.col("agreed_amount"), F.col("dispute_amount")
    exp_call = F.when(x > thr, x - thr)
    exp_disp = F.when(call != agreed, call - agreed)
    bad = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    return fact.agg(
        F.count("*").alias("rows_checked"),
        bad(x != F.col("itm_exposure") + F.col("otm_exposure")).alias("exposure_split_breaks"),
        bad(~call.eqNullSafe(exp_call)).alias("call_amount_breaks"),
        bad(~disp.eqNullSafe(exp_disp)).alias("dispute_amount_breaks"),
        bad(F.col("is_disputed") != disp.isNotNull()).alias("dispute_flag_breaks"))


def collateral_value(positions: DataFrame) -> DataFrame:
    """C11: market value x (1 - haircut) per position, summed per agreement and day."""
    cv = F.col("market_value") * (F.lit(1) - F.col("haircut"))
    return (positions.groupBy("agreement_id", "as_of_date")
                     .agg(F.count("*").alias("positions"),
                          F.sum("market_value").cast("decimal(38,2)").alias("market_value"),
                          F.sum(cv).cast("decimal(38,4)").alias("collateral_value")))


def encumbrance_view(buffer: DataFrame, pledged: DataFrame, fx: DataFrame,
                     reporting_currency: str = "USD", taxonomy: DataFrame | None = None) -> DataFrame:
    """Per business date and currency: liquidity buffer, pledged collateral and the
    free remainder, in native and reporting currency.

    Both inputs are summed to the common grain first (no fan-out), then one full
    outer join (null-safe on the grain); the rate comes from a join on (currency, date),
    reduced to one row per key, and a missing or contradictory rate leaves the reporting
    amounts NULL with ``fx_missing`` set. With a ``taxonomy``
    the pledged asset codes are conformed first (A8) and the pledged amount whose
    code has no core mapping is reported as ``pledged_unmapped``.
    """
    g = ["business_date", "currency"]
    zero = F.lit(0).cast("decimal(38,2)")
    b = buffer.groupBy(*g).agg(F.sum("amount").cast("decimal(38,2)").alias("buffer_amount"))
    if taxonomy is not None:
        pledged = conform_values(pledged, "asset_code", taxonomy, "source_system")
        unmapped = F.when(F.col("unmapped"), F.col("amount")).otherwise(F.lit(0))
    else:
        unmapped = F.lit(None).cast("decimal(18,2)")
    p = pledged.groupBy(*g).agg(F.sum("amount").cast("decimal(38,2)").alias("pledged_amount"),
                                F.sum(unmapped).cast("decimal(38,2)").alias("pledged_unmapped"))
    j = full_join(b, p, g).select(
        *g, F.coalesce("buffer_amount", zero).alias("buffer_amount"),
        F.coalesce("pledged_amount", zero).alias("pledged_amount"),
        (F.coalesce("pledged_unmapped", zero) if taxonomy is not None else F.col("pledged_unmapped"))
        .alias("pledged_unmapped"))
    j = j.withColumn("free_amount", (F.col("buffer_amount") - F.col("pledged_amount")).cast("decimal(38,2)"))
    rates = unique_lookup(fx, ["currency", "business_date"], "rate").drop("conflict")
    j = j.join(rates, g, "left")
    rate = F.when(F.col("currency") == reporting_currency, F.lit(1).cast("decimal(10,4)")).otherwise(F.col("rate"))
    rep = lambda c: (F.col(c) * rate).cast("decimal(38,6)")
    return j.select(*g, "buffer_amount", "pledged_amount", "pledged_unmapped", "free_amount",
                    rep("buffer_amount").alias("buffer_reporting"),
                    rep("pledged_amount").alias("pledged_reporting"),
                    rep("free_amount").alias("free_reporting"),
                    rate.isNull().alias("fx_missing"),
                    (F.col("pledged_amount") > F.col("buffer_amount")).alias("over_pledged"))
