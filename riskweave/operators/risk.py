"""H. Credit-risk measures as set-based jobs over curves, cash flows and paths.

Inputs are tables produced elsewhere (quotes, cash flows, revalued paths);
nothing here simulates or bootstraps. All arithmetic is built-in column
expressions; windows are always partitioned by curve or netting set and hold
one row per tenor or time point.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.joins import full_join, unique_lookup
from ..session import ensure_checkpoint_dir

# Fixed tenor buckets for sensitivity reports (upper bounds in years, inclusive).
TENOR_BUCKETS = (("0-1Y", 1.0), ("1-5Y", 5.0), ("5-10Y", 10.0), ("10Y+", None))


def curve_segments(quotes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Consecutive quote pairs of each curve: [tenor_y, t_hi) with their spreads."""
    keys = ["curve_id", *(by or [])]
    w = Window.partitionBy(*keys).orderBy("tenor_y")
    return quotes.select(*keys, "tenor_y", "spread_bp",
                         F.lead("tenor_y").over(w).alias("t_hi"),
                         F.lead("spread_bp").over(w).alias("s_hi"),
                         (F.row_number().over(w) == 1).alias("is_first"))


def _interpolated(t: Column) -> Column:
    lo, hi, s_lo, s_hi = F.col("_t_lo"), F.col("t_hi"), F.col("_s_lo"), F.col("s_hi")
    return F.when(hi.isNull() | (t < lo), s_lo).otherwise(s_lo + (s_hi - s_lo) * (t - lo) / (hi - lo))


def interpolate_curve(points: DataFrame, quotes: DataFrame, tenor: str = "tenor_y",
                      out: str = "spread_bp", by: list[str] | None = None) -> DataFrame:
    """H1: spread at any tenor, linear between neighbouring quotes, flat outside.

    An equi-join on the curve (segments are few per curve and broadcast when
    measured small by AQE) plus a range predicate picks the one covering segment: never
    a bare range join. ``by`` carries extra curve keys such as a scenario; each
    point then gets one value per scenario.
    """
    seg = (curve_segments(quotes, by)
           .withColumnsRenamed({"curve_id": "_cid", "tenor_y": "_t_lo", "spread_bp": "_s_lo"}))
    t = F.col(tenor).cast("double")
    cover = ((t >= F.col("_t_lo")) & (F.col("t_hi").isNull() | (t < F.col("t_hi")))) | \
            (F.col("is_first") & (t < F.col("_t_lo")))
    j = points.join(seg, (F.col("curve_id") == F.col("_cid")) & cover, "left")
    return j.withColumn(out, _interpolated(t)).drop("_cid", "_t_lo", "_s_lo", "t_hi", "s_hi", "is_first")


def shock_curve(quotes: DataFrame, shocks=(("base", 0.0), ("cs_1bp", 1.0))) -> DataFrame:
    """H2: one copy of every quote per scenario, shifted by the scenario's bp."""
    arr = F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(float(s)).alias("shift_bp")) for n, s in shocks])
    return (quotes.select("*", F.explode(arr).alias("_s"))
                  .select(*quotes.columns, "_s.scenario", "_s.shift_bp")
                  .withColumn("spread_bp", F.col("spread_bp") + F.col("shift_bp")))


def stress_curves(quotes: DataFrame, shocks: DataFrame, base: str = "base") -> DataFrame:
    """H2 with named stress sets: one copy of every quote per set of ``shocks``, and one as quoted (``base``).

    shocks: (scenario, curve_id, tenor_from, tenor_to, shift_bp, shift_pct), a row a shocked part
    of the curves; a NULL curve_id is every curve, a NULL end of the tenors is open, both ends
    belong to it. The names of the sets are read when this is called. Parts of a set that overlap add up: spread x (1 + sum of shift_pct / 100) + sum of
    shift_bp, and ``shift_bp`` of the result is the change of the spread. Sets are few; quotes are
    joined with the parts of their set, those of one curve and those of all by keys of their own.
    """
    names = sorted({r["scenario"] for r in shocks.select("scenario").filter("scenario IS NOT NULL").distinct().collect()} - {base})
    copies = quotes.select("*", F.explode(F.array(*[F.lit(n) for n in (base, *names)])).alias("scenario"))
    parts = shocks.select("scenario", F.col("curve_id").alias("_curve"), F.coalesce("tenor_from", F.lit(float("-inf"))).alias("_from"),
                          F.coalesce("tenor_to", F.lit(float("inf"))).alias("_to"), F.coalesce("shift_bp", F.lit(0.0)).alias("_bp"),
                          F.coalesce("shift_pct", F.lit(0.0)).alias("_pct"))
    inside = (F.col("tenor_y") >= F.col("_from")) & (F.col("tenor_y") <= F.col("_to"))
    hit = lambda j: j.filter(inside).select("curve_id", "tenor_y", "scenario", "_bp", "_pct")
    keyed = copies.select("curve_id", "tenor_y", "scenario").distinct()
    own = hit(keyed.join(parts.filter("_curve IS NOT NULL").withColumnRenamed("_curve", "curve_id"), ["scenario", "curve_id"]))
    every = hit(keyed.join(parts.filter("_curve IS NULL").drop("_curve"), "scenario"))
    moved = own.unionByName(every).groupBy("curve_id", "tenor_y", "scenario").agg(F.sum("_bp").alias("_bp"), F.sum("_pct").alias("_pct"))
    shift = F.coalesce(F.col("spread_bp") * F.col("_pct") / 100 + F.col("_bp"), F.lit(0.0))
    out = full_join(copies, moved, ["curve_id", "tenor_y", "scenario"], "left").withColumn("shift_bp", shift)
    return out.select(*[(F.col("spread_bp") + F.col("shift_bp")).alias(c) if c == "spread_bp" else F.col(c) for c in quotes.columns],
                      "scenario", "shift_bp")


def stressed_values(values: DataFrame, key: str = "trade_id", value: str = "pv", base: str = "base") -> DataFrame:
    """Per key and stress set: the value under the set, as quoted, and the change (H7 for many sets at once)."""
    s = F.col("scenario")
    both = values.groupBy(key, "scenario").agg(F.sum(value).alias("stressed_value"))
    quoted = both.filter(s == base).select(key, F.col("stressed_value").alias("base_value"))
    return (full_join(both.filter(s != base), quoted, [key], "left")
            .withColumn("change", F.col("stressed_value") - F.col("base_value")))


def survival_curve(quotes: DataFrame, recovery: float = 0.4) -> DataFrame:
    """H3: intensity = spread / (1 - R); survival = exp(-intensity * t)."""
    h = F.col("spread_bp") / 10000.0 / (1.0 - recovery)
    return (quotes.withColumn("hazard", h)
                  .withColumn("survival", F.exp(-F.col("hazard") * F.col("tenor_y"))))


def incremental_pd(survival: DataFrame, by: list[str] | None = None) -> DataFrame:
    """H4: S(previous) - S(current) along each curve; the first point is taken against 1."""
    w = Window.partitionBy("curve_id", *(by or [])).orderBy("tenor_y")
    return survival.withColumn("dpd", F.lag("survival", 1, 1.0).over(w) - F.col("survival"))


def default_probabilities(quotes: DataFrame, times: DataFrame, recovery: float = 0.4,
                          by: list[str] | None = None) -> DataFrame:
    """Survival and incremental PD of each curve on the time grid in ``times``
    (curve_id, tenor_y): H1 interpolation, then H3 and H4."""
    pts = interpolate_curve(times, quotes, by=by)
    return incremental_pd(survival_curve(pts, recovery), by=by)


def discounted_pv(cashflows: DataFrame, quotes: DataFrame, risk_free: float = 0.04,
                  by: list[str] | None = None) -> DataFrame:
    """H5: PV = sum(amount x DF) per trade (and scenario), DF = (1 + r + s(t))^-t with
    s(t) the spread of the trade's curve interpolated at the cash-flow time.

    Flows whose curve has no quote are not in the PV: ``flows_without_curve`` and
    ``amount_without_curve`` say how many and how much.
    """
    cf = interpolate_curve(cashflows, quotes, tenor="time_y", out="_s", by=by)
    df = F.pow(F.lit(1.0 + risk_free) + F.col("_s") / 10000.0, -F.col("time_y"))
    lost = F.col("_s").isNull()
    return (cf.groupBy("trade_id", *(by or []))
              .agg(F.sum(F.col("amount").cast("double") * df).alias("pv"),
                   F.count(F.when(lost, 1)).alias("flows_without_curve"),
                   F.coalesce(F.sum(F.when(lost, F.col("amount").cast("double"))), F.lit(0.0)).alias("amount_without_curve")))


def discounted_pv_by_scenario(cashflows: DataFrame, quotes: DataFrame, scenarios: list[str],
                              risk_free: float = 0.04) -> DataFrame:
    """H5 for several curve scenarios at once, one column ``pv_<scenario>`` each.

    The scenario split is a conditional sum inside one aggregation on trade_id,
    so the cash flows cross the network once (partially aggregated), instead of
    a shuffle on (trade, scenario) followed by another on trade.
    """
    cf = interpolate_curve(cashflows, quotes, tenor="time_y", out="_s", by=["scenario"])
    term = F.col("amount").cast("double") * F.pow(F.lit(1.0 + risk_free) + F.col("_s") / 10000.0, -F.col("time_y"))
    return cf.groupBy("trade_id").agg(
        *[F.sum(F.when(F.col("scenario") == s, term)).alias(f"pv_{s}") for s in scenarios],
        F.count(F.when(F.col("_s").isNull(), 1)).alias("flows_without_curve"))


def cds_legs(quotes: DataFrame, maturity: int = 5, recovery: float = 0.4,
             risk_free: float = 0.04) -> DataFrame:
    """H6: per curve, a CDS with annual payments to ``maturity`` paying the curve's
    spread at maturity. Premium leg = sum(c * accrual * DF * S), protection leg =
    (1 - R) * sum(DF * dPD); value for the protection buyer = protection - premium
    (per unit notional)."""
    curves = quotes.select("curve_id").distinct()
    grid = curves.select("curve_id", F.explode(F.transform(F.sequence(F.lit(1), F.lit(maturity)),
                                             lambda x: x.cast("double"))).alias("tenor_y"))
    pd_ = default_probabilities(quotes, grid, recovery)
    w = Window.partitionBy("curve_id")
    c = F.max(F.when(F.col("tenor_y") == float(maturity), F.col("spread_bp"))).over(w) / 10000.0
    dfac = F.pow(F.lit(1.0 + risk_free), -F.col("tenor_y"))
    legs = pd_.select("curve_id", (c * 1.0 * dfac * F.col("survival")).alias("_prem"),
                      (dfac * F.col("dpd")).alias("_prot"))
    out = legs.groupBy("curve_id").agg(F.sum("_prem").alias("premium_leg"),
                                       (F.sum("_prot") * (1.0 - recovery)).alias("protection_leg"))
    return out.withColumn("buyer_value", F.col("protection_leg") - F.col("premium_leg"))


def cs01(values: DataFrame, base: str = "base", shocked: str = "cs_1bp", key: str = "trade_id",
         value: str = "pv") -> DataFrame:
    """H7: shocked value - base value per key, by conditional aggregation (no pivot shuffle)."""
    v = F.col(value)
    return (values.groupBy(key)
                  .agg(F.sum(F.when(F.col("scenario") == base, v)).alias("base_value"),
                       F.sum(F.when(F.col("scenario") == shocked, v)).alias("shocked_value"))
                  .withColumn("cs01", F.col("shocked_value") - F.col("base_value")))


def tenor_bucket(t) -> Column:
    t = F.col(t) if isinstance(t, str) else t
    expr = None
    for name, upper in TENOR_BUCKETS:
        cond = F.lit(True) if upper is None else (t <= upper)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def aggregate_sensitivity(sens: DataFrame, by: list[str], value: str = "cs01") -> DataFrame:
    """H8: signed net (and gross) sensitivity by the given keys; ``tenor_bucket``
    may be named in ``by`` and is derived from ``tenor_y``."""
    df = sens.withColumn("tenor_bucket", tenor_bucket("tenor_y")) if "tenor_bucket" in by else sens
    return df.groupBy(*by).agg(F.sum(value).alias("net_cs01"), F.sum(F.abs(value)).alias("gross_cs01"),
                               F.count("*").alias("positions"))


def sensitivity_hierarchy(sens: DataFrame, levels: list[str], value: str = "cs01") -> DataFrame:
    """H8 with subtotals: net sensitivity at every prefix of ``levels`` plus the grand
    total (SQL ROLLUP), tagged by ``grouping_id``.

    The fact is reduced to the finest grain first, so the rollup's row expansion
    (one copy per level) runs on aggregated rows, not on the sensitivity fact.
    """
    df = sens.withColumn("tenor_bucket", tenor_bucket("tenor_y")) if "tenor_bucket" in levels else sens
    fine = df.groupBy(*levels).agg(F.sum(value).alias("_net"), F.count("*").alias("_n"))
    return (fine.rollup(*levels)
                .agg(F.sum("_net").alias("net_cs01"), F.sum("_n").alias("positions"),
                     F.grouping_id().cast("int").alias("rollup_level")))


def net_exposure(values: DataFrame) -> DataFrame:
    """H9: max(sum of values, 0) per netting set, scenario, path and time (net, then floor)."""
    return (values.groupBy("netting_set", "scenario", "path_id", "time_y")
                  .agg(F.sum("value").cast("decimal(38,2)").alias("net_value"))
                  .withColumn("exposure", F.greatest(F.col("net_value"), F.lit(0).cast("decimal(38,2)"))))


def exposure_profile(net: DataFrame, n_paths: int, level: float = 0.95) -> DataFrame:
    """Per netting set, scenario and time: EE = mean over all ``n_paths`` paths,
    PFE = linear percentile at ``level``, MTM = mean net value; peak PFE = max over time.

    A path with no row counts as exposure 0. After H9 a group holds at most one
    value per path, so the values are gathered into a bounded array, padded with
    zeros for absent paths, sorted, and the percentile read off by position:
    one shuffle, no grid join.
    """
    g = ["netting_set", "scenario", "time_y"]
    agg = net.groupBy(*g).agg(F.collect_list(F.col("exposure").cast("double")).alias("_v"),
                              F.sum("exposure").alias("_sum"), F.sum("net_value").alias("_mtm"))
    # more values than paths means the input was not netted per path (H9): fail loudly
    agg = agg.withColumn("_v", F.when(F.size("_v") <= n_paths, F.col("_v")).otherwise(
        F.raise_error(F.lit(f"more than {n_paths} values in one exposure group; net per path first"))))
    pad = F.array_repeat(F.lit(0.0), F.lit(n_paths) - F.size("_v"))
    vals = F.array_sort(F.concat("_v", pad))
    pos = F.lit(level * (n_paths - 1))
    lo_i, hi_i = F.floor(pos).cast("int"), F.ceil(pos).cast("int")
    lo_v, hi_v = F.element_at(vals, lo_i + 1), F.element_at(vals, hi_i + 1)
    pfe = lo_v + (hi_v - lo_v) * (pos - lo_i)
    prof = agg.select(*g, (F.col("_sum").cast("double") / n_paths).alias("ee"), pfe.alias("pfe"),
                      (F.col("_mtm").cast("double") / n_paths).alias("mtm"), F.lit(level).alias("level"))
    w = Window.partitionBy("netting_set", "scenario")
    return prof.withColumn("peak_pfe", F.max("pfe").over(w))


def stressed_pfe(profile: DataFrame, valuation_date: str, base: str = "base",
                 stressed: str = "stressed") -> DataFrame:
    """Base and stressed PFE, EE and MTM side by side per netting set and time, with
    the difference; the output always carries level and valuation date."""
    s = F.col("scenario")
    mtm = [F.max(F.when(s == v, F.col("mtm"))).alias(f"{n}_mtm") for n, v in (("base", base), ("stressed", stressed))
           if "mtm" in profile.columns]
    out = profile.groupBy("netting_set", "time_y", "level").agg(
        *mtm,
        F.max(F.when(s == base, F.col("pfe"))).alias("base_pfe"),
        F.max(F.when(s == stressed, F.col("pfe"))).alias("stressed_pfe"),
        F.max(F.when(s == base, F.col("ee"))).alias("base_ee"),
        F.max(F.when(s == stressed, F.col("ee"))).alias("stressed_ee"))
    return (out.withColumn("pfe_increase", F.col("stressed_pfe") - F.col("base_pfe"))
               .withColumn("valuation_date", F.lit(valuation_date).cast("date")))


def cva(profile: DataFrame, dpd: DataFrame, lgd: float = 0.6, risk_free: float = 0.04,
        by: list[str] | None = None) -> DataFrame:
    """CVA = sum over time of EE x dPD x LGD x DF per netting set.

    ``profile`` carries (netting_set, curve_id, time_y, ee); ``dpd`` carries
    (curve_id, tenor_y, dpd) on the same time grid (from ``default_probabilities``).
    Exposure without a PD is not in the CVA: ``times_without_pd`` and ``ee_without_pd``
    say how many points and how much. With ``by`` such rows have NULL there.
    """
    keys = ["curve_id", *(by or [])]
    p = dpd.select(*keys, F.col("tenor_y").alias("time_y"), "dpd")
    j = profile.join(p, ["curve_id", "time_y"], "left")
    dfac = F.pow(F.lit(1.0 + risk_free), -F.col("time_y"))
    lost = F.col("dpd").isNull()
    return (j.groupBy("netting_set", *(by or []))
             .agg(F.sum(F.col("ee") * F.col("dpd") * lgd * dfac).alias("cva"),
                  F.count(F.when(lost, 1)).alias("times_without_pd"),
                  F.coalesce(F.sum(F.when(lost, F.col("ee"))), F.lit(0.0)).alias("ee_without_pd")))


def cva_on_quotes(profile: DataFrame, quotes: DataFrame, lgd: float = 0.6, recovery: float = 0.4,
                  risk_free: float = 0.04) -> DataFrame:
    """H12 from quotes: PDs on the profile's own time grid. The profile gives the grid and
    the exposure, so it is written once (``checkpoint``, when this is called) and its
    paths are netted once."""
    ensure_checkpoint_dir(profile.sparkSession)
    profile = profile.checkpoint()
    grid = profile.select("curve_id", F.col("time_y").alias("tenor_y")).distinct()
    return cva(profile, _quoted(default_probabilities(quotes, grid, recovery)), lgd, risk_free)


def _quoted(dpd: DataFrame) -> DataFrame:
    """PDs of curves that have quotes (a grid time of another curve has no spread)."""
    return dpd.filter(F.col("spread_bp").isNotNull())


def cva_cs01(profile: DataFrame, quotes: DataFrame, lgd: float = 0.6, recovery: float = 0.4,
             risk_free: float = 0.04, shift_bp: float = 1.0) -> DataFrame:
    """CVA on the curve shifted by ``shift_bp`` minus CVA on the base curve, same
    exposure, both scenarios in one job (never built from trade CS01). Exposure without a
    PD is counted as in H12; the profile is written once, as in ``cva_on_quotes``."""
    ensure_checkpoint_dir(profile.sparkSession)
    profile = profile.checkpoint()
    shocked = shock_curve(quotes, (("base", 0.0), ("shocked", shift_bp))).drop("shift_bp")
    grid = profile.select("curve_id", F.col("time_y").alias("tenor_y")).distinct()
    dpd = _quoted(default_probabilities(shocked, grid, recovery, by=["scenario"]))
    c = cva(profile, dpd, lgd, risk_free, by=["scenario"])
    s = F.col("scenario")
    return (c.groupBy("netting_set")
             .agg(F.sum(F.when(s == "base", F.col("cva"))).alias("cva_base"),
                  F.sum(F.when(s == "shocked", F.col("cva"))).alias("cva_shocked"),
                  F.sum("times_without_pd").alias("times_without_pd"), F.sum("ee_without_pd").alias("ee_without_pd"))
             .withColumn("cva_cs01", F.col("cva_shocked") - F.col("cva_base")))


def weighted_capital(sens: DataFrame, weights: DataFrame, rho: float | DataFrame, bucket: str = "curve_id",
                     factor: str = "tenor_bucket", value: str = "cs01") -> DataFrame:
    """WS_k = s_k x w_k per risk factor, then K_b = sqrt(sum_k sum_l rho_kl WS_k WS_l).

    ``rho`` is a table (factor_k, factor_l, rho; both orders listed, a factor with itself
    counts 1, a pair that is not listed 0), or one number for all pairs of distinct
    factors. Sensitivities are netted per factor first, so a bucket has a row a factor
    and the double sum is two small joins. A factor without a weight, or with two that
    differ, is not in the capital: ``factors_without_weight`` and
    ``sensitivity_without_weight`` tell; a bucket of such factors alone has a capital of 0. A weight or correlation listed twice counts once;
    two that differ for one pair leave the capital of its buckets NULL.
    """
    s = sens.withColumn("tenor_bucket", tenor_bucket("tenor_y")) if factor == "tenor_bucket" else sens
    per = s.groupBy(bucket, factor).agg(F.sum(value).alias("net_sensitivity"))
    ws = per.join(unique_lookup(weights, [factor], "risk_weight"), factor, "left").select(
        bucket, factor, "net_sensitivity", (F.col("net_sensitivity") * F.col("risk_weight")).alias("ws"))
    lost = F.col("ws").isNull()
    k = ws.groupBy(bucket).agg(
        F.coalesce(F.sum(F.col("ws") ** 2), F.lit(0.0)).alias("_sq"), F.sum("ws").alias("ws_total"), F.count("ws").alias("factors"),
        F.count(F.when(lost, 1)).alias("factors_without_weight"),
        F.coalesce(F.sum(F.when(lost, F.abs("net_sensitivity"))), F.lit(0.0)).alias("sensitivity_without_weight"))
    if isinstance(rho, DataFrame):
        pairs = (unique_lookup(rho.filter(F.col("factor_k") != F.col("factor_l")), ["factor_k", "factor_l"], "rho")
                 .select(F.col("factor_k").alias(factor), "factor_l", "rho", "conflict"))
        met = ws.join(pairs, factor).groupBy(bucket, F.col("factor_l").alias(factor)).agg(
            F.sum(F.col("ws") * F.col("rho")).alias("_met"), F.max("conflict").alias("_odd"))
        cross = full_join(ws.filter("ws IS NOT NULL"), met, [bucket, factor], "inner").groupBy(bucket).agg(
            F.sum(F.col("ws") * F.col("_met")).alias("_cross"), F.max("_odd").alias("_odd"))
        k = full_join(k, cross, [bucket], "left")
        k2 = F.when(~F.coalesce("_odd", F.lit(False)), F.col("_sq") + F.coalesce("_cross", F.lit(0.0)))
    else:
        k2 = (1.0 - rho) * F.col("_sq") + rho * F.coalesce("ws_total", F.lit(0.0)) ** 2
    return k.select(bucket, "ws_total", "factors", F.when(k2.isNotNull(), F.sqrt(F.greatest(k2, F.lit(0.0)))).alias("bucket_capital"),
                    "factors_without_weight", "sensitivity_without_weight")


def factor_moves(points: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Spread move (bp) between two curve sets at each (curve, tenor) of ``points``: give the
    distinct points (a small table), not the sensitivities."""
    p = interpolate_curve(points, before, out="_s0")
    p = interpolate_curve(p, after, out="_s1")
    return p.withColumn("move_bp", F.col("_s1") - F.col("_s0")).drop("_s0", "_s1")


def pnl_explain(sens: DataFrame, moves: DataFrame, actual: DataFrame, key: str = "trade_id") -> DataFrame:
    """Predicted P&L = sum(sensitivity x factor move) per trade; unexplained =
    actual - predicted. ``actual`` is summed to the trade first (D2), so it never
    multiplies with the sensitivity rows.

    ``moves`` is a (curve_id, tenor_y, move_bp) table (``factor_moves``); a point listed
    twice counts once. Sensitivities without a move, or with two that differ, are not in
    the prediction: ``sens_without_move`` counts them. Rows without a trade are one trade.
    """
    sens = sens.join(unique_lookup(moves, ["curve_id", "tenor_y"], "move_bp"), ["curve_id", "tenor_y"], "left")
    pred = sens.groupBy(key).agg(F.sum(F.col("cs01") * F.col("move_bp")).alias("predicted_pnl"),
                                 F.count(F.when(F.col("move_bp").isNull(), 1)).alias("sens_without_move"))
    act = actual.groupBy(key).agg(F.sum("pnl").alias("actual_pnl"))
    j = full_join(pred, act, [key])
    return j.withColumn("sens_without_move", F.coalesce("sens_without_move", F.lit(0).cast("long"))).withColumn(
        "unexplained_pnl", F.coalesce("actual_pnl", F.lit(0.0)) - F.coalesce("predicted_pnl", F.lit(0.0)))
