"""B. Entity resolution: search, rule-based and variant-based matching, queues, trend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import money_sum, name_key, pct
from ..plans.joins import dealt, grown, left_join_spread

# Fixed values of the reference's resolution statuses.
MATCHED_ORIGINAL = "MATCHED_ORIGINAL"
MATCHED_RESOLVED = "MATCHED_RESOLVED"
UNMATCHED = "UNMATCHED"
MATCHED = (MATCHED_ORIGINAL, MATCHED_RESOLVED)
ACTION_INVESTIGATE = "Requires Investigation"

TRADE_COLUMNS = ("trade_id", "trade_date", "counterparty_code", "booked_name", "source_system",
                 "margin_type", "exposure_amount", "call_amount", "resolution_status")


def entity_search(dim: DataFrame, term: str) -> DataFrame:
    """B1: counterparties whose upper-cased search text contains the upper-cased term.

    Plain substring, as in the reference: 'GS' also hits 'HOLDINGS'.
    """
    return (dim.filter(F.upper("entity_search_field").contains(term.upper()))
               .select("counterparty_code", "canonical_name", "entity_search_field"))


def _unique_rules(rules: DataFrame, key: str) -> DataFrame:
    """One row per rule key; a key mapped to two codes is ambiguous and not applied."""
    return (rules.groupBy(key)
                 .agg(F.min("counterparty_code").alias("_rule_code"),
                      F.countDistinct("counterparty_code").alias("_rule_codes"))
                 .filter(F.col("_rule_codes") == 1)
                 .drop("_rule_codes"))


def _apply_rules(trades: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    r = _unique_rules(rules.select(key, "counterparty_code"), key)
    j = trades.join(r, on=key, how="left")
    hit = F.col("_rule_code").isNotNull()
    out = [F.when(hit, F.col("_rule_code")).otherwise(F.col("counterparty_code")).alias("counterparty_code")
           if c == "counterparty_code" else
           F.when(hit, F.lit(MATCHED_RESOLVED)).otherwise(F.col("resolution_status")).alias("resolution_status")
           if c == "resolution_status" else F.col(c)
           for c in trades.columns]
    return j.select(*out)


def resolve_by_name(trades: DataFrame, rules: DataFrame) -> DataFrame:
    """B2: rules (booked_name, counterparty_code) set the code and MATCHED_RESOLVED on every
    trade booked under that exact name, including rows that were already matched."""
    return _apply_rules(trades, rules, "booked_name")


def resolve_by_id(trades: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules (trade_id, counterparty_code), as B2 but by trade id."""
    return _apply_rules(trades, rules, "trade_id")


def reset_resolution(trades: DataFrame, ids: DataFrame) -> DataFrame:
    """Code to NULL and status to UNMATCHED for the listed trade ids."""
    flag = ids.select("trade_id").distinct().withColumn("_reset", F.lit(True))
    j = trades.join(flag, on="trade_id", how="left")
    hit = F.col("_reset").isNotNull()
    out = [F.when(hit, F.lit(None).cast("string")).otherwise(F.col(c)).alias(c) if c == "counterparty_code"
           else F.when(hit, F.lit(UNMATCHED)).otherwise(F.col(c)).alias(c) if c == "resolution_status"
           else F.col(c) for c in trades.columns]
    return j.select(*out)


def extend_search_text(dim: DataFrame, additions: DataFrame) -> DataFrame:
    """Append ' ' + new variants to a counterparty's search text.

    Several additions for one code are de-duplicated and joined in sorted order.
    A NULL search text stays NULL (as SQL concatenation does).
    """
    add = (additions.groupBy("counterparty_code")
                    .agg(F.array_join(F.array_sort(F.collect_set("text")), " ").alias("_add")))
    j = dim.join(add, on="counterparty_code", how="left")
    new = F.when(F.col("_add").isNotNull(),
                 F.concat(F.col("entity_search_field"), F.lit(" "), F.col("_add"))) \
           .otherwise(F.col("entity_search_field"))
    return j.select(*[new.alias(c) if c == "entity_search_field" else F.col(c) for c in dim.columns])


def _variant_lookup(variants: DataFrame, key_col: Column) -> DataFrame:
    """Per lookup key: the single code it maps to (NULL if two), canonical spelling, ambiguity."""
    return (variants.select(key_col.alias("_k"), "counterparty_code", "variant_name", "is_canonical")
                    .filter(F.col("_k").isNotNull()).groupBy("_k")
                    .agg(F.countDistinct("counterparty_code").alias("_codes"),
                         F.min("counterparty_code").alias("_code"),
                         F.collect_set(F.when(F.col("is_canonical"), F.col("variant_name"))).alias("_canon")))


def variant_lookup(variants: DataFrame, normalised: bool = False) -> DataFrame:
    """The lookup B6 (exact names) or B7 (``normalised`` keys) joins against: one row
    per spelling/key. Build it once and persist it when it is reused (streams)."""
    return _variant_lookup(variants, name_key("variant_name") if normalised else F.col("variant_name"))


def _resolve(trades: DataFrame, variants: DataFrame, probe: Column, key_col: Column | None,
             lookup: DataFrame | None = None) -> DataFrame:
    lk = lookup if lookup is not None else _variant_lookup(variants, key_col)
    j = left_join_spread(trades.withColumn("_k", probe), lk, ["_k"])
    single = F.col("_codes") == 1
    canonical = F.array_contains(F.col("_canon"), F.col("booked_name"))
    status = (F.when(single & canonical, F.lit(MATCHED_ORIGINAL))
               .when(single, F.lit(MATCHED_RESOLVED))
               .otherwise(F.lit(UNMATCHED)))
    cols = [c for c in trades.columns if c not in ("counterparty_code", "resolution_status")]
    return j.select(*cols,
                    F.when(single, F.col("_code")).alias("counterparty_code"),
                    status.alias("resolution_status"),
                    F.coalesce(F.col("_codes") > 1, F.lit(False)).alias("is_ambiguous"))


def resolve_with_lookup(trades: DataFrame, lookup: DataFrame, normalised: bool = False) -> DataFrame:
    """B6/B7 against a prebuilt ``variant_lookup``."""
    probe = name_key("booked_name") if normalised else F.col("booked_name")
    return _resolve(trades, None, probe, None, lookup)


def resolve_by_variant(trades: DataFrame, variants: DataFrame) -> DataFrame:
    """Exact lookup of the booked name in the variant table.

    Canonical hit -> MATCHED_ORIGINAL, other hit -> MATCHED_RESOLVED, no hit ->
    UNMATCHED with a NULL code. A name that maps to two codes stays UNMATCHED
    and is flagged ``is_ambiguous``: one is never picked silently.
    """
    return _resolve(trades, variants, F.col("booked_name"), F.col("variant_name"))


def resolve_by_key(trades: DataFrame, variants: DataFrame) -> DataFrame:
    """As B6 but on the normalised ``name_key`` of both sides."""
    return _resolve(trades, variants, name_key("booked_name"), name_key("variant_name"))


def _deletion_neighbourhood(key: Column, d: int) -> Column:
    """All strings made by deleting up to ``d`` characters from ``key`` (with repeats).

    Built with higher-order array functions, so it runs JVM-side. Size is
    sum_{i<=d} C(len, i) per string; intended for d <= 2.
    """
    hood = F.array(key)
    for _ in range(d):
        hood = F.flatten(F.transform(
            hood, lambda s: F.array_union(
                F.array(s),
                F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))),
                            lambda i: F.concat(F.substring(s, 1, i - 1), F.substring(s, i + 1, F.length(s)))))))
    return F.array_distinct(hood)


def fuzzy_candidates(names: DataFrame, variants: DataFrame, max_distance: int = 1,
                     k: int = 1) -> DataFrame:
    """Best variant matches within ``max_distance`` edits, for OCR-type misspellings.

    Exact, never a cross join: two keys within d edits share a string obtained
    by deleting at most d characters from each (symmetric deletion), so pairs are
    generated by an equi-join on deletion strings and then verified with
    ``levenshtein``. Names are de-duplicated first; names without a key have no candidates. Every candidate at the k best
    distances is kept (ties included); ``n_codes`` > 1 marks an ambiguous name.
    """
    probe = (names.select(F.col("booked_name")).distinct()
                  .withColumn("probe_key", name_key("booked_name")).filter(F.col("probe_key").isNotNull()))
    vkeys = (variants.select(name_key("variant_name").alias("variant_key"), "counterparty_code")
                     .filter(F.col("variant_key").isNotNull()).distinct())
    exact = None
    if k == 1:
        # With k = 1 a name that has an exact key hit keeps only distance-0 candidates,
        # so the edit-distance search runs on the remaining names only.
        exact = (probe.join(grown(vkeys), probe["probe_key"] == vkeys["variant_key"])
                      .select("booked_name", "probe_key", "variant_key", "counterparty_code",
                              F.lit(0).cast("bigint").alias("distance")))
        probe = probe.join(grown(exact.select("booked_name").distinct()), "booked_name", "left_anti")
    p_del = dealt(probe, "booked_name").select("booked_name", "probe_key",
                         F.explode(_deletion_neighbourhood(F.col("probe_key"), max_distance)).alias("_del"))
    v_del = dealt(vkeys, "variant_key").select("variant_key", "counterparty_code",
                         F.explode(_deletion_neighbourhood(F.col("variant_key"), max_distance)).alias("_del"))
    pairs = (p_del.join(grown(v_del), "_del")
                  .select("booked_name", "probe_key", "variant_key", "counterparty_code")
                  .distinct()
                  .withColumn("distance", F.levenshtein("probe_key", "variant_key").cast("bigint"))
                  .filter(F.col("distance") <= max_distance))
    if exact is not None:
        pairs = pairs.unionByName(exact)
    w = Window.partitionBy("booked_name").orderBy("distance")
    ranked = pairs.withColumn("match_rank", F.dense_rank().over(w).cast("bigint")).filter(F.col("match_rank") <= k)
    per_name = Window.partitionBy("booked_name")
    return ranked.withColumn("n_codes", F.size(F.collect_set("counterparty_code").over(per_name)).cast("bigint"))


def exceptions_queue(trades: DataFrame) -> DataFrame:
    """Unmatched trades needing investigation, largest exposure first."""
    return (trades.filter(F.col("resolution_status") == UNMATCHED)
                  .select("trade_id", "trade_date", "booked_name", "source_system",
                          "exposure_amount", "call_amount",
                          F.lit(ACTION_INVESTIGATE).alias("action_required"))
                  .orderBy(F.col("exposure_amount").desc(), "trade_id"))


def unmatched_by_name(trades: DataFrame) -> DataFrame:
    """Count and exposure per unresolved booked name, largest first."""
    return (trades.filter(F.col("resolution_status") == UNMATCHED)
                  .groupBy("booked_name")
                  .agg(F.count("*").alias("trade_count"),
                       money_sum("exposure_amount").alias("total_exposure"))
                  .orderBy(F.col("total_exposure").desc(), "booked_name"))


def resolution_breakdown(trades: DataFrame) -> DataFrame:
    """Count and exposure per resolution status."""
    return (trades.groupBy("resolution_status")
                  .agg(F.count("*").alias("trade_count"),
                       money_sum("exposure_amount").alias("total_exposure"))
                  .orderBy("resolution_status"))


def resolution_trend(trades: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Monthly resolution trend.

    Trades are first reduced to one row per trade date (map-side combine), so
    only dates cross the join with the small date dimension. Trades whose date is
    missing from the dimension drop out, as in the reference's inner join.
    """
    matched = F.col("resolution_status").isin(*MATCHED)
    unmatched = F.col("resolution_status") == UNMATCHED
    amt = F.col("exposure_amount")
    per_date = trades.groupBy("trade_date").agg(
        F.count("trade_id").alias("n_total"),
        F.count(F.when(matched, 1)).alias("n_matched"),
        F.count(F.when(unmatched, 1)).alias("n_unmatched"),
        F.sum(F.when(matched, amt).otherwise(0)).alias("x_matched"),
        F.sum(F.when(unmatched, amt).otherwise(0)).alias("x_lost"),
        F.sum(amt).alias("x_total"))
    # the date dimension is one row per date; AQE broadcasts it from its measured size
    dates = dim_date.select("trade_date", "month_name", "month_number", "year_number")
    j = per_date.join(dates, "trade_date")
    m = j.groupBy("month_name", "month_number", "year_number").agg(
        F.sum("n_total").alias("total_trades"), F.sum("n_matched").alias("matched_trades"),
        F.sum("n_unmatched").alias("unmatched_trades"), F.sum("x_matched").alias("xm"),
        F.sum("x_lost").alias("xl"), F.sum("x_total").alias("xt"))
    mil = lambda c: F.round(F.col(c).cast("double") / 1000000.0, 1)
    return (m.select("month_name", "month_number", "year_number",
                     "total_trades", "matched_trades", "unmatched_trades",
                     mil("xm").alias("matched_exposure_m"), mil("xl").alias("lost_exposure_m"),
                     mil("xt").alias("total_exposure_m"),
                     pct("matched_trades", "total_trades").alias("resolution_rate_pct"),
                     pct("xl", "xt").alias("lost_exposure_pct"))
              .orderBy("year_number", "month_number"))


def own_entity(legal_entity: DataFrame) -> DataFrame:
    """One row per counterparty: its non-parent entity, that of the least LEI where it has
    several (D3 ``grain_check`` lists those). A join on it cannot fan out."""
    names = [c for c in ("lei_code", "ultimate_parent_name", "legal_entity_name") if c in legal_entity.columns]
    return (legal_entity.filter(~F.col("is_ultimate_parent")).groupBy("counterparty_code")
                        .agg(F.min(F.struct(*names)).alias("_e"))
                        .select("counterparty_code", *[F.col(f"_e.{c}").alias(c) for c in names if c != "lei_code"]))


def parent_lookup(df: DataFrame, legal_entity: DataFrame) -> DataFrame:
    """Attach the ultimate parent, reading only non-parent entity rows; a row of
    ``df`` comes out once, whatever its counterparty's number of entities (``own_entity``)."""
    return df.join(own_entity(legal_entity), "counterparty_code")


def parent_rollup(df: DataFrame, legal_entity: DataFrame, measure: str = "exposure_amount") -> DataFrame:
    """Subtotals parent -> legal entity -> counterparty, plus the grand total.

    The fact is reduced to counterparty grain before the join and the rollup,
    so the rollup's row expansion runs on counterparties, not on trades.
    """
    per_cp = df.groupBy("counterparty_code").agg(F.sum(measure).alias("_m"), F.count("*").alias("_n"))
    j = parent_lookup(per_cp, legal_entity)
    return (j.rollup("ultimate_parent_name", "legal_entity_name", "counterparty_code")
             .agg(F.sum("_m").cast("decimal(38,2)").alias("total_exposure"),
                  F.sum("_n").alias("trade_count"),
                  F.grouping_id().cast("int").alias("rollup_level")))
