"""D. Star schema and safe combination of facts of different grain."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import assert_unique, full_join, left_join_spread


def star_join(fact: DataFrame, dims: list[tuple[DataFrame, str | list[str], str]],
              attributes: list[str] | None = None, validate: bool = True) -> DataFrame:
    """Fact with dimension attributes; the row count must not grow.

    ``validate`` checks each dimension key is unique: a distributed group-by that
    returns at most one offending key, run when this is called, before the lazy
    joins are built. Fact rows without a key are spread, not gathered. Join strategy is left to Catalyst/AQE: dimensions measured small are
    broadcast at runtime, larger ones take a sort-merge join.
    """
    out = fact
    for dim, key, how in dims:
        keys = [key] if isinstance(key, str) else list(key)
        if validate:
            assert_unique(dim, keys)
        out = left_join_spread(out, dim, keys) if how == "left" else out.join(dim, keys, how)
    if attributes is not None:
        out = out.select(*fact.columns, *[a for a in attributes if a not in fact.columns])
    return out


def aggregate_then_join(parts: list[tuple[DataFrame, dict[str, Column]]], grain: list[str]) -> DataFrame:
    """Aggregate every dataset to the common grain, then full-outer join on it
    (null-safe: a NULL key is one group in every dataset, and one row in the result).

    Joining before aggregating would repeat one side's rows once per match on
    the other side (the doubled sum); aggregating first makes every side unique
    on the grain, so the join cannot fan out.
    """
    aggs = [df.groupBy(*grain).agg(*[c.alias(n) for n, c in measures.items()]) for df, measures in parts]
    return reduce(lambda a, b: full_join(a, b, grain), aggs)


def grain_check(df: DataFrame, grain: list[str]) -> DataFrame:
    """D3: keys that occur more than once, and rows with a NULL key part."""
    null_key = reduce(lambda a, b: a | b, [F.col(g).isNull() for g in grain])
    return (df.groupBy(*grain).agg(F.count("*").alias("row_count"))
              .withColumn("null_key", null_key)
              .filter((F.col("row_count") > 1) | F.col("null_key")))


def _key_counts(df: DataFrame, key: list[str], name: str) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])) \
             .groupBy(*key).agg(F.count("*").alias(name))


def fanout_check(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Per key present on both sides, the rows an inner join would yield;
    only keys that multiply the left side (more than one right row) are kept."""
    j = _key_counts(left, key, "left_rows").join(_key_counts(right, key, "right_rows"), key)
    return (j.withColumn("joined_rows", F.col("left_rows") * F.col("right_rows"))
             .filter(F.col("right_rows") > 1))


def fanout_total(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """D4 summary: left rows against the rows an inner join on ``key`` would return."""
    lc = _key_counts(left, key, "left_rows")
    rc = _key_counts(right, key, "right_rows")
    j = lc.join(rc, key, "left")
    return j.agg(F.sum("left_rows").alias("left_rows"),
                 F.sum(F.col("left_rows") * F.col("right_rows")).alias("joined_rows"),
                 F.count(F.when(F.col("right_rows") > 1, 1)).alias("multiplying_keys"))


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key is missing from the dimension; NULL keys are reported
    apart (reason NULL_KEY), since NULL means 'unresolved', not 'orphan'."""
    nulls = fact.filter(F.col(key).isNull()).withColumn("reason", F.lit("NULL_KEY"))
    missing = (fact.filter(F.col(key).isNotNull())
                   .join(dim.select(key).distinct(), key, "left_anti")
                   .withColumn("reason", F.lit("NOT_IN_DIMENSION")))
    return nulls.unionByName(missing)


def flat_daily_fact(facts: list[tuple[DataFrame, dict[str, Column]]], grain: list[str],
                    dims: list[tuple[DataFrame, str | list[str]]]) -> DataFrame:
    """Wide view at one grain. Finer facts are aggregated by D2 first, then
    dimension attributes are attached with left joins (D1 without row loss)."""
    wide = aggregate_then_join(facts, grain)
    for dim, key in dims:
        wide = wide.join(dim, [key] if isinstance(key, str) else list(key), "left")
    return wide


def counterparty_summary(exposure: DataFrame, pfe: DataFrame, dim: DataFrame,
                         key: str = "counterparty_code") -> DataFrame:
    """One row per counterparty: official exposure, peak PFE and region.

    PFE is non-additive: the peak over time is taken per counterparty, never a
    sum or an average of PFEs.
    """
    wide = aggregate_then_join([
        (exposure, {"official_exposure": F.sum("exposure_amount").cast("decimal(38,2)")}),
        (pfe, {"peak_pfe": F.max("pfe")})], [key])
    return wide.join(dim.select(key, F.col("regulatory_regime").alias("region")), key, "left")


def reconcile(a: DataFrame, b: DataFrame, keys: list[str], measure: str,
              tolerance: float = 0.0) -> DataFrame:
    """Full comparison of two products on ``keys``: ONLY_IN_A, ONLY_IN_B,
    DIFFERS (|a - b| > tolerance, or one value NULL) or EQUAL. Both sides are summed
    to the keys first; presence is a flag of the side, never read off its value, and
    NULL keys compare as equal."""
    sa = a.groupBy(*keys).agg(F.sum(measure).cast("decimal(38,2)").alias("value_a"), F.lit(True).alias("in_a"))
    sb = b.groupBy(*keys).agg(F.sum(measure).cast("decimal(38,2)").alias("value_b"), F.lit(True).alias("in_b"))
    va, vb = F.col("value_a"), F.col("value_b")
    diff = (va - vb).cast("decimal(38,2)")
    same = va.eqNullSafe(vb) | (F.abs(diff) <= F.lit(tolerance))
    return full_join(sa, sb, keys).select(
        *keys, "value_a", "value_b", diff.alias("difference"),
        F.when(F.col("in_b").isNull(), F.lit("ONLY_IN_A")).when(F.col("in_a").isNull(), F.lit("ONLY_IN_B"))
         .when(same, F.lit("EQUAL")).otherwise(F.lit("DIFFERS")).alias("status"))
