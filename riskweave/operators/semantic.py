"""E. A semantic layer over DataFrames, driven by a data-contract dict.

The contract is small metadata held on the driver; its rules are checked
before any job starts and then become ordinary filters and aggregates:

    {"product_id": str, "grain": [...], "allowed": [...], "blocked": [...],
     "default_filters": ["<SQL predicate>", ...],
     "measures": [{"name", "aggregation", "safe_aggregation", "unit",
                   "numerator", "denominator", "column"}],
     "joinable": [{"product_id", "join_on"}]}

``aggregation`` is one of additive | max | native_grain | ratio.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import assert_unique, left_join_spread


class ContractViolation(ValueError):
    """A request the data contract does not allow."""


def _measure(contract: dict, name: str) -> dict:
    for m in contract.get("measures", []):
        if m["name"] == name:
            return m
    raise ContractViolation(f"measure {name!r} is not in contract {contract.get('product_id')!r}")


def check_dimensions(contract: dict, by: list[str]) -> None:
    """E1 guard: every grouping column must be allowed and not blocked."""
    blocked = set(contract.get("blocked", []))
    allowed = set(contract.get("allowed", [])) | set(contract.get("grain", []))
    for d in by:
        if d in blocked:
            raise ContractViolation(f"dimension {d!r} is blocked")
        if d not in allowed:
            raise ContractViolation(f"dimension {d!r} is not allowed")


def check_safe_aggregation(contract: dict, measure: dict, by: list[str]) -> None:
    """Summing away a grain column is allowed only if the measure lists it as safe.

    Additive measures and ratios of sums are checked; a measure without a list is safe
    over nothing. max may drop any column, and native_grain checks itself (E2).
    """
    if measure.get("aggregation") not in ("additive", "ratio"):
        return
    safe = set(measure.get("safe_aggregation", []))
    dropped = [g for g in contract.get("grain", []) if g not in by]
    unsafe = [g for g in dropped if g not in safe]
    if unsafe:
        raise ContractViolation(f"measure {measure['name']!r} cannot be summed over {unsafe}")


def aggregation_expr(contract: dict, measure: dict, by: list[str]) -> Column:
    """The aggregate a measure's rule permits at grouping ``by``."""
    rule = measure.get("aggregation")
    col = F.col(measure.get("column", measure["name"]))
    if rule == "additive":
        return F.sum(col)
    if rule == "max":
        return F.max(col)
    if rule == "native_grain":
        if not set(contract.get("grain", [])) <= set(by):
            raise ContractViolation(f"measure {measure['name']!r} is only valid at its native grain")
        return F.max(col)
    if rule == "ratio":
        num, den = F.sum(measure["numerator"]).cast("double"), F.sum(measure["denominator"]).cast("double")
        return F.when(den != 0, num / den)
    raise ContractViolation(f"unknown aggregation rule {rule!r}")


def aggregate_by_rule(df: DataFrame, contract: dict, measures: list[str], by: list[str]) -> DataFrame:
    """Group by ``by`` and aggregate each measure by its contract rule.
    Ratios are recomputed from summed parts, never averaged."""
    exprs = [aggregation_expr(contract, _measure(contract, m), by).alias(m) for m in measures]
    return df.groupBy(*by).agg(*exprs)


def measure_query(df: DataFrame, contract: dict, measures: list[str], by: list[str],
                  where: dict[str, object] | None = None) -> DataFrame:
    """Grouped result for named measures, after the contract's checks and filters.

    ``where`` maps columns to a value or a list of values; its columns are checked like
    grouping columns, so a blocked one cannot be filtered on either.
    """
    check_dimensions(contract, [*by, *(where or {})])
    for m in measures:
        check_safe_aggregation(contract, _measure(contract, m), by)
    for f in contract.get("default_filters", []):
        df = df.filter(F.expr(f))
    for c, v in (where or {}).items():
        df = df.filter(F.col(c).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(c) == F.lit(v))
    return aggregate_by_rule(df, contract, measures, by)


def safe_join(left: DataFrame, right: DataFrame, contract: dict, right_product: str,
              how: str = "left", check_fanout: bool = True) -> DataFrame:
    """Join only a product declared joinable, on its declared key; the right side
    must be unique on that key (D4 guard, a job that runs when this is called), so the
    left grain is preserved."""
    decl = [j for j in contract.get("joinable", []) if j["product_id"] == right_product]
    if not decl:
        raise ContractViolation(f"{right_product!r} is not declared joinable with {contract.get('product_id')!r}")
    keys = decl[0]["join_on"]
    keys = [keys] if isinstance(keys, str) else list(keys)
    if check_fanout:
        try:
            assert_unique(right, keys, right_product)
        except ValueError as e:
            raise ContractViolation(str(e)) from e
    return left_join_spread(left, right, keys) if how == "left" else left.join(right, keys, how)
