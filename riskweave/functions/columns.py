"""Reusable column expressions.

Everything here is a composition of ``pyspark.sql.functions`` so it stays
inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MONEY_TOTAL = "decimal(38,2)"

# Fixed values of the reference's breach logic.
BREACH = "BREACH"
WITHIN = "Within Threshold"
NEW_BREACH = "NEW BREACH DETECTED"
WORSENED = "BREACH WORSENED"
NO_CHANGE = "NO CHANGE"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    return _c(c).cast(MONEY)


def money_sum(c) -> Column:
    """Exact decimal sum with a fixed result type (both engines agree on it)."""
    return F.sum(_c(c)).cast(MONEY_TOTAL)


def ratio(num, den) -> Column:
    """num / den as double; NULL when den is 0 or NULL (no division error)."""
    den = _c(den).cast("double")
    return F.when(den != 0, _c(num).cast("double") / den)


def pct(num, den, digits: int = 1) -> Column:
    return F.round(ratio(_c(num).cast("double") * 100.0, den), digits)


def round_double(c, digits: int = 6) -> Column:
    return F.round(_c(c).cast("double"), digits)


def breach_status(amount, threshold) -> Column:
    """BREACH when strictly above the threshold; a NULL threshold is not a breach."""
    return F.when(_c(amount) > _c(threshold), F.lit(BREACH)).otherwise(F.lit(WITHIN))


def resolution_impact(known, total, threshold) -> Column:
    """Change of breach status once hidden exposure is added.

    As in the reference, BREACH WORSENED only needs both values above the
    threshold; it fires even when nothing hidden was found.
    """
    k, t, th = _c(known), _c(total), _c(threshold)
    return (F.when((k <= th) & (t > th), F.lit(NEW_BREACH))
             .when((k > th) & (t > th), F.lit(WORSENED))
             .otherwise(F.lit(NO_CHANGE)))


def name_key(c) -> Column:
    """Normalised matching key: upper case, zero read as O, then only letters and digits
    (of any script) kept. A name without any has no key (NULL), and so matches nothing.

    Covers the upper-case, punctuation, hyphenated and zero-for-O variant types.
    """
    key = F.regexp_replace(F.translate(F.upper(_c(c)), "0", "O"), r"[^\p{L}\p{N}]", "")
    return F.when(key != "", key)
