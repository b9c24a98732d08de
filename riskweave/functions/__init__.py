"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from .columns import (breach_status, money, money_sum, name_key, pct, ratio,
                      resolution_impact, round_double)

__all__ = ["breach_status", "money", "money_sum", "name_key", "pct", "ratio",
           "resolution_impact", "round_double"]
