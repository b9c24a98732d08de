"""Euler allocation of H10 and H12: what each trade contributes to EE, PFE and CVA of its set.

A trade's contribution is its expected value on the paths that make the figure: those where
the set's value is positive for EE, and those at the percentile for PFE. Contributions of a
set's trades add up to the figure of the set; a negative one is a trade that nets.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .risk import _quoted, default_probabilities, net_exposure

GROUP = ["netting_set", "scenario", "time_y"]


def _trade_paths(values: DataFrame) -> DataFrame:
    """One row per trade and path: the finest grain any contribution needs."""
    return values.groupBy(*GROUP, "path_id", "trade_id").agg(F.sum("value").cast("decimal(38,2)").alias("value"))


def ee_contributions(values: DataFrame, n_paths: int) -> DataFrame:
    """Per trade: E[value, where the set's net value is positive]; adds up to H10's EE."""
    paid = net_exposure(values).filter("net_value > 0").select(*GROUP, "path_id")
    j = _trade_paths(values).join(paid, [*GROUP, "path_id"], "left_semi")
    return j.groupBy(*GROUP, "trade_id").agg((F.sum("value").cast("double") / n_paths).alias("ee_contribution"))


def pfe_contributions(values: DataFrame, n_paths: int, level: float = 0.95) -> DataFrame:
    """Per trade: E[value, given that the set's exposure is at its percentile]; adds up to H10's PFE.

    The percentile lies between two order statistics; each is shared equally by the paths
    that have that exposure, and only those paths are joined with their trades. Paths of
    exposure 0 (absent ones too) contribute nothing, as a floored exposure is no trade's.
    """
    pos = level * (n_paths - 1)
    part = pos - math.floor(pos)
    net = net_exposure(values)
    x = F.col("exposure")
    # a window holds one netted row a path (H9); paths without a row come first, as zeros
    by = Window.partitionBy(*GROUP)
    ranked = net.withColumn("_at", F.row_number().over(by.orderBy("exposure", "path_id")) - 1 + n_paths - F.count("*").over(by))
    picked = lambda i: F.max(F.when(F.col("_at") == i, x)).over(by)
    ranked = ranked.withColumns({"_lo": picked(math.floor(pos)), "_hi": picked(math.ceil(pos))})
    share = lambda q: F.when(x == F.col(q), 1.0 / F.sum(F.when(x == F.col(q), 1)).over(by)).otherwise(F.lit(0.0))
    weight = (1 - part) * share("_lo") + part * share("_hi")
    tail = ranked.withColumn("_w", weight).filter("exposure > 0 AND _w > 0").select(*GROUP, "path_id", "_w")
    return (_trade_paths(values).join(tail, [*GROUP, "path_id"])
            .groupBy(*GROUP, "trade_id").agg(F.sum(F.col("value").cast("double") * F.col("_w")).alias("pfe_contribution")))


def cva_contributions(contributions: DataFrame, times: DataFrame, quotes: DataFrame, lgd: float = 0.6, recovery: float = 0.4,
                      risk_free: float = 0.04) -> DataFrame:
    """Per trade: sum over time of its EE contribution x dPD x LGD x DF; adds up to H12's CVA.

    contributions: one scenario's rows of ``ee_contributions``; times: (netting_set,
    curve_id, time_y) of its profile, on whose grid PDs are taken, as in ``cva_on_quotes``.
    """
    times = times.select("netting_set", "curve_id", "time_y").distinct()
    on = contributions.join(times, ["netting_set", "time_y"])
    grid = times.select("curve_id", F.col("time_y").alias("tenor_y")).distinct()
    dpd = _quoted(default_probabilities(quotes, grid, recovery)).select("curve_id", F.col("tenor_y").alias("time_y"), "dpd")
    discount = F.pow(F.lit(1.0 + risk_free), -F.col("time_y"))
    return (on.join(dpd, ["curve_id", "time_y"], "left").groupBy("netting_set", "trade_id")
              .agg(F.sum(F.col("ee_contribution") * F.col("dpd") * lgd * discount).alias("cva_contribution"),
                   F.count(F.when(F.col("dpd").isNull(), 1)).alias("times_without_pd")))
