"""H10 without gathering paths: a mergeable histogram of exposures with a stated error.

A sketch is a typed table, SKETCH: per (netting set, scenario, time) and bucket of a
logarithmic scale the number of paths and their exact sums. Bucket b holds exposures in
(g^(b-1), g^b] with g = (1 + error) / (1 - error), so its middle is within ``error`` of each
of them, in relation to it. Counts and sums add up, so sketches of any split of the paths
(batches of a simulation, days, sites) merge by one aggregation, and a group has as many
rows as its exposures span buckets (some 1,200 for 1 % over ten decades) however many paths.

Error: EE and MTM are exact. An order statistic falls into the bucket that holds it, so its
estimate is within ``error`` of it, and so is a percentile between two of them; no rank is
misplaced by more than its bucket.
"""

from __future__ import annotations

from functools import reduce

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GROUP = ["netting_set", "scenario", "time_y"]
SKETCH = ("netting_set string, scenario string, time_y double, bucket int, paths long, exposure_sum decimal(38,2), "
          "mtm_sum decimal(38,2), error double")


def exposure_sketch(net: DataFrame, error: float = 0.01) -> DataFrame:
    """A SKETCH of netted exposures (H9); a NULL bucket holds those that are 0."""
    log_g = math.log((1 + error) / (1 - error))
    x = F.col("exposure").cast("double")
    bucket = F.when(x > 0, F.ceil(F.log(x) / log_g)).cast("int")
    return net.groupBy(*GROUP, bucket.alias("bucket")).agg(
        F.count("*").alias("paths"), F.sum("exposure").cast("decimal(38,2)").alias("exposure_sum"),
        F.sum("net_value").cast("decimal(38,2)").alias("mtm_sum")).withColumn("error", F.lit(error))


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """One SKETCH of the paths of all; sketches of different errors are refused when it is read."""
    whole = reduce(DataFrame.unionByName, sketches)
    lo, hi = F.min("error"), F.max("error")
    same = F.when(lo == hi, lo).otherwise(F.raise_error(F.lit("sketches of different errors do not merge")).cast("double"))
    return whole.groupBy(*GROUP, "bucket").agg(
        F.sum("paths").alias("paths"), F.sum("exposure_sum").cast("decimal(38,2)").alias("exposure_sum"),
        F.sum("mtm_sum").cast("decimal(38,2)").alias("mtm_sum"), same.alias("error"))


def profile_from_sketch(sketch: DataFrame, n_paths: int, level: float = 0.95) -> DataFrame:
    """H10's EE, PFE and MTM from a SKETCH, over ``n_paths`` paths; paths without a row count as 0.
    More paths in a group than ``n_paths`` are an error, as in H10."""
    x = F.col("exposure_sum").cast("double")
    log_g = F.log((1 + F.col("error")) / (1 - F.col("error")))
    middle = F.when(F.col("bucket").isNotNull(), 2 * F.exp(log_g * F.col("bucket")) / (F.exp(log_g) + 1)).otherwise(F.lit(0.0))
    # ranks from the top: paths in this bucket and above it; zeros and absent paths are the rest
    down = Window.partitionBy(*GROUP).orderBy(F.col("bucket").desc_nulls_last())
    ranked = sketch.withColumn("_above", F.sum("paths").over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    pos = level * (n_paths - 1)
    held = {}
    for name, i in (("lo", math.floor(pos)), ("hi", math.ceil(pos))):
        from_top = n_paths - i          # the path of this rank is the from_top-th greatest
        inside = (F.col("_above") >= from_top) & (F.col("_above") - F.col("paths") < from_top)
        held[name] = F.coalesce(F.max(F.when(inside, middle)), F.lit(0.0))
    n = F.sum("paths")
    guard = F.when(n <= n_paths, n).otherwise(F.raise_error(F.lit(f"more than {n_paths} paths in one exposure group")).cast("long"))
    out = ranked.groupBy(*GROUP).agg(
        (F.sum(x) / n_paths).alias("ee"), held["lo"].alias("_lo"), held["hi"].alias("_hi"),
        (F.sum(F.col("mtm_sum").cast("double")) / n_paths).alias("mtm"), guard.alias("paths"))
    return out.select(*GROUP, "ee", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (pos - math.floor(pos))).alias("pfe"), "mtm",
                      F.lit(level).alias("level"), "paths")
