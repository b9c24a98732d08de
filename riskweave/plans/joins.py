"""Join helpers: unique lookups, and left joins that spread rows without a key.

A planner that sees file sizes alone takes a side that explodes, or a compressed table of
millions of short rows, for one to broadcast, through the driver. Sides that grow with the
tables are ``grown``: a sort-merge join, whose skewed partitions adaptive execution splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = 4096


def grown(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never broadcast, however small its files look."""
    return df.hint("merge")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt out by ``keys``, to as many partitions as a shuffle has: small rows that
    much work follows are not put together into a task or two."""
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n + 1, *keys)  # as many as the shuffle before it has, and the planner leaves it out


def full_join(a: DataFrame, b: DataFrame, keys: list[str], how: str = "full") -> DataFrame:
    """Full outer (or ``how``) join on null-safe keys; each key comes out once."""
    a, b = a.alias("_a"), b.alias("_b")
    on = reduce(lambda x, y: x & y, [F.col(f"_a.{k}").eqNullSafe(F.col(f"_b.{k}")) for k in keys])
    rest = [F.col(f"_{s}.{c}") for s, df in (("a", a), ("b", b)) for c in df.columns if c not in keys]
    return a.join(b, on, how).select(*[F.coalesce(F.col(f"_a.{k}"), F.col(f"_b.{k}")).alias(k) for k in keys], *rest)


def unique_lookup(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row per key: ``value`` (NULL if the key has two) and ``conflict``. A join on it cannot fan out."""
    lo, hi = F.min(value), F.max(value)
    return df.groupBy(*keys).agg(F.when(lo == hi, lo).alias(value), F.coalesce(lo != hi, F.lit(False)).alias("conflict"))


def left_join_spread(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left equi-join whose left rows without a key do not meet in one task.

    They match nothing, but a hash of their NULL key would send all of them to one
    partition; a second key, 0 for rows with a key, deals them out by row. The lookup
    grows with its table, so it is not broadcast.
    """
    keyless = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in keys])
    spread = F.when(keyless, F.pmod(F.xxhash64(*left.columns), F.lit(SPREAD))).otherwise(F.lit(0).cast("long"))
    # 0 for every row, but no literal: the planner would make that a filter, and not hash by it
    zero = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("long")
    return left.withColumn("_spread", spread).join(grown(right.withColumn("_spread", zero)), [*keys, "_spread"], "left").drop("_spread")


def assert_unique(df: DataFrame, keys: list[str], what: str = "dimension") -> None:
    """Fail if ``keys`` repeat in ``df`` (a join on them would fan out). Runs a job when called."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"{what} key {keys} is not unique, e.g. {dup[0].asDict()}")
