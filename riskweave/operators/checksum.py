"""D8 by a checksum tree: only key ranges whose contents differ are compared row by row.

The hash of a row's keys places it in a range (the leading bits of the hash). A range's
checksum is its row count and two sums of row hashes, which any order of rows and any
partitioning gives alike, so each side is summed where it lies and one row a range moves.
Ranges with equal checksums hold equal rows; the others are split further down the tree, and
only rows of the last level's differing ranges are shuffled and compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import full_join
from ..session import write_scratch
from .star import reconcile

# leading bits of the key hash at each level; a level has at most 2^bits ranges, 2^20 rows of 8 bytes in the last list
LEVELS = (10, 20)


def _hash(cols: list[str], seed: int) -> Column:
    # NULLs are skipped by the hash, so which ones are NULL is hashed with them
    return F.xxhash64(F.lit(seed), *[F.col(c).isNull() for c in cols], *cols)


def _ranged(df: DataFrame, keys: list[str], bits: int) -> DataFrame:
    return df.withColumn("_range", F.shiftrightunsigned(_hash(keys, 0), 64 - bits))


def checksums(df: DataFrame, keys: list[str], measure: str, bits: int) -> DataFrame:
    """(_range, n, s1, s2) of each key range: rows, and two order-free sums of row hashes."""
    row = lambda seed: F.sum(_hash([*keys, measure], seed).cast("decimal(38,0)"))
    return _ranged(df, keys, bits).groupBy("_range").agg(F.count("*").alias("n"), row(1).alias("s1"), row(2).alias("s2"))


def differing_ranges(a: DataFrame, b: DataFrame, keys: list[str], measure: str, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """(_range) of the last level whose checksums differ between the sides, going down the tree."""
    found = None
    for bits in levels:
        sides = []
        for df in (a, b):
            if found is not None:
                df = _ranged(df, keys, found[1]).join(found[0], "_range", "left_semi").drop("_range")
            sides.append(checksums(df, keys, measure, bits))
        x, y = (s.select("_range", F.struct("n", "s1", "s2").alias(c)) for s, c in zip(sides, ("x", "y"), strict=True))
        odd = full_join(x, y, ["_range"]).filter(~F.col("x").eqNullSafe(F.col("y"))).select("_range")
        found = write_scratch(odd, "checksum-ranges"), bits
    return found[0]


def reconcile_by_checksum(a: DataFrame, b: DataFrame, keys: list[str], measure: str, tolerance: float = 0.0,
                          levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """D8's rows that are not EQUAL. The key columns of both sides must have the same types.

    Rows that agree in sum but not one by one (a key split over other rows) make their
    range differ, and are then found equal row by row. That different contents give one
    checksum has a chance of 2^-128 a range. Runs one job a level when called.
    """
    need = [*keys, measure]
    a, b = a.select(*need), b.select(*need)
    types = [dict(df.dtypes) for df in (a, b)]
    if any(types[0][c] != types[1][c] for c in need):
        raise ValueError(f"both sides need the same types: {types}")
    odd = differing_ranges(a, b, keys, measure, levels)
    left, right = (_ranged(df, keys, levels[-1]).join(odd, "_range", "left_semi").drop("_range") for df in (a, b))
    return reconcile(left, right, keys, measure, tolerance).filter("status != 'EQUAL'")
