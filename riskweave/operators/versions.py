"""As-of versions of rule and variant tables: which rule was in force when a trade was booked.

A range join (valid_from <= time < valid_to) of a hot counterparty's trades would send them
all to one task, and try each against each version. Here time is cut into tiles. A task
gets the trades of one key and tile, and of a tile of very many trades a share of them; the
versions that begin in the tile are copied to each share, with the one in force when the
tile begins. Sorted by time, the last version seen is the one in force.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TILE_DAYS = 64
ROWS_A_TASK = 200_000


def as_of_join(left: DataFrame, versions: DataFrame, keys: list[str], time: str, values: list[str], valid_from: str = "valid_from",
               valid_to: str | None = None, tile_days: int = TILE_DAYS, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """Every row of ``left`` with the ``values`` of the version in force at its ``time``, and ``version_from``.

    The version in force is the last one of the same ``keys`` with valid_from <= time; if it
    has ended (valid_to <= time, NULL is open) there is none, even where an older one is
    still open. Versions of a key that begin at the same time count once if they are equal;
    if not, none of them is picked: values are NULL and ``version_conflict`` is set. Rows
    without a key or time, and before the first version, keep NULL values. ``time`` and
    valid_from are dates or timestamps. A window holds at most ``rows_a_task`` rows of
    ``left`` and one key's versions of ``tile_days`` days.
    """
    version_of = lambda p: F.struct(*[F.col(c) for c in values], (F.col(valid_to) if valid_to else F.lit(None).cast("timestamp")).alias("_end")).alias(p)
    tile = lambda c: F.floor(F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date")) / tile_days)
    some = lambda df, c: reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in [*keys, c]])
    rows = left.filter(some(left, time)).withColumn("_tile", tile(time))
    v = (versions.filter(some(versions, valid_from)).select(*keys, F.col(valid_from).alias("_at"), version_of("_v"))
         .groupBy(*keys, "_at").agg(F.min("_v").alias("_v"), (~F.min("_v").eqNullSafe(F.max("_v"))).alias("_odd"))
         .withColumn("_tile", tile("_at")))
    state = F.struct("_at", "_v", "_odd")

    # what is in force when a tile begins: the last version of the tiles before it, one row a tile
    shares = rows.groupBy(*keys, "_tile").agg(F.ceil(F.count("*") / rows_a_task).alias("_shares"))
    lasts = v.groupBy(*keys, "_tile").agg(F.max(state).alias("_last"))
    tiles = shares.join(lasts, [*keys, "_tile"], "full")
    before = Window.partitionBy(*keys).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    carried = tiles.withColumn("_state", F.last("_last", ignorenulls=True).over(before)).filter("_shares IS NOT NULL")

    spread = lambda df: df.withColumn("_share", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_shares"))))
    body = [F.struct(*[F.col(c) for c in left.columns]).alias("_row")]
    none = F.lit(None)
    events = rows.join(shares, [*keys, "_tile"]).select(
        *keys, "_tile", (F.pmod(F.xxhash64(*left.columns), F.col("_shares")) + 1).alias("_share"), F.col(time).cast("timestamp_ntz").alias("_t"),
        F.lit(1).alias("_kind"), none.cast(carried.schema["_state"].dataType).alias("_state"), *body)
    row_type = events.schema["_row"].dataType
    begin = v.join(shares, [*keys, "_tile"]).select(*keys, "_tile", "_shares", F.col("_at").cast("timestamp_ntz").alias("_t"), state.alias("_state"))
    held = carried.filter("_state IS NOT NULL").select(*keys, "_tile", "_shares", F.col("_state._at").cast("timestamp_ntz").alias("_t"), "_state")
    starts = spread(begin.unionByName(held)).select(*keys, "_tile", "_share", "_t", F.lit(0).alias("_kind"), "_state", none.cast(row_type).alias("_row"))
    order = Window.partitionBy(*keys, "_tile", "_share").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = events.unionByName(starts).withColumn("_in_force", F.last("_state", ignorenulls=True).over(order)).filter("_row IS NOT NULL")
    end = F.col("_in_force._v._end")
    ended = F.coalesce(end.cast("timestamp_ntz") <= F.col("_t"), F.lit(False)) if valid_to else F.lit(False)
    odd = F.coalesce("_in_force._odd", F.lit(False))

    def value(c: str) -> Column:
        return F.when(~odd & ~ended, F.col(f"_in_force._v.{c}")).alias(c)

    out = met.select("_row.*", *[value(c) for c in values], F.when(odd | ~ended, F.col("_in_force._at")).alias("version_from"),
                     odd.alias("version_conflict"))
    rest = left.filter(~some(left, time))
    types = {f.name: f.dataType for f in out.schema}
    return out.unionByName(rest.select(*left.columns, *[none.cast(types[c]).alias(c) for c in [*values, "version_from"]],
                                       F.lit(False).alias("version_conflict")))
