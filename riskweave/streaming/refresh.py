"""Incremental refresh jobs over a stream of trades and of load events."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import resolution as B
from ..operators.quality import seconds_of_day
from ..session import ensure_checkpoint_dir


def resolve_stream(trades: DataFrame, variants: DataFrame) -> DataFrame:
    """B6 on a stream: each micro-batch of trades is looked up in the (static)
    variant table with a stream-static left join; no state is kept.

    The lookup (one row per spelling) is built once and persisted, so micro-batches
    do not re-aggregate the variant table; a lost executor recomputes it from lineage.
    """
    lookup = B.variant_lookup(variants).persist()
    return B.resolve_with_lookup(trades, lookup)


def resolution_breakdown_stream(trades: DataFrame) -> DataFrame:
    """B11 as a running aggregate (update/complete output mode); state is one row per status."""
    return (trades.groupBy("resolution_status")
                  .agg(F.count("*").alias("trade_count"),
                       F.sum("exposure_amount").cast("decimal(38,2)").alias("total_exposure")))


def freshness_stream(loads: DataFrame, sla_hour: int = 7, alert_hour: int = 8,
                     utc_offset_hours: int = -5, watermark: str = "1 day") -> DataFrame:
    """F3 on a stream: last load per product and local day, emitted (append mode)
    once the watermark passes the end of the day.

    A day with no load at all produces no event, so MISSING is reported by the
    batch ``quality.freshness`` over the landed table, not here.
    """
    local = F.col("load_time").cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(utc_offset_hours))
    # Watermarks need TIMESTAMP: encode the local wall clock as the instant with the
    # same UTC wall clock, so day windows (aligned on UTC) are local days whatever
    # the session time zone is.
    epoch = F.unix_date(local.cast("date")).cast("long") * 86400 + seconds_of_day(local)
    per_day = (loads.select("product_id", F.timestamp_seconds(epoch).alias("_t"))
                    .withWatermark("_t", watermark)
                    .groupBy("product_id", F.window("_t", "1 day").alias("_day"))
                    .agg(F.max("_t").alias("last_load"), F.count("*").alias("loads")))
    start = F.unix_seconds(F.col("_day.start"))
    secs = F.unix_seconds(F.col("last_load")) - start
    return per_day.select(
        "product_id", F.date_from_unix_date((start / 86400).cast("int")).alias("business_date"),
        secs.alias("last_load_seconds"), "loads",
        F.when(secs <= sla_hour * 3600, F.lit("ON_TIME"))
         .when(secs <= alert_hour * 3600, F.lit("LATE"))
         .otherwise(F.lit("ALERT")).alias("status"))


def start_query(df: DataFrame, name: str, sink: str = "parquet", mode: str = "append",
                path: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Start a streaming query to a file sink (``path`` is needed) or another sink by
    name; ``memory`` keeps the whole result on the driver and is for tests. Its checkpoint lives under the session's shared
    ``spark.checkpoint.dir``, so a restarted driver or lost executor resumes from
    the committed offsets and state."""
    if path is None and sink not in ("memory", "noop", "console"):
        raise ValueError(f"a {sink} sink needs a path")
    root = ensure_checkpoint_dir(df.sparkSession)
    w = (df.writeStream.queryName(name).outputMode(mode).format(sink)
           .option("checkpointLocation", os.path.join(root, "streams", name)))
    if path:
        w = w.option("path", path)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
