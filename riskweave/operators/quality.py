"""F. Data quality and freshness (and A6, the quarantine split)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.joins import full_join


def _fails(predicate: str):
    """A row fails a check only when the predicate is FALSE; NULL passes (SQL CHECK)."""
    return F.coalesce(~F.expr(predicate), F.lit(False))


def check_constraints(df: DataFrame, checks: dict[str, str]) -> DataFrame:
    """failing-row count per named SQL predicate, all checks in one scan."""
    agg = df.agg(*[F.sum(F.when(_fails(p), 1).otherwise(0)).cast("bigint").alias(f"c{i}")
                   for i, p in enumerate(checks.values())])
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("failed_rows"))
                     for i, n in enumerate(checks)])
    return agg.select(F.explode(rows).alias("r")).select("r.check_name", "r.failed_rows")


def quarantine_split(df: DataFrame, checks: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows failing any check go to ``bad`` with the names of the failed rules.

    One column holds the failed rule names; good and bad are two filters of the
    same lazy plan (cache or checkpoint it if both are written).
    """
    failed = F.array_compact(F.array(*[F.when(_fails(p), F.lit(n)) for n, p in checks.items()]))
    tagged = df.withColumn("failed_rules", failed)
    good = tagged.filter(F.size("failed_rules") == 0).drop("failed_rules")
    bad = tagged.filter(F.size("failed_rules") > 0)
    return good, bad


def quarantine_write(df: DataFrame, checks: dict[str, str], path: str, mode: str = "errorifexists") -> None:
    """A6 in one pass: every row is tagged once and written once, partitioned by
    ``quarantine``; ``path/quarantine=good`` holds the good rows and
    ``path/quarantine=bad`` the bad ones with ``failed_rules``. No second scan of
    the input and nothing cached."""
    failed = F.array_compact(F.array(*[F.when(_fails(p), F.lit(n)) for n, p in checks.items()]))
    (df.withColumn("failed_rules", failed)
       .withColumn("quarantine", F.when(F.size("failed_rules") > 0, F.lit("bad")).otherwise(F.lit("good")))
       .write.mode(mode).partitionBy("quarantine").parquet(path))


def business_days(spans: DataFrame, by: list[str], calendar: DataFrame | None = None) -> DataFrame:
    """(by..., business_date): the business days of each group's span (columns _lo, _hi).

    ``calendar`` lists the business days (column business_date); without one they are
    Monday to Friday.
    """
    days = spans.select(*by, F.explode(F.sequence("_lo", "_hi")).alias("business_date"))
    if calendar is not None:
        return days.join(calendar.select("business_date").distinct(), "business_date", "left_semi").select(*by, "business_date")
    return days.filter(F.weekday("business_date") < 5)


def row_count_band(df: DataFrame, date_col: str, by: list[str] | None = None, pct: float = 10.0,
                   calendar: DataFrame | None = None, as_of: str | None = None) -> DataFrame:
    """rows per business day against the prior business day, flagged outside +/- pct.

    The days run from each group's first to ``as_of`` (else the last day of any group), so a
    group that stopped counts 0 from then on. The first business day has no verdict; rows
    on other days are listed as OFF_CALENDAR and compared with nothing. A NULL group is a
    group. The window is per group and holds one row per day.
    """
    by = by or []
    counts = df.groupBy(*by, F.col(date_col).cast("date").alias("business_date")).agg(F.count("*").alias("row_count"))
    spans, last = _spans(counts, by, as_of)
    days = business_days(spans, by, calendar).withColumn("_open", F.lit(True))
    full = full_join(days, counts.filter(F.col("business_date") <= last) if as_of else counts, [*by, "business_date"])
    full = full.withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("bigint")))
    opened = F.coalesce(F.col("_open"), F.lit(False))
    w = Window.partitionBy(*by, opened).orderBy("business_date")
    full = full.withColumn("prev_count", F.when(opened, F.lag("row_count").over(w)))
    lo = F.col("prev_count") * (1 - pct / 100.0)
    hi = F.col("prev_count") * (1 + pct / 100.0)
    return full.withColumn(
        "verdict",
        F.when(~opened, F.lit("OFF_CALENDAR"))
         .when(F.col("prev_count").isNull(), F.lit(None).cast("string"))
         .when((F.col("row_count") < lo) | (F.col("row_count") > hi), F.lit("OUT_OF_BAND"))
         .otherwise(F.lit("OK"))).drop("_open")


def _spans(days: DataFrame, by: list[str], as_of: str | None):
    """Each group's first day (_lo) and the last day to report (_hi), and that day as a column."""
    spans = days.groupBy(*by).agg(F.min("business_date").alias("_lo"), F.max("business_date").alias("_own"))
    if as_of is not None:
        last = F.lit(as_of).cast("date")
        return spans.filter(F.col("_lo") <= last).withColumn("_hi", last), last
    # the last day of any group: one row under a constant key
    one = F.lit(1).alias("_one")
    return spans.select("*", one).join(spans.agg(F.max("_own").alias("_hi")).select("*", one), "_one"), None


def seconds_of_day(c):
    """Whole seconds since local midnight; independent of the session time zone."""
    t = F.col(c) if isinstance(c, str) else c
    return (F.hour(t) * 3600 + F.minute(t) * 60 + F.floor(F.second(t))).cast("bigint")


def freshness(loads: DataFrame, sla_hour: int = 7, alert_hour: int = 8, utc_offset_hours: int = -5,
              calendar: DataFrame | None = None, as_of: str | None = None) -> DataFrame:
    """per product and local day, the last load and its SLA status.

    ON_TIME by ``sla_hour``, LATE after it, ALERT after ``alert_hour``, MISSING for a
    business day without a load, from the product's first load to ``as_of`` (else the last
    day that any product loaded): a product that stopped is MISSING from then on. A load
    on a day that is no business day is listed with its status. Loads without a product are
    one product of their own. Times are shifted by a fixed offset (EST = UTC-5 in the contract).
    """
    local = F.col("load_time") + F.make_dt_interval(hours=F.lit(utc_offset_hours))
    per_day = (loads.select("product_id", local.alias("_t"))
                    .groupBy("product_id", F.col("_t").cast("date").alias("business_date"))
                    .agg(F.max("_t").alias("last_load"), F.count("*").alias("loads")))
    spans, last = _spans(per_day, ["product_id"], as_of)
    if as_of is not None:
        per_day = per_day.filter(F.col("business_date") <= last)
    j = full_join(business_days(spans, ["product_id"], calendar), per_day, ["product_id", "business_date"])
    secs = seconds_of_day("last_load")
    return j.select(
        "product_id", "business_date", "last_load", secs.alias("last_load_seconds"),
        F.coalesce("loads", F.lit(0).cast("bigint")).alias("loads"),
        F.when(F.col("last_load").isNull(), F.lit("MISSING"))
         .when(secs <= sla_hour * 3600, F.lit("ON_TIME"))
         .when(secs <= alert_hour * 3600, F.lit("LATE"))
         .otherwise(F.lit("ALERT")).alias("status"))
