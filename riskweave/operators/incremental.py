"""C4 kept up to date by change sets: a stored summary of which only touched groups are rewritten.

The store holds what the summary is made of, summed to its groups: a row per (kind,
counterparty, date, variant) with the amount and the number of facts behind it, in
partitions of (as_of_date, bucket of the counterparty code). A change set is signed rows
of the same shape: what comes is +1, what goes is -1 with the amount it had, and a change
is both. Sums of exact decimals are groups with an inverse, so retracting a fact needs no
other fact: a refresh reads the change set, the store's partitions that it touches and the
dimensions, and no fact table.

Every partition carries the number of the last change set applied to it. A set is applied
to a partition once: a refresh that failed half-way is run again with the same number, and
skips what it had done. New contents are staged beside the store by Spark's dynamic
partition overwrite and replace a partition when the last task has ended, so nothing is
overwritten by a plan that still reads it.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import write_scratch
from .exposure import hidden_exposure, true_exposure_summary

KNOWN, HIDDEN, MARK = "known", "hidden", "mark"
GROUP = ["kind", "counterparty_code", "as_of_date", "variant_id"]
BUCKETS = 64
TOTAL = "decimal(38,2)"
STATE = (f"kind string, counterparty_code string, variant_id string, amount {TOTAL}, n long, applied long, "
         "as_of_date date, bucket int")

Partition = tuple[dt.date | None, int]


def exposure_entries(known: DataFrame | None = None, hidden: DataFrame | None = None, sign: int = 1) -> DataFrame:
    """Signed rows of facts: C2's known exposure and C3's anomaly exposure. Facts without a
    counterparty are in no group of the summary and are left out."""
    parts = []
    for kind, df, variant in ((KNOWN, known, F.lit(None).cast("string")), (HIDDEN, hidden, F.col("variant_id"))):
        if df is not None:
            parts.append(df.filter("counterparty_code IS NOT NULL").select(
                F.lit(kind).alias("kind"), "counterparty_code", "as_of_date", variant.alias("variant_id"),
                (F.coalesce("base_total_exposure", F.lit(0)) * sign).cast(TOTAL).alias("amount"), F.lit(sign).cast("long").alias("n")))
    return reduce(DataFrame.unionByName, parts)


def change_set(before: DataFrame | None = None, after: DataFrame | None = None) -> DataFrame:
    """Net signed rows between two images of the changed facts (``exposure_entries`` of each
    with sign 1): inserts have an after image, deletes a before image, updates both."""
    back = None if before is None else before.withColumns({"amount": (-F.col("amount")).cast(TOTAL), "n": -F.col("n")})
    return _net(reduce(DataFrame.unionByName, [p for p in (back, after) if p is not None]))


def _net(rows: DataFrame, *also: str) -> DataFrame:
    """Signed rows summed to their groups; those that cancel out go. ``also``: columns that follow from the group."""
    return (rows.groupBy(*GROUP, *also).agg(F.sum("amount").cast(TOTAL).alias("amount"), F.sum("n").alias("n"))
                .filter((F.col("n") != 0) | (F.col("amount") != 0)))


def _within(parts: list[Partition]) -> Column:
    """A partition filter: the buckets of each date."""
    by_date: dict[dt.date | None, list[int]] = {}
    for day, bucket in parts:
        by_date.setdefault(day, []).append(bucket)
    day_is = lambda d: F.col("as_of_date").isNull() if d is None else F.col("as_of_date") == F.lit(d)
    terms = [day_is(d) & F.col("bucket").isin(sorted(b)) for d, b in by_date.items()]
    return reduce(lambda x, y: x | y, terms, F.lit(False))


class ExposureStore:
    """The stored groups (``path/state``) and the summary derived from them (``path/summary``)."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.state_path, self.summary_path = (f"{path.rstrip('/')}/{x}" for x in ("state", "summary"))

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64("counterparty_code"), F.lit(self.buckets)).cast("int"))

    def _marks(self, parts: list[Partition], number: int) -> DataFrame:
        """A row per partition: the last change set applied, and in n the number of buckets."""
        rows = [(MARK, None, None, None, self.buckets, number, day, bucket) for day, bucket in parts]
        return self.spark.createDataFrame(rows, STATE)

    def _parts(self, df: DataFrame) -> list[Partition]:
        """The partitions of some rows; at most as many as the store's file listing has."""
        return [(r["as_of_date"], r["bucket"]) for r in df.select("as_of_date", "bucket").distinct().collect()]

    def _put(self, df: DataFrame, path: str) -> None:
        """Replace the partitions that ``df`` has rows of, dealt by partition. It may read them: they stay until all tasks have written."""
        (df.write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("as_of_date", "bucket").parquet(path))

    def state(self, parts: list[Partition] | None = None) -> DataFrame:
        """The stored groups, of some partitions or all."""
        df = self.spark.read.schema(STATE).parquet(self.state_path)
        return df if parts is None else df.filter(_within(parts))

    def create(self, entries: DataFrame, number: int = 0) -> list[Partition]:
        """Write the store from all facts (a full rebuild); an existing one is replaced."""
        rows = write_scratch(self._bucketed(_net(entries)), "exposure-entries").withColumn("applied", F.lit(number).cast("long"))
        parts = self._parts(rows)
        (rows.unionByName(self._marks(parts, number)).repartition("as_of_date", "bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy("as_of_date", "bucket").parquet(self.state_path))
        return parts

    def apply(self, changes: DataFrame, number: int) -> list[Partition]:
        """Apply change set ``number`` and return the partitions it touches. Sets are applied in
        the order of their numbers. Retracting what is not there is an error."""
        deltas = write_scratch(self._bucketed(_net(changes)), "exposure-deltas")
        touched = self._parts(deltas)
        marks = {(r["as_of_date"], r["bucket"]): r for r in self.state(touched).filter(F.col("kind") == MARK).collect()} if touched else {}
        if any(m["n"] != self.buckets for m in marks.values()):
            raise ValueError(f"the store has not {self.buckets} buckets")
        todo = [p for p in touched if p not in marks or marks[p]["applied"] < number]
        if todo:
            names = [*GROUP, "amount", "n", "bucket"]
            old = self.state(todo).filter(F.col("kind") != MARK).select(names)
            rows = old.unionByName(deltas.filter(_within(todo)).select(names)).unionByName(self._marks(todo, number).select(names))
            # dealt by partition before the sums, which then need no shuffle of their own
            new = _net(rows.repartition("as_of_date", "bucket"), "bucket")
            bad = (F.col("n") <= 0)
            new = new.withColumn("n", F.when(~bad, F.col("n")).otherwise(F.raise_error(F.concat(
                F.lit("change set retracts facts that are not in the store: "), F.concat_ws(" ", *GROUP))).cast("long")))
            self._put(new.withColumn("applied", F.lit(number).cast("long")), self.state_path)
        return touched

    def derive(self, variants: DataFrame, dim: DataFrame, legal_entity: DataFrame, parts: list[Partition] | None = None) -> DataFrame:
        """C4 from the stored groups of some partitions or all."""
        rows = self.state(parts)
        known = rows.filter(F.col("kind") == KNOWN).select("counterparty_code", "as_of_date", F.col("amount").alias("known_exposure"))
        hidden = rows.filter(F.col("kind") == HIDDEN).select("counterparty_code", "as_of_date", "variant_id", F.col("amount").alias("base_total_exposure"))
        return true_exposure_summary(known, hidden_exposure(hidden, variants), dim, legal_entity)

    def refresh_summary(self, variants: DataFrame, dim: DataFrame, legal_entity: DataFrame, parts: list[Partition]) -> None:
        """Rewrite the summary of some partitions (those that ``create`` or ``apply`` returned). Doing it again gives the same."""
        if parts:
            rows = self._bucketed(self.derive(variants, dim, legal_entity, parts)).withColumn("is_mark", F.lit(False))
            marks = self.spark.createDataFrame([(d, b, True) for d, b in parts], "as_of_date date, bucket int, is_mark boolean")
            # a partition that has lost all its rows is replaced by its mark
            self._put(rows.unionByName(marks, allowMissingColumns=True).repartition("as_of_date", "bucket"), self.summary_path)

    def refresh(self, changes: DataFrame, number: int, variants: DataFrame, dim: DataFrame, legal_entity: DataFrame) -> list[Partition]:
        """Apply a change set and rewrite the touched part of the summary."""
        touched = self.apply(changes, number)
        self.refresh_summary(variants, dim, legal_entity, touched)
        return touched

    def summary(self) -> DataFrame:
        """The stored summary, with C4's columns."""
        return self.spark.read.parquet(self.summary_path).filter("NOT is_mark").drop("is_mark", "bucket")
