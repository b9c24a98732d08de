"""A. Load and conform: typed schemas, appends, one-time writes, renames, FX, code maps."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.joins import unique_lookup


def apply_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """A1: cast every declared column to its declared type (by name).

    With ANSI mode on (see ``session.SCALE_CONF``) a value that cannot be cast
    raises instead of becoming NULL; a missing column is an error too.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for schema: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def append_rows(table: DataFrame, rows: DataFrame, by: str = "name") -> DataFrame:
    """A2: add rows to a table version; no de-duplication (re-running doubles rows)."""
    if by == "name":
        return table.unionByName(rows)
    if by == "position":
        if len(rows.columns) != len(table.columns):
            raise ValueError("positional append needs the same number of columns")
        return table.union(rows.select(*[F.col(c).cast(t) for c, t in
                                         zip(rows.columns, [f.dataType for f in table.schema.fields])]))
    raise ValueError("by must be 'name' or 'position'")


def materialize(df: DataFrame, path: str, if_absent: bool = True, partition_by: list[str] | None = None,
                fmt: str = "parquet", bucket_by: tuple[int, list[str]] | None = None,
                table: str | None = None) -> None:
    """A3: write a derived table. ``if_absent`` keeps an existing table untouched
    (CREATE TABLE IF NOT EXISTS ... AS: a second call does not refresh it). A table exists
    if its write was committed (``_SUCCESS``, or the catalog entry): what a failed write
    left behind is written over.

    ``partition_by`` (e.g. a month column) lets later date filters prune files;
    ``bucket_by=(n, keys)`` with ``table`` writes a bucketed catalog table so
    later joins and aggregations on those keys read co-partitioned data without
    a shuffle.
    """
    spark = df.sparkSession
    if if_absent and (spark.catalog.tableExists(table) if bucket_by and table else _committed(spark, path)):
        return
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        if not table:
            raise ValueError("bucketing needs a catalog table name")
        n, keys = bucket_by
        w.bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
        return
    w.save(path)


def _committed(spark: SparkSession, path: str) -> bool:
    """Whether the last write to ``path`` ended with a commit."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def conform_columns(df: DataFrame, alias_map: dict[str, str]) -> tuple[DataFrame, list[str]]:
    """A4: rename an app's columns to canonical names; also return the source
    columns that have no mapping (they are kept under their own names)."""
    unmapped = [c for c in df.columns if c not in alias_map]
    return df.withColumnsRenamed({k: v for k, v in alias_map.items() if k in df.columns}), unmapped


def conform_union(sources: dict[str, DataFrame], alias_maps: dict[str, dict[str, str]],
                  keep_unmapped: bool = True) -> DataFrame:
    """A5: A4 on each source, then one table with ``source_app``; missing columns are NULL.

    Unmapped columns stay under their own names; ``keep_unmapped=False`` drops them,
    and says which in a warning.
    """
    out = None
    for app, df in sources.items():
        renamed, unmapped = conform_columns(df, alias_maps[app])
        if not keep_unmapped and unmapped:
            warnings.warn(f"{app}: columns without a mapping are dropped: {unmapped}", stacklevel=2)
            renamed = renamed.drop(*unmapped)
        renamed = renamed.withColumn("source_app", F.lit(app))
        out = renamed if out is None else out.unionByName(renamed, allowMissingColumns=True)
    return out


def convert_currency(df: DataFrame, fx: DataFrame, amount: str, ccy: str, on_date: str,
                     reporting: str, out: str = "amount_reporting") -> DataFrame:
    """Amount x rate for (currency, business date); the native amount is kept.

    The reporting currency itself converts at 1. A missing rate gives NULL and
    ``fx_missing``; two different rates for a key give NULL, ``fx_missing`` and
    ``fx_conflict``, never a second row. The rate table (currencies x dates) is left to AQE, which
    broadcasts it from its measured size or else uses a skew-aware shuffle join.
    """
    rates = unique_lookup(fx, ["currency", "business_date"], "rate").select(
        F.col("currency").alias("_ccy"), F.col("business_date").alias("_d"), F.col("rate").alias("_rate"),
        F.col("conflict").alias("_conflict"))
    j = df.join(rates,
                (F.col(ccy) == F.col("_ccy")) & (F.col(on_date) == F.col("_d")), "left")
    rate = F.when(F.col(ccy) == reporting, F.lit(1).cast("decimal(10,4)")).otherwise(F.col("_rate"))
    return (j.withColumn(out, (F.col(amount) * rate).cast("decimal(38,6)"))
             .withColumn("fx_missing", rate.isNull())
             .withColumn("fx_conflict", F.coalesce("_conflict", F.lit(False)) & (F.col(ccy) != reporting))
             .drop("_ccy", "_d", "_rate", "_conflict"))


def conform_values(df: DataFrame, column: str, mapping: DataFrame, source: str,
                   out: str | None = None) -> DataFrame:
    """Translate source codes to the core taxonomy via (source_system, source_code);
    the source code is kept and ``unmapped`` marks codes without a mapping, or with two
    different ones (``ambiguous``)."""
    out = out or f"core_{column}"
    m = unique_lookup(mapping, ["source_system", "source_code"], "core_code").select(
        F.col("source_system").alias("_src"), F.col("source_code").alias("_code"), F.col("core_code").alias(out),
        F.col("conflict").alias("_conflict"))
    j = df.join(m, (F.col(source) == F.col("_src")) & (F.col(column) == F.col("_code")), "left")
    return (j.withColumn("ambiguous", F.coalesce("_conflict", F.lit(False))).drop("_src", "_code", "_conflict")
             .withColumn("unmapped", F.col(out).isNull()))
