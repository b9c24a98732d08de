"""Spark session settings the library is designed around."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings that matter at scale: adaptive execution re-plans joins and
# partition counts from real shuffle sizes, and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # runtime broadcast only for sides measured below this size
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256MB",
    # AQE merges small shuffle partitions up to this size; start high, let it coalesce
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "riskweave",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create or fetch a session with SCALE_CONF applied.

    On a cluster leave ``master`` unset so spark-submit decides; tests pass
    ``local[*]`` and a small shuffle partition count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Where it is unset a local
    master (tests) gets a scratch folder; on a cluster that would be a folder that
    only one machine sees, so it is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        current = tempfile.mkdtemp(prefix="riskweave-ckpt-",
                                   dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage as ``checkpoint`` does (lost executors recompute nothing upstream), and
    the planner knows the size of what it reads, so a small side is broadcast from the start.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_counted(df: DataFrame, name: str, condition: str = "true") -> tuple[DataFrame, int]:
    """``write_scratch``, and how many rows meet ``condition``, counted by the write itself. Rows of
    a stage that is run again after a lost executor may count twice, so the number is exact when
    it is 0, and an upper bound else."""
    seen = Observation()
    out = write_scratch(df.observe(seen, F.count(F.when(F.expr(condition), 1)).alias("n")), name)
    return out, seen.get["n"]


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = 256 << 20, minimum: int = 200) -> int:
    """Initial shuffle partition count for an expected shuffle volume.

    At 100 TB a join or aggregation may shuffle tens of TB; ~256 MB per task
    keeps each partition within executor memory (AQE then coalesces small ones).
    """
    return max(minimum, -(-shuffle_bytes // target_bytes))
