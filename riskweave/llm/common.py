"""Helpers shared by the operators: shared scratch tables, Arrow batch slicing."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

SLICE_BYTES = 2 << 20
SLICE_ROWS = 20_000
ARROW_ROWS = 1000


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster: ``spark.checkpoint.dir`` of the session."""
    return spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, unique to this call."""
    return f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage.

    The written files outlive lost executors, so nothing upstream is computed again.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python path, once per Spark context (as ``--py-files`` would).

    Also sets Arrow batches to ARROW_ROWS rows: whole texts are some KB each, and a batch
    is held several times over between Spark and a Python worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    sc, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    if getattr(sc, "_shipped_package", None):
        return
    path = Path(tempfile.mkdtemp(prefix="py-files-")) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    sc._shipped_package = str(path)


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under fixed names, so that extra columns cannot clash."""
    return df.select(*[F.col(f"`{c}`").alias(k) for k, c in cols.items()])


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty. Row i is bytes[offsets[i]:offsets[i + 1]]."""
    arr = col.cast(pa.large_binary()).fill_null(b"")
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    buf = arr.buffers()[2]
    raw = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def freed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for a task of mapInArrow; at its end the worker, which Spark uses again, gives back its free memory."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):   # only glibc has it
                pass
    return task


def slices(batches: Iterator[pa.RecordBatch], col: str, limit: int = SLICE_BYTES, most: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Batches cut and joined so that each holds at most ``limit`` bytes of ``col``, or one row, and at most ``most``
    rows: bounds a task's memory, also where texts are null or empty."""
    held, size, n = [], 0, 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, off = text_bytes(batch.column(batch.schema.get_field_index(col)))
        at = 0
        while at < batch.num_rows:
            end = min(max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1), at + most)
            if held and (size + off[end] - off[at] > limit or n + end - at > most):
                yield _joined(held)
                held, size, n = [], 0, 0
            held.append(batch.slice(at, end - at))
            size += int(off[end] - off[at])
            n += end - at
            at = end
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def rows(batches: Iterator[pa.RecordBatch], n: int = 200) -> Iterator[pa.RecordBatch]:
    """Batches cut to at most ``n`` rows, for work that turns a batch into Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, n):
            yield batch.slice(at, n)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on an array of uint64."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def per_row(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets; empty rows give 0."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[off[1:]] - total[off[:-1]]
