"""Hard negatives by Fagin's threshold algorithm over integer inner products.

A vector's components become floor(256 * x); a row's score is its integer inner product
with the anchor. A block of rows keeps one list per dimension, sorted by component. An
anchor walks each list from the end that its own sign favours (sorted access), in steps
that double; rows met are scored in full (random access). The sum of anchor times
component at the depth reached bounds every row not met, so a search ends once that
threshold is strictly below the kth score of each of its windows (below a window's lower
end, where it holds fewer than k). Windows are [ceil(0.8 p), p] for each positive score p;
positives themselves are one window without ends, over rows of the anchor's label.

A fixed query set (anchors) meets all rows in blocks: first the rows of its own label,
then all rows. A task holds ``block_rows`` rows and at most ``anchor_block`` anchors and
gives k rows a window; one row_number a window merges the blocks. A label of many rows
has many blocks, labels of few rows share one.

Defined results: rows with a null vec_id, label or vector, or any component null or not
finite, take no part. Rows equal in vec_id, label and vector count once; rows that share
a vec_id alone are rows of their own, and a row is "other" than an anchor by its vec_id.
Shorter vectors count as padded with zeros; very long ones are as good as any. Scores
outside 64 bits count as the end of that range. Ties go to the smaller vec_id. An anchor
without positives, or a window without rows, gives no row; an empty table gives none.
Extra columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import pick, write_table

K_POSITIVES = 5
K_NEGATIVES = 5
BLOCK_ROWS = 8192
ANCHOR_BLOCK = 32_768
FIRST_STEP = 16
LEAST, MOST = -(1 << 63), (1 << 63) - 1
FOUND = pa.schema([("key", pa.int64()), ("window", pa.int64()), ("window_score", pa.int64()), ("id", pa.int64()),
                   ("score", pa.int64())])


def matrix(col: pa.ChunkedArray | pa.Array, width: int = 0) -> np.ndarray:
    """floor(256 * x) of a list column as an integer matrix of at least ``width`` columns, padded with zeros;
    Python integers where the products would not fit 64 bits."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    size = np.asarray(col.value_lengths()).astype(np.int64) if len(col) else np.zeros(0, np.int64)
    flat = np.floor(256.0 * np.asarray(col.flatten(), np.float64))
    wide = max(width, int(size.max(initial=0)))
    full = np.zeros((len(size), wide))
    full[np.arange(wide)[None, :] < size[:, None]] = flat
    if np.abs(full).max(initial=0) < 1 << 24:
        return full.astype(np.int64)
    return np.array([[int(v) for v in r] for r in full], dtype=object).reshape(full.shape)


class Lists:
    """One block of rows by ascending id, with a sorted list of them for each dimension."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[by_id], x[by_id]
        self.order = np.argsort(self.x, axis=0, kind="stable")
        self.reads = 0

    def search(self, a: np.ndarray, skip: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(row positions, scores) of each window's first k rows by (score falling, id), of the rows not in ``skip``."""
        n, depth, step = len(self.ids), 0, FIRST_STEP
        up, down = np.flatnonzero(a > 0), np.flatnonzero(a < 0)
        met = skip.copy()
        at, score = np.zeros(0, np.int64), np.zeros(0, self.x.dtype)
        least, most = min(lo for lo, _ in windows), max(hi for _, hi in windows)
        while depth < n:
            end = min(n, depth + step) if len(up) + len(down) else n
            if len(up) + len(down):
                hits = np.concatenate([self.order[n - end:n - depth, up].ravel(), self.order[depth:end, down].ravel()])
            else:
                hits = np.arange(n)   # an anchor of zeros has no list to walk
            fresh = np.zeros(n, bool)
            fresh[hits] = True
            new = np.flatnonzero(fresh & ~met)
            met[new] = True
            self.reads += len(new)
            s = np.clip(self.x[new] @ a, LEAST, MOST) if self.x.dtype == object else self.x[new] @ a
            inside = (s >= least) & (s <= most)
            at, score = np.concatenate([at, new[inside]]), np.concatenate([score, s[inside]])
            by = np.argsort(at, kind="stable")
            by = by[np.argsort(-score[by], kind="stable")]
            at, score = at[by], score[by]
            bound = (self.x[self.order[n - end, up], up] * a[up]).sum() + (self.x[self.order[end - 1, down], down] * a[down]).sum()
            bound = min(max(int(bound), LEAST), MOST)
            depth, step = end, step * 2
            first = [int(np.searchsorted(-score, -hi, "left")) for _, hi in windows]
            if all(bound < (max(lo, int(score[f + k - 1])) if f + k <= len(score) else lo)
                   for (lo, _), f in zip(windows, first, strict=True)):
                break
        out = []
        for lo, hi in windows:
            f = int(np.searchsorted(-score, -hi, "left"))
            keep = slice(f, min(f + k, int(np.searchsorted(-score, -lo, "right"))))
            out.append((at[keep], score[keep]))
        return out


def _window(p: int) -> tuple[int, int]:
    """The scores s with 80 p <= 100 s <= 100 p."""
    return -(-80 * p // 100), p


def _pair(index: pa.Table, anchors: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    width = max((int(np.asarray(t.column("vec").combine_chunks().value_lengths()).max(initial=0)) for t in (index, anchors)
                 if t.num_rows), default=0)
    x, a = matrix(index.column("vec"), width), matrix(anchors.column("vec"), width)
    if object in (x.dtype, a.dtype):
        x, a = x.astype(object), a.astype(object)
    return index.column("id").to_numpy(), x, anchors.column("id").to_numpy(), a


def _found(parts: list[tuple]) -> pa.Table:
    """Rows of FOUND from (key, window, window_score, ids, scores)."""
    n = [len(p[3]) for p in parts]
    rep = lambda i: np.repeat(np.array([p[i] for p in parts], np.int64), n)
    cat = lambda i: np.concatenate([np.asarray(p[i]).astype(np.int64) for p in parts]) if parts else np.zeros(0, np.int64)
    return pa.table([rep(0), rep(1), rep(2), cat(3), cat(4)], schema=FOUND)


def _positives(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(index: pa.Table, anchors: pa.Table) -> pa.Table:
        if not index.num_rows or not anchors.num_rows:
            return FOUND.empty_table()
        ids, x, own, a = _pair(index, anchors)
        labels, asked = index.column("label").to_numpy(), anchors.column("label").to_numpy()
        keys, parts = anchors.column("key").to_numpy(), []
        for label in np.unique(asked):
            some = np.flatnonzero(labels == label)
            if not len(some):
                continue
            block = Lists(ids[some], x[some])
            for i in np.flatnonzero(asked == label):
                ((at, score),) = block.search(a[i], block.ids == own[i], [(LEAST, MOST)], k)
                parts.append((keys[i], 0, 0, block.ids[at], score))
        return _found(parts)
    return run


def _negatives(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(index: pa.Table, anchors: pa.Table) -> pa.Table:
        if not index.num_rows or not anchors.num_rows:
            return FOUND.empty_table()
        ids, x, _, a = _pair(index, anchors)
        block = Lists(ids, x)
        labels = index.column("label").to_numpy()[np.argsort(ids, kind="stable")]
        keys, asked, parts = anchors.column("key").to_numpy(), anchors.column("label").to_numpy(), []
        for i, wanted in enumerate(anchors.column("positives").to_pylist()):
            wanted = [(p["id"], p["score"]) for p in wanted if p["score"] >= 0]   # below 0 the window is empty
            if wanted:
                got = block.search(a[i], labels == asked[i], [_window(s) for _, s in wanted], k)
                parts += [(keys[i], p, s, block.ids[at], score) for (p, s), (at, score) in zip(wanted, got, strict=True)]
        return _found(parts)
    return run


def _dealt(n: int | Column) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(n) if isinstance(n, int) else n)


def _every(n: Column | int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), (F.lit(n) if isinstance(n, int) else n).cast("long") - 1))


def _first(df: DataFrame, by: Iterable[str], k: int) -> DataFrame:
    """The first k rows of each group by (score falling, id), with their rank; cut to k in each task before the shuffle."""
    w = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _meet(index: DataFrame, anchors: DataFrame, tasks: int, run: Callable) -> DataFrame:
    """Each slab of the index against the anchors dealt to it; both sides carry slab and turn."""
    by = ("slab", "turn")
    dealt = [df.repartition(tasks, *by).groupBy(*by) for df in (index, anchors)]
    return write_table(dealt[0].cogroup(dealt[1]).applyInArrow(
        run, "key long, window long, window_score long, id long, score long"), "neg-found")


def mine(rows: DataFrame, anchors: DataFrame, *, k_positives: int = K_POSITIVES, k_negatives: int = K_NEGATIVES,
         block_rows: int = BLOCK_ROWS, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """Hard negatives of anchors among rows; both (id, label, vec) without nulls, anchors being some of the rows."""
    rows = write_table(rows.select("id", "label", "vec").distinct(), "neg-rows")
    asked = write_table(anchors.select("id", "label", "vec").distinct().withColumn("key", F.xxhash64("id", "label", "vec")), "neg-anchors")
    blocks = max(1, -(-rows.count() // block_rows))
    turns = max(1, -(-asked.count() // anchor_block))
    turn = _dealt(turns).alias("turn")

    # a label of more rows than a block has slabs of its own, the others share slabs by a hash
    sizes = write_table(rows.groupBy("label").agg(F.count("*").alias("_n")).withColumn(
        "parts", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("_n") / block_rows))), "neg-labels").select("label", "parts")
    slab = lambda part: F.when(F.col("parts") > 1, F.xxhash64("label", part)).otherwise(
        F.pmod(F.xxhash64("label"), F.lit(blocks))).alias("slab")
    index = (rows.join(sizes, "label").select("id", "label", "vec", slab(_dealt(F.col("parts"))))
             .select("*", _every(turns).alias("turn")))
    own = (asked.join(sizes, "label").select("key", "id", "label", "vec", "parts", turn, _every(F.col("parts")).alias("_part"))
           .select("key", "id", "label", "vec", slab(F.col("_part")), "turn"))
    best = _first(_meet(index, own, blocks * turns, _positives(k_positives)), ["key"], k_positives)
    positives = best.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives"))
    wanted = write_table(asked.join(positives, "key"), "neg-positives")

    index = rows.select("id", "label", "vec", _dealt(blocks).alias("slab"), _every(turns).alias("turn"))
    every = wanted.select("key", "id", "label", "vec", "positives", turn, _every(blocks).alias("slab"))
    found = _first(_meet(index, every, blocks * turns, _negatives(k_negatives)), ["key", "window", "window_score"], k_negatives)
    return (found.withColumnRenamed("id", "negative_id").join(asked.select("key", F.col("id").alias("anchor_id")), "key")
            .select("anchor_id", F.col("window").alias("positive_id"), F.col("rank").cast("int").alias("rank"), "negative_id",
                    F.col("window_score").alias("positive_score"), F.col("score").alias("negative_score")))


def hard_negatives(embeddings: DataFrame, *, every: int = 100, moved: int = 7, labels: int = 10, **params) -> DataFrame:
    """Hard negatives of the rows whose vec_id is divisible by ``every``; where it is divisible by ``moved``, the label
    first becomes (label + 1) % ``labels``."""
    src = pick(embeddings, id="vec_id", label="label", vec="embedding").select(
        F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.col("vec").cast("array<double>").alias("vec"))
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    src = src.filter("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL").filter(~odd)
    label = F.when(F.col("id") % moved == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    src = src.withColumn("label", label)
    return mine(src, src.filter(F.col("id") % every == 0), **params)
