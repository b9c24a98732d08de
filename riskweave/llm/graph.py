"""Connected components over an edge table, and verification of groups in tasks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, write_table

SMALL_GRAPH = 200_000


def components(edges: DataFrame, small: int = SMALL_GRAPH) -> DataFrame:
    """(node, comp): the least node of each node's connected component.

    edges: (a, b) longs. Alternating large and small stars until every edge points to
    the centre of a star; every round is written, so a lost executor repeats one round.
    Neighbours of a node are only aggregated to their minimum and joined back, never
    gathered. A graph of at most ``small`` edges, some MB, is joined up in one task
    instead, where a round's shuffles would cost more than its work.
    """
    now = write_table(_oriented(edges), "edges")
    if now.count() <= small:
        return now.coalesce(1).mapInArrow(_joined_up, "node long, comp long")
    while not _stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _oriented(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        now = write_table(_oriented(small), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def _joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for a, b in zip(column(batch, "a").to_pylist(), column(batch, "b").to_pylist(), strict=True):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    yield pa.RecordBatch.from_arrays([pa.array(parent, pa.int64()), pa.array([find(x) for x in list(parent)], pa.int64())],
                                     names=["node", "comp"])


def _stars(edges: DataFrame) -> bool:
    """Whether each node has one edge to a lesser node, and the centres have none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up")))
    bad = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("centre")).filter(
        "up > 1 OR up = 1 AND centre = 0")
    return bad.isEmpty()


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges from the greater to the lesser node, without loops."""
    return edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
