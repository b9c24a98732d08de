"""Exact top-k search over binary codes by incremental multi-index hashing.

Codes of 64 bits are cut into segments, about as many as 64 / log2(codes), and codes
are indexed by each segment's value. Round r probes every segment with the query's
value and all values at Hamming distance r from it. A code not seen after it differs
by more than r in every segment, so every distance below segments * (r + 1) is
covered; a query leaves as soon as its kth verified distance is. Each code is verified
once a query: in the first segment of the first round that reaches it. (With ``scan`` a
round of more probes than the index has codes verifies the rest of the codes instead.)

Queries and index are dealt into blocks of bounded size, and a task searches one block
of the index for one block of queries; the k best of all blocks are merged.

Equal codes are one entry with the k least ids, for queries and for the index, so a
code that a third of the rows share costs no more than any other.

Defined results: neighbours are ordered by (distance, id) and a query finds itself; a
null embedding has no code and takes no part; null elements count as not positive;
rows with equal ids are neighbours of their own, and queries with equal ids and codes
are one; fewer than k rows give fewer neighbours.
"""

from __future__ import annotations

import math
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, write_table

BITS = 64
K = 10
INDEX_BLOCK = 1_000_000
QUERY_BLOCK = 100_000
CELLS = 1 << 21


def sign_code(embedding: str | Column) -> Column:
    """64-bit code: bit i is set if element i is positive; an embedding of more than 64 elements is an error."""
    one = F.lit(1).cast("long")
    bits = F.transform(embedding, lambda x, i: F.when(x > 0, F.call_function("shiftleft", one, i)).otherwise(
        F.lit(0).cast("long")))
    code = F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b))
    return F.when(F.size(embedding) > BITS, F.raise_error(F.lit(
        f"embeddings of more than {BITS} elements have no exact code")).cast("long")).otherwise(code)


def segments(n: int) -> list[tuple[int, int]]:
    """(start, width) of each segment for an index of n codes."""
    m = max(1, min(BITS, round(BITS / max(1.0, math.log2(max(n, 2))))))
    edges = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _least(df: DataFrame, by: str, order: list, k: int) -> DataFrame:
    """The first k rows of each ``by``; Spark cuts to k in each task before the shuffle."""
    return (df.withColumn("_rn", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
            .filter(F.col("_rn") <= k).drop("_rn"))


def _masks(start: int, width: int, radius: int) -> np.ndarray:
    """All sets of ``radius`` bits of a segment."""
    return np.array([sum(1 << start + b for b in bits) for bits in combinations(range(width), radius)], np.uint64)


def _parts(rows: np.ndarray, width: int) -> list[np.ndarray]:
    """Rows in parts of at most CELLS cells of ``width`` a row, one row at least."""
    step = max(1, CELLS // max(1, width))
    return [rows[k:k + step] for k in range(0, len(rows), step)]


class Index:
    """Codes of one block by each segment's value."""

    def __init__(self, codes: np.ndarray, first: np.ndarray, n: np.ndarray):
        self.codes, self.first, self.n, self.scans = codes, first, n, 0
        self.cut = segments(len(codes))
        self.bits = [np.uint64(((1 << w) - 1) << s) for s, w in self.cut]
        self.order = [np.argsort(codes & b) for b in self.bits]
        self.sorted = [(codes & b)[o] for b, o in zip(self.bits, self.order, strict=True)]

    def _probe(self, queries: np.ndarray, j: int, r: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, code) positions with segment j at distance r, not reached by an earlier probe."""
        keys = ((queries & self.bits[j])[:, None] ^ _masks(*self.cut[j], r)[None, :]).reshape(-1)
        low, high = (np.searchsorted(self.sorted[j], keys, side) for side in ("left", "right"))
        m = high - low
        at = np.repeat(low - np.cumsum(m) + m, m) + np.arange(int(m.sum()))
        return np.repeat(np.arange(len(keys)) // (len(keys) // len(queries)), m), self.order[j][at]

    def search(self, queries: np.ndarray, k: int, scan: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, code, distance): for each query the first k codes by (distance, least id), as positions."""
        q, c, d = (np.zeros(0, np.int64) for _ in range(3))
        active = np.arange(len(queries))
        for r in range(max(w for _, w in self.cut) + 1):
            met = [(q, c)]
            if scan and sum(comb(w, r) for _, w in self.cut) > len(self.codes):
                # a scan of the block costs less than the probes
                self.scans += 1
                for some in _parts(active, len(self.codes)):
                    x = queries[some][:, None] ^ self.codes[None, :]
                    fresh = np.ones(x.shape, bool)
                    for b in self.bits:
                        fresh &= np.bitwise_count(x & b) >= r
                    i, at = np.nonzero(fresh)
                    met.append((some[i], at))
                covered = BITS
            else:
                for j, (_, width) in enumerate(self.cut):
                    for some in _parts(active, comb(width, r)) if r <= width else ():
                        i, at = self._probe(queries[some], j, r)
                        x = queries[some[i]] ^ self.codes[at]
                        # earlier segments did not reach it in this round, nor later ones in the round before
                        fresh = np.ones(len(x), bool)
                        for e, b in enumerate(self.bits):
                            if e != j:
                                fresh &= np.bitwise_count(x & b) >= r + (e < j)
                        met.append((some[i[fresh]], at[fresh]))
                covered = len(self.cut) * (r + 1) - 1
            q, c = (np.concatenate(v) for v in zip(*met, strict=True))
            d = np.bitwise_count(queries[q] ^ self.codes[c]).astype(np.int64)
            order = np.lexsort((self.codes[c], self.first[c], d, q))
            q, c, d = q[order], c[order], d[order]
            start = np.searchsorted(q, q)
            keep = np.arange(len(q)) - start < k
            q, c, d, start = q[keep], c[keep], d[keep], np.searchsorted(q[keep], q[keep])
            # the kth verified distance, counting the rows of each code
            upto = np.cumsum(self.n[c])
            upto -= (upto - self.n[c])[start]
            full = upto >= k
            kth = np.full(len(queries), BITS + 1)
            np.minimum.at(kth, q[full], d[full])
            active = active[kth[active] > covered] if covered < BITS else active[:0]
            if not len(active):
                break
        return q, c, d


def _search(k: int, scan: bool):
    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if index.num_rows:
            get = lambda t, c, kind: t.column(c).to_numpy().astype(kind)
            block = Index(get(index, "code", np.int64).view(np.uint64), get(index, "first", np.int64), get(index, "n", np.int64))
            asked = get(queries, "q", np.int64).view(np.uint64)
            for at in range(0, len(asked), 128):
                some = asked[at:at + 128]
                q, c, d = block.search(some, k, scan)
                found.append(pa.table({"q": some[q].view(np.int64), "code": block.codes[c].view(np.int64),
                                       "distance": d.astype(np.int32), "first": block.first[c]}))
        return pa.concat_tables(found) if found else FOUND.empty_table()
    return run


FOUND = pa.schema([("q", pa.int64()), ("code", pa.int64()), ("distance", pa.int32()), ("first", pa.int64())])


def top_k(rows: DataFrame, queries: DataFrame, k: int = K, *, index_block: int = INDEX_BLOCK,
          query_block: int = QUERY_BLOCK, least_blocks: int = 4, scan: bool = False) -> DataFrame:
    """(query_id, rank, id, distance) of the k nearest rows; rows: (id, code), queries: (query_id, code).

    Extra columns are not read."""
    held = write_table(_least(rows.filter("code is not null").select("id", "code"), "code", ["id"], k).groupBy("code").agg(
        F.sort_array(F.collect_list("id")).alias("ids")), "mih-codes")  # at most k ids a code
    queries = queries.filter("code is not null")
    asked = write_table(queries.select(F.col("code").alias("q")).distinct(), "mih-queries")
    n_index = max(1, -(-held.count() // index_block))
    n_query = max(least_blocks, -(-asked.count() // query_block))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = held.select("code", F.col("ids")[0].alias("first"), F.size("ids").cast("long").alias("n"),
                       dealt("code", n_index).alias("i"), every(n_query).alias("j"))
    right = asked.select("q", dealt("q", n_query).alias("j"), every(n_index).alias("i"))
    met = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(
        _search(k, scan), "q long, code long, distance int, first long")
    best = _least(write_table(met, "mih-found"), "q", ["distance", "first", "code"], k)
    near = best.join(held.select("code", "ids"), "code").select("q", "distance", F.explode("ids").alias("id"))
    order = Window.partitionBy("q").orderBy("distance", "id")
    near = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return (queries.select("query_id", F.col("code").alias("q")).distinct().join(near, "q")
            .select("query_id", "rank", "id", "distance"))


def embeddings_top_k(embeddings: DataFrame, k: int = K, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, distance): queries are the rows whose vec_id is divisible by ``every``."""
    rows = pick(embeddings, id="vec_id", embedding="embedding").select("id", sign_code("embedding").alias("code"))
    queries = rows.filter(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "code")
    return top_k(rows, queries, k).withColumnRenamed("id", "vec_id")
