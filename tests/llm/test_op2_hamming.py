import random

import numpy as np
import pytest

from riskweave.llm import hamming


def brute(rows, queries, k):
    out = []
    for q, c in set(queries):
        if c is None:
            continue
        near = sorted(((bin((c ^ x) & (1 << 64) - 1).count("1"), i) for i, x in rows if x is not None))[:k]
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return sorted(out)


def run(spark, rows, queries, k, **blocks):
    got = hamming.top_k(spark.createDataFrame(rows, "id long, code long"),
                        spark.createDataFrame(queries, "query_id long, code long"), k, **blocks)
    return sorted((r["query_id"], r["rank"], r["id"], r["distance"]) for r in got.collect())


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("n,k", [(300, 5), (40, 60), (3, 2), (1, 1)])
def test_equals_brute_force(llm, n, k):
    rng = random.Random(n)
    centre = [rng.getrandbits(64) for _ in range(4)]
    near = lambda c: c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(12))) & (1 << 64) - 1
    codes = [signed(near(rng.choice(centre)) % (1 << 64)) for _ in range(n)]
    rows = [(i, c) for i, c in enumerate(codes)] + [(n + 1, None)]
    queries = rows[:: max(1, n // 12)] + [(n + 5, signed(rng.getrandbits(64))), (n + 6, None)]
    assert run(llm, rows, queries, k) == brute(rows, queries, k)
    assert run(llm, rows, queries, k, index_block=70, query_block=5) == brute(rows, queries, k)


def test_search_of_a_block_equals_brute_force():
    rng = np.random.default_rng(1)
    for n, spread, k in ((2000, 10, 5), (500, 64, 3), (5000, 4, 10), (1, 64, 1)):
        centre = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
        flips = (np.uint64(1) << rng.integers(0, 64, (n, spread)).astype(np.uint64))
        codes = np.unique(centre[rng.integers(0, 20, n)] ^ np.bitwise_xor.reduce(flips, axis=1))
        first, times = rng.permutation(len(codes)), rng.integers(1, k + 1, len(codes))
        queries = np.concatenate([codes[:20], centre])
        q, c, d = hamming.Index(codes, first, times).search(queries, k)
        for i, code in enumerate(queries):
            every = np.bitwise_count(codes ^ code).astype(int)
            want, total = [], 0
            for at in np.lexsort((codes, first, every)):
                if total < k:
                    want.append((every[at], at))
                total += times[at]
            got = list(zip(d[q == i].tolist(), c[q == i].tolist(), strict=True))
            assert got[:len(want)] == want


def test_shared_queries_end_by_their_covered_radius():
    """On the shared embeddings no search scans, whether it is short of codes or not; with ``scan`` the same comes out."""
    import duckdb
    rows = duckdb.connect().sql("SELECT vec_id, embedding FROM '/root/testdata/sf0.01/embeddings.parquet' ORDER BY 1").fetchall()
    codes = np.array([sum(1 << i for i, x in enumerate(v) if x > 0) for _, v in rows], np.uint64)
    index = hamming.Index(codes, np.arange(len(codes)), np.ones(len(codes), np.int64))
    queries = codes[::50]
    plain, scanned = index.search(queries, 10), index.search(queries, 10, scan=True)
    assert index.scans > 0 and hamming.Index(codes, np.arange(len(codes)), np.ones(len(codes), np.int64)).scans == 0
    for i, code in enumerate(queries):
        every = np.bitwise_count(codes ^ code).astype(int)
        want = np.lexsort((np.arange(len(codes)), every))[:10].tolist()
        assert plain[1][plain[0] == i].tolist() == want == scanned[1][scanned[0] == i].tolist()


def test_hot_code_and_ties(llm):
    rows = [(i, 7) for i in range(200)] + [(500 + i, 7 ^ (1 << i)) for i in range(20)]
    queries = [(i, 7) for i in range(0, 200, 50)] + [(501, 7 ^ 2)]
    assert run(llm, rows, queries, 12) == brute(rows, queries, 12)


def test_repeated_rows_are_neighbours_of_their_own(llm):
    rows = [(1, 5), (1, 5), (2, 4)]
    assert run(llm, rows, [(1, 5)], 3) == [(1, 1, 1, 0), (1, 2, 1, 0), (1, 3, 2, 1)]


def test_empty_tables(llm):
    assert run(llm, [], [(1, 5)], 3) == [] and run(llm, [(1, 5)], [], 3) == []


def test_sign_code_of_null_and_short_embeddings(llm):
    df = llm.createDataFrame([(0, [1.0, -1.0, 2.0], "a"), (50, None, "b"), (100, [None, 1.0, None], "c")],
                             "vec_id long, embedding array<float>, code string")
    got = hamming.embeddings_top_k(df, 2).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["distance"]) for r in got) == [
        (0, 1, 0, 0), (0, 2, 100, 3), (100, 1, 100, 0), (100, 2, 0, 3)]


def test_segments_cover_all_bits():
    for n in (0, 1, 2, 50, 10_000, 10 ** 9, 10 ** 19):
        cut = hamming.segments(n)
        assert sum(w for _, w in cut) == 64 and [s for s, _ in cut] == sorted({s for s, _ in cut})


def test_wider_embeddings_are_refused(llm):
    make = lambda n: llm.createDataFrame([(0, [1.0] * n, "a")], "vec_id long, embedding array<float>, code string")
    assert [(r["vec_id"], r["distance"]) for r in hamming.embeddings_top_k(make(64), 1).collect()] == [(0, 0)]
    with pytest.raises(Exception, match="more than 64 elements"):
        hamming.embeddings_top_k(make(65), 1).collect()
