"""op13: the threshold algorithm against brute force, ties, odd vectors, blocks and hot labels."""

import math
import random

import numpy as np
import pytest

from riskweave.llm import negatives as N
from tests.llm.conftest import rows_of

SCHEMA = "vec_id long, embedding array<float>, label int"
COLS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows):
    """By definition, row by row."""
    seen = set()
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        seen.add((i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    out = []
    for i, label, v in seen:
        if i % 100:
            continue
        score = lambda w: max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(v, w, strict=False))))  # noqa: E731, B023
        ranked = sorted((-score(w), j, lab) for j, lab, w in seen if j != i)
        for p, j, _ in [r for r in ranked if r[2] == label][:5]:
            hard = [(n, s) for s, n, lab in ranked if lab != label and 80 * -p <= 100 * -s <= 100 * -p][:5]
            out += [(i, j, k + 1, n, -p, -s) for k, (n, s) in enumerate(hard)]
    # an anchor id with several rows may repeat a window
    return sorted(out, key=repr)


def data(seed, n, dim, labels=3, spread=1.0):
    r = random.Random(seed)
    return [(i, [r.gauss(0.3 if d < 2 else 0, spread) for d in range(dim)], r.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("seed, n, dim, labels", [(1, 400, 3, 2), (2, 700, 8, 4), (3, 300, 1, 2), (4, 900, 16, 10)])
def test_equals_brute_force(llm, seed, n, dim, labels):
    rows = data(seed, n, dim, labels)
    df = llm.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert want and rows_of(N.hard_negatives(df), *COLS) == want
    assert rows_of(N.hard_negatives(df, block_rows=64, anchor_block=2), *COLS) == want


def test_ties_copies_and_a_hot_label(llm):
    rows = [(i, [0.5, 0.25], 1) for i in range(0, 600)] + [(1000 + i, [0.5, 0.2], i % 2) for i in range(300)]
    rows += rows[:50] + [(100, [0.1, 0.9], 1)]
    rows += [(5000 + i, [0.0, 0.0], 2) for i in range(101)]
    got = rows_of(N.hard_negatives(llm.createDataFrame(rows, SCHEMA), block_rows=100), *COLS)
    assert got == brute(rows)


def test_odd_rows_take_no_part(llm):
    rows = data(5, 200, 4)
    rows += [(None, [1.0] * 4, 1), (300, None, 1), (400, [1.0] * 4, None), (500, [1.0, None, 1.0, 1.0], 1),
             (600, [float("nan")] * 4, 1), (700, [float("inf")] * 4, 1), (800, [1.0], 1), (801, [], 2), (900, [2.0] * 9, 2)]
    df = llm.createDataFrame(rows, SCHEMA)
    assert rows_of(N.hard_negatives(df), *COLS) == brute(rows)
    clash = df.selectExpr("*", "'x' AS id", "1 AS vec", "2 AS key", "3 AS slab", "4 AS rank")
    assert rows_of(N.hard_negatives(clash), *COLS) == brute(rows)


def test_huge_components_are_exact(llm):
    rows = [(0, [1e30, 1.0], 1), (1, [1e-3, 5.0], 1), (2, [3e-25, 7.0], 2), (3, [1.0, 4.0], 2), (4, [-1e30, 1.0], 1), (5, [0.0, 1.0], 2)]
    assert rows_of(N.hard_negatives(llm.createDataFrame(rows, SCHEMA)), *COLS) == brute(rows)


def test_empty_and_negative_windows(llm):
    assert N.hard_negatives(llm.createDataFrame([], SCHEMA)).count() == 0
    rows = [(0, [1.0], 1), (1, [-1.0], 1), (2, [-1.1], 2), (3, [-0.9], 2)]
    assert N.hard_negatives(llm.createDataFrame(rows, SCHEMA)).count() == 0


def test_the_threshold_ends_a_search_early():
    r = np.random.default_rng(3)
    x = r.integers(-20, 20, (20_000, 4))
    x[:40] *= 30
    block = N.Lists(np.arange(20_000), x)
    (got,) = block.search(np.array([7, -3, 2, 0]), np.zeros(20_000, bool), [(N.LEAST, N.MOST)], 5)
    score = x @ np.array([7, -3, 2, 0])
    want = np.lexsort((np.arange(20_000), -score))[:5]
    assert got[0].tolist() == want.tolist() and block.reads < 2_000
