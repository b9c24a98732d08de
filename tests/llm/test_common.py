"""Slices bound bytes and rows; a freed task yields what it would."""

import pyarrow as pa
import pytest

from riskweave.llm.common import freed, slices


def batches(texts, n):
    return (pa.RecordBatch.from_arrays([pa.array(texts[i:i + n], pa.string())], names=["t"]) for i in range(0, len(texts), n))


@pytest.mark.parametrize("texts", [[None] * 95, [""] * 95, ["ab"] * 40 + ["x" * 300] + ["c", None] * 30, []])
@pytest.mark.parametrize("n", [1, 7, 200])
def test_slices_bound_bytes_and_rows(texts, n):
    got = list(slices(batches(texts, n), "t", limit=50, most=20))
    assert [x for b in got for x in b.column(0).to_pylist()] == texts
    for b in got:
        assert 0 < b.num_rows <= 20
        assert b.num_rows == 1 or sum(len(x or "") for x in b.column(0).to_pylist()) <= 50


def test_a_freed_task_ends_its_inner_one():
    ended = []

    def run(got):
        try:
            yield from got
        finally:
            ended.append(True)

    assert [b.num_rows for b in freed(run)(batches(["a"] * 5, 2))] == [2, 2, 1] and ended == [True]
    task = freed(run)(batches(["a"] * 5, 2))
    next(task)
    task.close()
    assert len(ended) == 2
