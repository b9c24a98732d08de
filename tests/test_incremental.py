"""The stored summary after change sets equals a full rebuild, and reads only touched partitions."""

import datetime as dt
import random
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskweave.operators import exposure as C
from riskweave.operators import incremental as I

FACT = "id int, counterparty_code string, as_of_date date, variant_id string, base_total_exposure decimal(18,2)"
DAYS = [dt.date(2026, m, 28) for m in range(1, 5)] + [None]
CODES = [f"c{i}" for i in range(8)]


def dims(spark):
    variants = spark.createDataFrame([(f"{c}-{v}", f"s{v}") for c in CODES for v in range(3)], "variant_id string, source_system string")
    dim = spark.createDataFrame([(c, c.upper(), Decimal(900)) for c in CODES], "counterparty_code string, counterparty_legal_name string, threshold_principal decimal(18,2)")
    legal = spark.createDataFrame([(f"L{c}", "P", c, c, False) for c in CODES] + [("L0", "P", "c0 again", "c0", False)],
                                  "lei_code string, ultimate_parent_name string, legal_entity_name string, counterparty_code string, is_ultimate_parent boolean")
    return variants, dim, legal


def facts(r, ids, hidden):
    out = []
    for i in ids:
        code = r.choice([*CODES, None]) if not hidden else r.choice(CODES)
        out.append((i, code, r.choice(DAYS), f"{code}-{r.randrange(4)}" if hidden else None, Decimal(r.randint(0, 50000)) / 100))
    return out


def rows(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr)


@pytest.fixture
def rig(spark, tmp_path):
    return I.ExposureStore(spark, str(tmp_path / "store"), buckets=3), dims(spark)


def frame(spark, some):
    return spark.createDataFrame(some, FACT)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_changes_equal_a_rebuild(spark, rig, seed):
    store, d = rig
    r = random.Random(seed)
    known, hidden = {f[0]: f for f in facts(r, range(120), False)}, {f[0]: f for f in facts(r, range(1000, 1060), True)}
    entries = lambda k, h: I.exposure_entries(frame(spark, k), frame(spark, h))
    store.refresh_summary(*d, store.create(entries([*known.values()], [*hidden.values()])))
    fresh = 2000
    for number in range(1, 4):
        old_k, old_h, new_k, new_h = [], [], [], []
        for f in r.sample(sorted(known.values(), key=lambda f: f[0]), 12):           # code changes
            g = (f[0], r.choice(CODES), *f[2:])
            old_k.append(f)
            new_k.append(g)
            known[f[0]] = g
        for f in r.sample(sorted((f for f in known.values() if f[1]), key=lambda f: f[0]), 10):   # resets
            now = known.pop(f[0])
            if now in new_k:
                new_k.remove(now)
            else:
                old_k.append(now)
            h = (f[0], now[1], now[2], f"{now[1]}-{r.randrange(3)}", now[4])
            hidden[f[0]] = h
            new_h.append(h)
        late = facts(r, range(fresh, fresh + 15), False)                              # inserts
        fresh += 15
        known.update({f[0]: f for f in late})
        new_k += late
        gone = hidden.pop(r.choice(sorted(hidden)))                                   # a delete
        (new_h.remove(gone) if gone in new_h else old_h.append(gone))
        store.refresh(I.change_set(entries(old_k, old_h), entries(new_k, new_h)), number, *d)
        want = C.true_exposure_summary(C.known_exposure(frame(spark, [*known.values()])), C.hidden_exposure(frame(spark, [*hidden.values()]), d[0]), *d[1:])
        assert rows(store.summary()) == rows(want.filter("counterparty_code IS NOT NULL"))


def one(code, day, amount, variant=None):
    return (1, code, day, variant, Decimal(amount))


def test_a_change_set_counts_once(spark, rig):
    store, d = rig
    store.refresh_summary(*d, store.create(I.exposure_entries(frame(spark, [one("c1", DAYS[0], 10)]))))
    change = I.change_set(after=I.exposure_entries(frame(spark, [one("c1", DAYS[0], 5), one("c2", DAYS[1], 7)])))
    for _ in range(3):                     # as a refresh that failed and is run again
        store.refresh(change, 1, *d)
    assert {(r.counterparty_code, r.known_exposure) for r in store.summary().collect()} == {("c1", 15), ("c2", 7)}
    store.refresh(change, 2, *d)           # the same facts once more, as a set of its own
    assert {(r.counterparty_code, r.known_exposure) for r in store.summary().collect()} == {("c1", 20), ("c2", 14)}


def test_a_group_that_loses_all_facts_goes(spark, rig):
    store, d = rig
    fact = I.exposure_entries(frame(spark, [one("c1", DAYS[0], 10)]))
    store.refresh_summary(*d, store.create(fact))
    store.refresh(I.change_set(before=fact), 1, *d)
    assert store.summary().count() == 0 and store.state().filter("kind != 'mark'").count() == 0
    with pytest.raises(Exception, match="not in the store"):
        store.apply(I.change_set(before=fact), 2)


def test_only_touched_partitions_are_read_and_written(spark, rig):
    store, d = rig
    r = random.Random(5)
    store.refresh_summary(*d, store.create(I.exposure_entries(frame(spark, facts(r, range(300), False)), frame(spark, facts(r, range(400, 500), True)))))
    before = set(store.state().inputFiles()), set(store.summary().inputFiles())
    touched = store.refresh(I.change_set(after=I.exposure_entries(frame(spark, [one("c3", DAYS[2], 9)]))), 1, *d)
    assert len(touched) == 1
    place = f"as_of_date={DAYS[2]}/bucket={touched[0][1]}"
    for old, now in zip(before, (store.state(), store.summary()), strict=True):
        files = set(now.inputFiles())
        assert files - old and all(place in f for f in files ^ old)
    plan = store.state(touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert all(place in r[0] for r in store.state(touched).select(F.input_file_name()).distinct().collect())


def test_another_number_of_buckets_is_refused(spark, rig, tmp_path):
    store, _ = rig
    store.create(I.exposure_entries(frame(spark, [one("c1", DAYS[0], 10)])))
    other = I.ExposureStore(spark, str(tmp_path / "store"), buckets=1)
    with pytest.raises(ValueError, match="buckets"):
        other.apply(I.change_set(after=I.exposure_entries(frame(spark, [one(c, DAYS[0], 1) for c in CODES]))), 1)


def test_a_refresh_writes_its_contents_once(spark, rig):
    store, d = rig
    store.refresh_summary(*d, store.create(I.exposure_entries(frame(spark, [one("c1", DAYS[0], 10)]))))
    copies = lambda: len(list(Path(spark.conf.get("spark.checkpoint.dir")).rglob("exposure-store-*")))
    before = copies()
    store.refresh(I.change_set(after=I.exposure_entries(frame(spark, [one("c1", DAYS[0], 5)]))), 1, *d)
    assert copies() == before


def test_hidden_exposure_of_variants_listed_several_times(spark):
    """Two distinct counts would send every row three times (Expand)."""
    listed = [("v1", "s1"), ("v1", "s1"), ("v1", "s2"), ("v2", "s1"), ("v3", None), ("v4", "s9"), (None, "s8")]
    variants = spark.createDataFrame(listed, "variant_id string, source_system string")
    got = C.hidden_exposure(frame(spark, [one("c1", DAYS[0], 10, "v1"), one("c1", DAYS[0], 2, "v1"), one("c1", DAYS[0], 5, "v2"),
                                          one("c2", DAYS[1], 7, "v3"), one("c2", DAYS[1], 1, None), one(None, None, 3, "v1")]), variants)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert {(r.counterparty_code, r.hidden_exposure, r.variant_count, r.source_system_count) for r in got.collect()} == {
        ("c1", 41, 2, 2), ("c2", 7, 1, 0), (None, 9, 1, 2)}
