"""Sketched profiles, Euler contributions, checksum trees and column lineage on small tables."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskweave.operators import allocation as L
from riskweave.operators import checksum as S
from riskweave.operators import governance as G
from riskweave.operators import risk as H
from riskweave.operators import sketch as X
from riskweave.operators import star as D

PATHS = "netting_set string, trade_id string, scenario string, path_id long, time_y double, value decimal(18,2)"
G3 = ["netting_set", "scenario", "time_y"]


def path_values(spark, seed, n=60):
    r = random.Random(seed)
    rows = [(s, f"t{t}", "base", p, y, Decimal(r.choice([r.randint(-90000, 150000), 5000])) / 100)
            for s in ("A", "B") for t in range(4) for p in range(n) for y in (1.0, 2.0) if r.random() < 0.7]
    return spark.createDataFrame(rows + rows[:9], PATHS)


# ---- sketches ------------------------------------------------------------------------

@pytest.mark.parametrize("error", [0.001, 0.01, 0.1])
def test_a_sketch_is_within_its_error(spark, error):
    net = H.net_exposure(path_values(spark, 1))
    exact = {tuple(r[c] for c in G3): r for r in H.exposure_profile(net, 60, 0.95).collect()}
    got = X.profile_from_sketch(X.exposure_sketch(net, error), 60, 0.95).collect()
    assert len(got) == len(exact) == 4
    for r in got:
        want = exact[tuple(r[c] for c in G3)]
        assert r.ee == pytest.approx(want.ee) and r.mtm == pytest.approx(want.mtm) and abs(r.pfe - want.pfe) <= error * want.pfe * 1.0001


def test_merged_sketches_equal_one_and_errors_must_agree(spark):
    net = H.net_exposure(path_values(spark, 2)).cache()
    parts = [X.exposure_sketch(net.filter(F.col("path_id") % 3 == i)) for i in range(3)]
    key = lambda df: sorted(map(tuple, df.select(*G3, "bucket", "paths", "exposure_sum", "mtm_sum").collect()), key=repr)
    assert key(X.merge_sketches(*parts)) == key(X.exposure_sketch(net))
    with pytest.raises(Exception, match="do not merge"):
        X.merge_sketches(parts[0], X.exposure_sketch(net, 0.02)).collect()
    with pytest.raises(Exception, match="more than 5 paths"):
        X.profile_from_sketch(X.exposure_sketch(net), 5).collect()


# ---- Euler contributions ----------------------------------------------------------------

@pytest.mark.parametrize("n, level", [(60, 0.95), (61, 0.9), (100, 0.5), (70, 1.0)])
def test_contributions_add_up(spark, n, level):
    values = path_values(spark, 3)
    prof = {tuple(r[c] for c in G3): r for r in H.exposure_profile(H.net_exposure(values), n, level).collect()}
    ee, pfe = L.ee_contributions(values, n), L.pfe_contributions(values, n, level)
    total = lambda df, c: {tuple(r[x] for x in G3): r.s for r in df.groupBy(*G3).agg(F.sum(c).alias("s")).collect()}
    ees, pfes = total(ee, "ee_contribution"), total(pfe, "pfe_contribution")
    for k, r in prof.items():
        assert ees.get(k, 0.0) == pytest.approx(r.ee) and pfes.get(k, 0.0) == pytest.approx(r.pfe, abs=1e-6)


def test_tied_paths_share_the_percentile(spark):
    rows = [("A", t, "base", p, 1.0, Decimal(v)) for p in range(4) for t, v in ((("a", 10), ("b", 0)) if p % 2 else (("a", 0), ("b", 10)))]
    got = {r.trade_id: r.pfe_contribution for r in L.pfe_contributions(spark.createDataFrame(rows, PATHS), 4, 0.5).collect()}
    assert got == pytest.approx({"a": 5.0, "b": 5.0})


def test_cva_contributions_add_up(spark):
    values = path_values(spark, 4)
    quotes = spark.createDataFrame([("c", 1.0, 80.0), ("c", 5.0, 140.0)], "curve_id string, tenor_y double, spread_bp double")
    prof = H.exposure_profile(H.net_exposure(values), 60).select("netting_set", F.when(F.col("netting_set") == "A", "c").otherwise("none").alias("curve_id"), "time_y", "ee")
    want = {r.netting_set: (r.cva, r.times_without_pd) for r in H.cva_on_quotes(prof, quotes).collect()}
    parts = L.cva_contributions(L.ee_contributions(values, 60), prof, quotes)
    got = {r.netting_set: (r.c, r.n) for r in parts.groupBy("netting_set").agg(F.sum("cva_contribution").alias("c"), F.max("times_without_pd").alias("n")).collect()}
    assert got["A"][0] == pytest.approx(want["A"][0]) and got["B"] == (None, 2) and want["B"][1] == 2


# ---- named stress sets --------------------------------------------------------------------

def test_parts_of_a_stress_set_add_up(spark):
    quotes = spark.createDataFrame([("A", 1.0, 100.0), ("A", 5.0, 200.0), ("B", 1.0, 50.0)], "curve_id string, tenor_y double, spread_bp double")
    shocks = spark.createDataFrame([("s", None, None, 1.0, 10.0, 50.0), ("s", "A", 1.0, None, 5.0, None), ("t", "B", 2.0, None, 7.0, None), (None, "A", None, None, 9.0, 9.0)],
                                   "scenario string, curve_id string, tenor_from double, tenor_to double, shift_bp double, shift_pct double")
    got = {(r.curve_id, r.tenor_y, r.scenario): (r.spread_bp, r.shift_bp) for r in H.stress_curves(quotes, shocks).collect()}
    base = {("A", 1.0): 100.0, ("A", 5.0): 200.0, ("B", 1.0): 50.0}
    want = {(*k, s): (v, 0.0) for k, v in base.items() for s in ("base", "s", "t")}
    want.update({("A", 1.0, "s"): (165.0, 65.0), ("A", 5.0, "s"): (205.0, 5.0), ("B", 1.0, "s"): (85.0, 35.0)})
    assert got == want
    assert {r.scenario for r in H.stress_curves(quotes, shocks.limit(0)).collect()} == {"base"}
    pv = spark.createDataFrame([("x", "base", 10.0), ("x", "s", 7.0), ("y", "s", 1.0), (None, "base", 2.0), (None, "t", 5.0)], "trade_id string, scenario string, pv double")
    assert {(r.trade_id, r.scenario, r.change) for r in H.stressed_values(pv).collect()} == {("x", "s", -3.0), ("y", "s", None), (None, "t", 3.0)}


# ---- checksum tree --------------------------------------------------------------------------

SIDE = "k int, j string, v decimal(18,2)"


def side(spark, rows):
    return spark.createDataFrame(rows, SIDE)


@pytest.mark.parametrize("levels", [(10, 20), (2, 4, 8), (1,)])
def test_checksums_find_the_rows_that_differ(spark, levels):
    r = random.Random(6)
    a = [(i % 400 if i % 50 else None, r.choice(["x", None]), Decimal(r.randint(0, 9)) if i % 17 else None) for i in range(900)]
    b = [x for i, x in enumerate(a) if i % 90] + [(9999, "new", Decimal(1)), (None, None, Decimal(3))]
    b[10] = (b[10][0], b[10][1], Decimal(77))
    r.shuffle(b)
    whole = D.reconcile(side(spark, a), side(spark, b), ["k", "j"], "v").filter("status != 'EQUAL'")
    part = S.reconcile_by_checksum(side(spark, a), side(spark, b), ["k", "j"], "v", levels=levels)
    assert sorted(map(tuple, part.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


def test_equal_tables_move_one_row_a_range(spark):
    a = spark.range(20_000).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("j"), F.lit(1).cast("decimal(18,2)").alias("v"))
    b = a.orderBy(F.desc("k")).unionByName(side(spark, [(7, "x", Decimal(1)), (8, "x", Decimal(5)), (8, "x", Decimal(-5))]))
    odd = S.differing_ranges(a, b, ["k", "j"], "v")
    assert odd.count() == 2
    out = S.reconcile_by_checksum(a, b, ["k", "j"], "v")
    assert [(r.k, r.status) for r in out.collect()] == [(7, "DIFFERS")]     # 8 is split over other rows of the same sum
    plan = out._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning(k")[1]
    assert "BroadcastHashJoin" in below and "LeftSemi" in below              # ranges are filtered before the shuffle
    with pytest.raises(ValueError, match="same types"):
        S.reconcile_by_checksum(a, b.withColumn("k", F.col("k").cast("long")), ["k", "j"], "v")


# ---- column lineage ------------------------------------------------------------------------------

EDGE = "product_id string, column_name string, upstream_product string, upstream_column string, transform string"


@pytest.mark.parametrize("seed", [1, 2])
def test_columns_reached_equal_a_search(spark, seed):
    r = random.Random(seed)
    cols = [(f"p{i % 4}", f"c{i}") for i in range(25)]
    edges = [(*r.choice(cols), *r.choice(cols), r.choice(["identity", "rename", "hash", None])) for _ in range(40)] + [("p0", None, "p1", "c1", "hash")]
    starts = [*r.sample(cols, 3), ("p9", "none"), (None, "c1")]
    want = {}
    for s in starts[:4]:
        hops, kept, todo = {s: 0}, {s}, [s]
        for at in todo:
            for e in edges:
                if e[2:4] == at and e[1] and e[:2] not in hops:
                    hops[e[:2]] = hops[at] + 1
                    todo.append(e[:2])
        todo = [s]
        for at in todo:
            for e in edges:
                if e[2:4] == at and e[4] in ("identity", "rename") and e[:2] not in kept:
                    kept.add(e[:2])
                    todo.append(e[:2])
        want.update({(*s, *c): (h, c in kept) for c, h in hops.items()})
    got = G.column_closure(spark.createDataFrame(edges, EDGE), spark.createDataFrame(starts, "product_id string, column_name string"))
    assert {tuple(x)[:4]: tuple(x)[4:] for x in got.collect()} == want
