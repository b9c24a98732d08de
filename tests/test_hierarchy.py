"""Ownership closure and consolidation: depth, rounds, cycles, hot parents, brute force."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskweave.operators import governance as G
from riskweave.operators import hierarchy as T


def edges(spark, rows):
    return spark.createDataFrame(rows, "child string, parent string, share double")


def walk(rows):
    """(status, ultimate parent, depth, cycle id) by walking up, one link at a time."""
    best = {}
    for c, p, s in rows:
        if c is not None and p is not None and c != p:
            key = (-(s or 0.0), p)
            best[c] = min(best.get(c, key), key)
    out = {}
    for e in {x for c, p, _ in rows for x in (c, p) if x is not None}:
        met, at = [e], e
        while at in best and best[at][1] not in met:
            at = best[at][1]
            met.append(at)
        if at not in best:
            out[e] = ("ROOT" if len(met) == 1 else "OWNED", at, len(met) - 1, None)
        else:
            ring = met[met.index(best[at][1]):]
            out[e] = ("CYCLE" if e in ring else "UNDER_CYCLE", None, None, min(ring))
    return out, {c: p for c, (_, p) in best.items()}


def closure(df):
    return {r.entity: (r.status, r.ultimate_parent, r.depth, r.cycle_id) for r in T.ownership_closure(df).collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_closure_and_sums_equal_a_walk(spark, seed):
    r = random.Random(seed)
    names = [f"e{i}" for i in range(60)]
    rows = [(r.choice(names), r.choice(names), r.choice([None, 0.2, 0.5, 0.8])) for _ in range(70)]
    rows += [(None, "e1", 1.0), ("x", None, 1.0), ("y", "y", 1.0), rows[0], rows[0]]
    want, up = walk(rows)
    assert closure(edges(spark, rows)) == want
    amounts = [(r.choice([*names, "alone"]), Decimal(r.randint(-500, 999)) / 100) for _ in range(200)] + [(None, Decimal(5)), ("e3", None)]
    own = {e: sum((a for n, a in amounts if n == e and a is not None), Decimal(0)) for e in {*want, *(n for n, _ in amounts if n)}}
    total = dict(own)
    for e in want:
        at = e
        while want[e][0] == "OWNED" and at in up:
            at = up[at]
            total[at] += own[e]
    df = spark.createDataFrame(amounts, "entity string, amount decimal(18,2)")
    got = {r.entity: (r.own_exposure, r.consolidated_exposure) for r in T.consolidated_exposure(df, edges(spark, rows)).collect()}
    assert got == {e: (own[e], total[e] if e not in want or want[e][0] in ("ROOT", "OWNED") else None) for e in own}


def test_a_thousand_levels_take_six_rounds(spark, monkeypatch):
    rounds = []
    real = T.write_counted
    monkeypatch.setattr(T, "write_counted", lambda df, name, where: (rounds.append(name), real(df, name, where))[1])
    chain = spark.range(1, 1001).select(F.concat(F.lit("n"), "id").alias("child"), F.concat(F.lit("n"), F.col("id") - 1).alias("parent"))
    got = T.ownership_closure(chain).agg(F.max("depth"), F.countDistinct("ultimate_parent")).first()
    assert tuple(got) == (1000, 1) and rounds.count("climb") == 6


def test_hot_parent_and_empty_edges(spark):
    many = spark.range(3000).select(F.concat(F.lit("c"), "id").alias("child"), F.lit("hub").alias("parent"))
    both = many.unionByName(spark.createDataFrame([("hub", "top")], "child string, parent string"))
    assert {(r.status, r.ultimate_parent, r.depth) for r in T.ownership_closure(both).filter("entity LIKE 'c%'").distinct().collect()} == {("OWNED", "top", 2)}
    assert T.ownership_closure(both.limit(0)).count() == 0


def test_lineage_runs_on_the_doubling(spark, monkeypatch):
    rounds = []
    real = G.write_counted
    monkeypatch.setattr(G, "write_counted", lambda df, name: (rounds.append(name), real(df, name))[1])
    # a long chain, a product of two parents on top of it, and a chain above that
    rows = [(f"n{i}", f"n{i - 1}") for i in range(1, 300)] + [("m", "n299"), ("m", "other")] + [(f"k{i}", f"k{i - 1}" if i else "m") for i in range(200)]
    own = [("n0", "CONFIDENTIAL", False), ("n150", "PUBLIC", True), ("k150", "RESTRICTED", False)]
    df = spark.createDataFrame(rows, "child string, parent string")
    out = G.inherit_classification(df, spark.createDataFrame(own, "product_id string, sensitivity string, pii boolean"))
    got = {r.product_id: (r.sensitivity, r.pii) for r in out.collect()}
    assert got["n149"] == ("CONFIDENTIAL", False) and got["n150"] == got["m"] == got["k149"] == ("CONFIDENTIAL", True)
    assert got["k150"] == got["k199"] == ("RESTRICTED", True) and got["other"] == (None, False)
    assert rounds == ["lineage-frontier"] * len(rounds) and len(rounds) <= 2


@pytest.mark.parametrize("seed", [4, 5, 6, 7])
def test_lineage_equals_a_search(spark, seed):
    r = random.Random(seed)
    names = [f"p{i}" for i in range(40)]
    rows = [(r.choice(names), r.choice(names)) for _ in range(r.choice([30, 45, 70]))]
    own = {n: (r.choice(["PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED", None]), r.random() < 0.2) for n in names if r.random() < 0.4}
    order = [None, *G.SENSITIVITY_ORDER]
    want = {}
    for n in {x for e in rows for x in e if e[0] != e[1]} | set(own):
        seen, todo = {n}, [n]
        while todo:
            at = todo.pop()
            for c, p in rows:
                if c == at and p not in seen:
                    seen.add(p)
                    todo.append(p)
        held = [own[s] for s in seen if s in own]
        want[n] = (max((h[0] for h in held), key=order.index, default=None), any(h[1] for h in held))
    out = G.inherit_classification(spark.createDataFrame(rows, "child string, parent string"),
                                   spark.createDataFrame([(n, *v) for n, v in own.items()], "product_id string, sensitivity string, pii boolean"))
    assert {x.product_id: (x.sensitivity, x.pii) for x in out.collect()} == want


def test_few_entities_of_a_bushy_tree_take_part_in_the_rounds(spark, monkeypatch):
    seen = []
    real = T.write_counted

    def counted(df, name, where):
        out, n = real(df, name, where)
        seen.append((where, n))
        return out, n
    monkeypatch.setattr(T, "write_counted", counted)
    # a binary tree of 1,023 entities under a chain of 20, and 500 that nobody owns and that own nobody
    tree = spark.range(2, 1024).select(F.concat(F.lit("t"), "id").alias("child"), F.concat(F.lit("t"), F.floor(F.col("id") / 2)).alias("parent"))
    chain = spark.range(1, 20).select(F.concat(F.lit("s"), "id").alias("child"), F.concat(F.lit("s"), F.col("id") - 1).alias("parent"))
    links = tree.unionByName(chain).unionByName(spark.createDataFrame([("t1", "s19")], "child string, parent string"))
    amounts = spark.range(1, 1024).select(F.concat(F.lit("t"), "id").alias("entity"), F.lit(1).cast("decimal(18,2)").alias("amount")).unionByName(
        spark.range(500).select(F.concat(F.lit("p"), "id").alias("entity"), F.lit(2).cast("decimal(18,2)").alias("amount")))
    got = {r.entity: r.consolidated_exposure for r in T.consolidated_exposure(amounts, links).collect()}
    assert (got["s0"], got["s19"], got["t1"], got["t2"], got["t1023"], got["p7"]) == (1023, 1023, 1023, 511, 1, 2) and len(got) == 1543
    assert max(n for where, n in seen if where == "far IS NOT NULL") < 100      # all owned entities took part before
