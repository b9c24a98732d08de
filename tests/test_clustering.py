"""Clusters of records against links taken one by one; canonical names stay apart."""

import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import clustering as K
from riskweave.plans import bound
from tests.conftest import SF_SMALL


def one_by_one(links, names):
    """Strongest link first; one that joins two canonical names is refused."""
    best = {}
    for a, b, w in links:
        if a is not None and b is not None and a != b and w is not None:
            key = (min(a, b), max(a, b))
            best[key] = max(best.get(key, w), w)
    group = {r: {r} for r in {x for k in best for x in k} | set(names)}
    for (u, v), _ in sorted(best.items(), key=lambda kv: (-kv[1], kv[0])):
        a, b = group[u], group[v]
        if a is not b and not (a & names and b & names):
            a |= b
            for r in b:
                group[r] = a
    return {r: (min(g & names or g), bool(g & names)) for r, g in group.items()}


def clusters(spark, links, names):
    out = K.cluster_records(spark.createDataFrame(links, "a string, b string, weight double"), spark.createDataFrame([(n,) for n in names], "record string"))
    rows = out.collect()
    assert len(rows) == len({r.record for r in rows})
    return {r.record: (r.cluster_id, r.has_canonical) for r in rows}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_links_taken_one_by_one(spark, seed):
    r = random.Random(seed)
    records = [f"r{i:02d}" for i in range(80)]
    links = [(r.choice(records), r.choice(records), r.choice([0.5, 0.7, 0.7, 0.9, None])) for _ in range(110)]
    links += [(None, "r01", 1.0), ("r01", None, 1.0), *links[:5]]
    names = {*r.sample(records, 9), "alone"}
    assert clusters(spark, links, names) == one_by_one(links, names)


def test_a_chain_is_cut_at_its_weakest_link(spark):
    links = [("A", "x1", 0.9), ("x1", "x2", 0.8), ("x2", "x3", 0.4), ("x3", "x4", 0.8), ("x4", "B", 0.9), ("p", "q", 0.1)]
    got = clusters(spark, links, {"A", "B"})
    assert {k: v[0] for k, v in got.items()} == {"A": "A", "x1": "A", "x2": "A", "x3": "B", "x4": "B", "B": "B", "p": "p", "q": "p"}
    df = spark.createDataFrame(links, "a string, b string, weight double")
    cut = K.refused_links(df, K.cluster_records(df, spark.createDataFrame([("A",), ("B",)], "record string")))
    assert [(r.a, r.b) for r in cut.collect()] == [("x2", "x3")]


def test_long_chains_and_no_links(spark):
    chain = spark.range(300).select(F.format_string("n%03d", "id").alias("a"), F.format_string("n%03d", F.col("id") + 1).alias("b"), (1 / (F.col("id") + 1)).alias("weight"))
    none = spark.createDataFrame([], "record string")
    assert {(r.cluster_id, r.has_canonical) for r in K.cluster_records(chain, none).collect()} == {("n000", False)}
    assert K.cluster_records(chain.limit(0), none).count() == 0


def test_the_query_equals_links_taken_one_by_one(spark):
    links = [tuple(r) for r in bound._record_links(spark, SF_SMALL).select("a", "b", "weight").collect()]
    names = {r.canonical_name for r in bound._canonical_issuers(spark, SF_SMALL).collect()}
    got = {r.record: (r.cluster_id, r.has_canonical) for r in bound.REGISTRY["cluster_records"](spark, SF_SMALL).collect()}
    assert len(links) > 300 and got == one_by_one(links, names)


@pytest.mark.parametrize("seed", [4, 5])
def test_weaker_links_to_names_change_no_cluster(spark, seed):
    r = random.Random(seed)
    names, others = [f"n{i}" for i in range(9)], [f"r{i:02d}" for i in range(40)]
    near = [(r.choice([*others, *names]), r.choice(names), r.choice([0.5, 0.7, 0.7, 0.9, None])) for _ in range(120)] + [(None, "n1", 1.0), ("r00", None, 1.0)]
    same = [(r.choice(others), r.choice(others), r.choice([0.4, 0.6, 0.8, 0.95])) for _ in range(40)]
    best = [tuple(x) for x in K.strongest_to_names(spark.createDataFrame(near, "a string, b string, weight double")).collect()]
    assert len(best) == len({a for a, _, _ in best}) and set(best) <= set(near)
    assert clusters(spark, best + same, set(names)) == one_by_one(near + same, set(names))


def test_the_query_keeps_one_link_to_a_name_for_each_record(spark, monkeypatch):
    kept, write = {}, bound.write_scratch
    monkeypatch.setattr(bound, "write_scratch", lambda df, name: kept.setdefault(name, write(df, name)))
    bound.REGISTRY["cluster_records"](spark, SF_SMALL)
    names = {r.canonical_name for r in bound._canonical_issuers(spark, SF_SMALL).collect()}
    to_names = [r.a for r in kept["record-links"].collect() if r.b in names]
    assert to_names and len(to_names) == len(set(to_names))
