"""As-of joins against a search through all versions; hot keys in shares; odd versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import versions as V

D0 = dt.date(2024, 1, 1)
day = lambda n: None if n is None else D0 + dt.timedelta(days=n)


def search(rows, versions):
    out = []
    for i, k, t in rows:
        own = [] if k is None or t is None else [v for v in versions if v[0] == k and v[1] is not None and v[1] <= t]
        if not own:
            out.append((i, None, None, False))
            continue
        start = max(v[1] for v in own)
        same = {v[2:] for v in own if v[1] == start}
        if len(same) > 1:
            out.append((i, None, start, True))
        else:
            ((end, rule),) = same
            open_ = end is None or end > t
            out.append((i, rule if open_ else None, start if open_ else None, False))
    return sorted(out, key=repr)


def joined(spark, rows, versions, **params):
    left = spark.createDataFrame(rows, "id int, k string, t date").withColumn("rule_id", F.lit(1))
    right = spark.createDataFrame(versions, "k string, valid_from date, valid_to date, rule string")
    out = V.as_of_join(left, right, ["k"], "t", ["rule"], valid_to="valid_to", **params)
    assert out.columns == ["id", "k", "t", "rule_id", "rule", "version_from", "version_conflict"]
    return sorted(((r.id, r.rule, r.version_from, r.version_conflict) for r in out.collect()), key=repr)


@pytest.mark.parametrize("tile_days, rows_a_task", [(64, 200_000), (3, 4), (1, 1), (1000, 5)])
def test_equals_a_search(spark, tile_days, rows_a_task):
    r = random.Random(tile_days)
    keys = ["a"] * 6 + ["b", "c", None]
    rows = [(i, r.choice(keys), day(r.choice([None, *range(-40, 200)]))) for i in range(300)]
    rows += [(900, "a", day(5))] * 3
    versions = [(r.choice(["a", "b", "z", None]), day(r.randrange(0, 150)), day(r.choice([None, r.randrange(20, 300)])), f"R{r.randrange(4)}") for _ in range(60)]
    versions += [versions[0], ("b", None, None, "R9"), ("a", day(30), None, "X"), ("a", day(30), None, "Y")]
    assert joined(spark, rows, versions, tile_days=tile_days, rows_a_task=rows_a_task) == search(rows, versions)


def test_no_versions_and_timestamps(spark):
    rows = [(1, "a", day(3)), (2, None, day(3))]
    assert joined(spark, rows, []) == search(rows, [])
    left = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 9, 0)), ("a", dt.datetime(2024, 1, 1, 11, 0))], "k string, t timestamp_ntz")
    right = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 10, 0), "x")], "k string, valid_from timestamp_ntz, rule string")
    assert [r.rule for r in V.as_of_join(left, right, ["k"], "t", ["rule"]).orderBy("t").collect()] == [None, "x"]


def test_a_hot_key_is_shared_out(spark):
    left = spark.range(6000).select(F.lit("hot").alias("k"), F.date_add(F.lit(D0), (F.col("id") % 3).cast("int")).alias("t"), "id")
    right = spark.createDataFrame([("hot", day(-9), "a"), ("hot", day(1), "b")], "k string, valid_from date, rule string")
    out = V.as_of_join(left, right, ["k"], "t", ["rule"], rows_a_task=500)
    assert {(r.rule, r["count"]) for r in out.groupBy("rule").count().collect()} == {("a", 2000), ("b", 4000)}
    # no window partition holds more than a few shares' rows
    parts = out.groupBy(F.spark_partition_id().alias("p")).count()
    assert parts.count() > 1
