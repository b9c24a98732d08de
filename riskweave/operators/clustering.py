"""B. Records clustered into counterparties from weighted links, at most one canonical name each.

Links of any rule (B6 to B8, token sets, abbreviations) say how strongly two records belong
together. The strongest links are taken first, and a link that would bring two canonical
names into one cluster is refused: a chain between two names is cut at its weakest link.
That is the forest of greatest weight whose trees hold one canonical name at most.

It is built in Boruvka rounds instead of link by link: every cluster without a canonical
name takes its strongest link to another cluster, all at once. With a strict order of links
(weight, then the records) the forest is unique, so the result is that of taking them one
by one. Clusters at least halve in number each round; chains of clusters that take each
other are joined by path doubling. Nothing is gathered: a cluster of a third of all records
is a hot key of partial aggregations and of joins that adaptive execution splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_counted, write_scratch
from .hierarchy import climb


def _valid(links: DataFrame) -> DataFrame:
    return links.filter("a IS NOT NULL AND b IS NOT NULL AND a != b AND weight IS NOT NULL").withColumn("weight", F.col("weight").cast("double"))


def strongest_to_names(links: DataFrame) -> DataFrame:
    """Of links (a, b, weight) whose ``b`` are all canonical names: the strongest one of each ``a``.

    Once that one is taken or refused, the cluster of ``a`` holds a canonical name, so its weaker
    links to names can only be refused. ``cluster_records`` gives the same clusters without them
    (their records are kept: ``a`` in its strongest link, ``b`` as a name).
    """
    link = F.struct((-F.col("weight")).alias("minus"), F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"), "b")
    best = _valid(links).groupBy("a").agg(F.min(link).alias("link"))
    return best.select("a", "link.b", (-F.col("link.minus")).alias("weight"))


def cluster_records(links: DataFrame, canonical: DataFrame) -> DataFrame:
    """(record, cluster_id, has_canonical) of every record in ``links`` (a, b, weight) or ``canonical`` (record).

    cluster_id is the cluster's canonical name, or its least record. Links are undirected;
    of several between two records the strongest counts, and those with a NULL record or
    weight are none. Runs when called, at most log2(records) rounds.
    """
    named = write_scratch(canonical.select("record").filter("record IS NOT NULL").distinct(), "cluster-names")
    pairs = _valid(links).select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"), "weight")
    best = F.min(F.struct((-F.col("weight")).alias("minus"), F.col("u"), F.col("v")))
    edges = write_scratch(pairs.groupBy(F.col("u").alias("cu"), F.col("v").alias("cv")).agg(best.alias("link")), "cluster-links")
    seeds = named.select(F.col("record").alias("_s"))
    taken: list[DataFrame] = []
    while True:
        ends = edges.select(F.col("cu").alias("node"), F.col("cv").alias("up"), "link").unionByName(
            edges.select(F.col("cv").alias("node"), F.col("cu").alias("up"), "link"))
        free = ends.join(seeds, F.col("node") == F.col("_s"), "left_anti")
        picks, n = write_counted(free.groupBy("node").agg(F.min(F.struct("link", "up")).getField("up").alias("up")), "cluster-picks")
        if not n:
            break
        # two clusters that take each other: the lesser one stays
        back = picks.select(F.col("node").alias("up"), F.col("up").alias("_back"))
        moves = picks.join(back, "up", "left").filter(~(F.coalesce(F.col("_back") == F.col("node"), F.lit(False)) & (F.col("node") < F.col("up"))))
        tops = write_scratch(climb(moves.select("node", "up"), {}).select("node", "top"), "cluster-tops")
        taken.append(tops)
        for end in ("cu", "cv"):
            new = tops.select(F.col("node").alias(end), F.col("top").alias("_top"))
            edges = edges.join(new, end, "left").withColumn(end, F.coalesce("_top", end)).drop("_top")
        lo, hi = F.least("cu", "cv").alias("cu"), F.greatest("cu", "cv").alias("cv")
        edges = edges.filter("cu != cv").select(lo, hi, "link").groupBy("cu", "cv").agg(F.min("link").alias("link"))
        both = edges.join(seeds, F.col("cu") == F.col("_s"), "left_semi").join(seeds, F.col("cv") == F.col("_s"), "left_semi").select("cu", "cv")
        edges = write_scratch(edges.join(both, ["cu", "cv"], "left_anti"), "cluster-links")
    records = (pairs.select(F.explode(F.array("u", "v")).alias("record")).unionByName(named).distinct())
    if taken:
        # each record points up once, in the round in which its cluster went into another
        roots = climb(reduce(DataFrame.unionByName, taken).withColumnRenamed("top", "up"), {}).select(F.col("node").alias("record"), F.col("top").alias("root"))
        records = records.join(roots, "record", "left")
    else:
        records = records.withColumn("root", F.lit(None).cast("string"))
    records = write_scratch(records.select("record", F.coalesce("root", "record").alias("root")), "cluster-records")
    least = records.groupBy("root").agg(F.min("record").alias("least"))
    is_named = named.select(F.col("record").alias("root"), F.lit(True).alias("_named"))
    return records.join(least, "root").join(is_named, "root", "left").select(
        "record", F.when(F.col("_named"), F.col("root")).otherwise(F.col("least")).alias("cluster_id"),
        F.coalesce("_named", F.lit(False)).alias("has_canonical"))


def refused_links(links: DataFrame, clusters: DataFrame) -> DataFrame:
    """The links between two clusters: what was cut to keep canonical names apart."""
    side = lambda c: clusters.select(F.col("record").alias(c), F.col("cluster_id").alias(f"cluster_{c}"))
    return links.join(side("a"), "a").join(side("b"), "b").filter("cluster_a != cluster_b")
