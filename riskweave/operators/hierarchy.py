"""Ownership over many levels (B13 further): closure and consolidation by path doubling.

A link says who stands directly above a node. A doubling replaces a node's pointer by its
target's pointer, so after k of them a pointer spans 2^k links: a chain of a thousand
entities takes ten. A doubling is one equi-join of the nodes still on their way with all
pointers; ``climb`` makes two in a round (three joins with the round's pointers span four
times as much), as what a round costs beside its joins is the write. Rounds are written
to the shared checkpoint folder, and the driver sees one count a round. A parent of very many children is a hot key of the moving side alone,
which adaptive execution splits, as the pointers hold each node once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_counted, write_scratch

HOPS = 3
ROOT, OWNED, CYCLE, UNDER_CYCLE = "ROOT", "OWNED", "CYCLE", "UNDER_CYCLE"


def climb(links: DataFrame, fold: dict[str, Callable[[Column, Column], Column]]) -> DataFrame:
    """(node, top, hops, cyclic, *fold): where each node's links end, and how many they are.

    ``links`` is (node, up, *columns of fold), each node once; ``fold`` names the columns
    that are folded over the node and all nodes below ``top``, with a function that may
    count a node twice (greatest, least). A node whose links never end has ``cyclic`` set;
    its ``top`` is some node of the cycle above it and its fold covers the whole cycle.

    Without cycles the nodes still on their way grow fewer each round (of those deeper than
    the span, the next one arrives), so a round that loses none has only nodes on or under
    cycles left, and a span of as many links as they are has gone all round.
    """
    cols = list(fold)
    now = links.select("node", F.col("up").alias("top"), F.lit(1).cast("long").alias("hops"), *cols)
    ended: list[DataFrame] = []
    span, before = 1, None
    while True:
        every = reduce(DataFrame.unionByName, [now, *ended])
        look = every.select(F.col("node").alias("_n"), F.col("top").alias("_top"), F.col("hops").alias("_hops"),
                            *[F.col(c).alias(f"_{c}") for c in cols])
        onward, out = F.col("_n").isNotNull(), now
        for _ in range(HOPS):
            out = out.join(look, F.col("top") == F.col("_n"), "left").select(
                "node", F.coalesce("_top", "top").alias("top"), (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops"),
                *[F.when(onward, fold[c](F.col(c), F.col(f"_{c}"))).otherwise(F.col(c)).alias(c) for c in cols],
                onward.alias("_moving"))
        out, n = write_counted(out, "climb", "_moving")
        ended.append(out.filter("NOT _moving").drop("_moving"))
        earlier, now, span = now, out.filter("_moving").drop("_moving"), span * (HOPS + 1)
        if n == 0:
            break
        if n == before and span >= n and now.count() == earlier.count():
            break
        before = n
    done = reduce(DataFrame.unionByName, ended).withColumn("cyclic", F.lit(False))
    return done if n == 0 else done.unionByName(now.withColumn("cyclic", F.lit(True)))


def direct_parents(edges: DataFrame) -> DataFrame:
    """(node, up, parents): the controlling parent of each entity of (child, parent[, share]).

    The greatest share controls, else and in ties the least parent; ``parents`` counts those
    listed. Rows without a child or parent, and entities listed as their own parent (as an
    ultimate parent is), are no links; repeated rows count once.
    """
    e = edges.filter("child IS NOT NULL AND parent IS NOT NULL AND child != parent")
    share = F.coalesce(F.col("share").cast("double"), F.lit(0.0)) if "share" in edges.columns else F.lit(0.0)
    return (e.select(F.col("child").alias("node"), "parent", share.alias("share"))
             .groupBy("node", "parent").agg(F.max("share").alias("share"))
             .groupBy("node").agg(F.min(F.struct(-F.col("share"), F.col("parent"))).getField("parent").alias("up"),
                                  F.count("*").alias("parents")))


def _entities(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("child", "parent")).alias("entity")).filter("entity IS NOT NULL").distinct()


def ownership_closure(edges: DataFrame) -> DataFrame:
    """B13 over any number of levels: per entity its ultimate parent, depth and status.

    edges: (child, parent[, share]), one level each (``direct_parents`` says which parent
    counts). status is ROOT, OWNED, CYCLE (the entity owns itself through others) or
    UNDER_CYCLE; the last two have no ultimate parent nor depth, and ``cycle_id`` is the
    least entity of their cycle. Runs when called, log2(depth) rounds.
    """
    links = write_scratch(direct_parents(edges), "ownership-links")
    up = climb(links.select("node", "up", F.col("node").alias("least")), {"least": F.least})
    ring = up.filter("cyclic")
    # pointers of as many links as there are such nodes end on cycles, and reach all their nodes
    cycles = ring.select(F.col("top").alias("node")).distinct().join(ring.select("node", F.col("least").alias("cycle_id")), "node")
    found = up.join(cycles.select("node", F.lit(True).alias("_on")), "node", "left").join(
        cycles.select(F.col("node").alias("top"), "cycle_id"), "top", "left")
    found = found.select(
        F.col("node").alias("entity"), F.when(~F.col("cyclic"), F.col("top")).alias("ultimate_parent"),
        F.when(~F.col("cyclic"), F.col("hops")).alias("depth"),
        F.when(~F.col("cyclic"), F.lit(OWNED)).when(F.col("_on"), F.lit(CYCLE)).otherwise(F.lit(UNDER_CYCLE)).alias("status"),
        F.when(F.col("cyclic"), F.col("cycle_id")).alias("cycle_id"))
    out = _entities(edges).join(found, "entity", "left").join(links.select(F.col("node").alias("entity"), "parents"), "entity", "left")
    return out.select("entity", F.coalesce("status", F.lit(ROOT)).alias("status"),
                      F.when(F.col("status").isNull(), F.col("entity")).otherwise(F.col("ultimate_parent")).alias("ultimate_parent"),
                      F.when(F.col("status").isNull(), F.lit(0).cast("long")).otherwise(F.col("depth")).alias("depth"),
                      F.coalesce("parents", F.lit(0).cast("long")).alias("parents"), "cycle_id")


def consolidated_exposure(amounts: DataFrame, edges: DataFrame, amount: str = "amount") -> DataFrame:
    """B13 consolidated: per entity its own amount and that of all entities below it.

    amounts: (entity, <amount>), any number of rows an entity; they are summed to a row each
    first. Entities with nobody below hand theirs up and leave, as long as that takes away a
    quarter of those left. Of the others, in round k a node hands the sum of its 2^k nearest levels to the node 2^k links
    above, so every level's sum is exact (decimals add up) after log2(depth) rounds, and no
    row is made for a pair of entity and ancestor. Amounts on or under a cycle stay with
    their own entity, and their ``consolidated`` is NULL, as no order of owners exists.
    Entities without links or without amounts are listed too; rows without an entity are not.
    """
    closure = write_scratch(ownership_closure(edges), "consolidated-closure")
    own = amounts.filter("entity IS NOT NULL").groupBy("entity").agg(F.sum(amount).cast("decimal(38,2)").alias("own"))
    zero = F.lit(0).cast("decimal(38,2)")
    owned = closure.filter(F.col("status") == OWNED).select("entity")
    links = direct_parents(edges).select(F.col("node").alias("entity"), F.col("up").alias("far")).join(owned, "entity")
    now = write_scratch(
        closure.select("entity").unionByName(own.select("entity")).distinct().join(own, "entity", "left").join(links, "entity", "left")
        .select("entity", "far", F.coalesce("own", zero).alias("total")), "consolidated")
    more = F.coalesce("_more", zero)
    # entities with nobody below them hand their sum up and are done; a bushy tree is mostly such, and few take part in the rounds
    done, before = [], None
    while True:
        above = now.select(F.col("far").alias("entity")).filter("entity IS NOT NULL").distinct()
        marked = now.join(above.withColumn("_above", F.lit(True)), "entity", "left")
        handed = (marked.filter("_above IS NULL AND far IS NOT NULL").groupBy(F.col("far").alias("entity"))
                        .agg(F.sum("total").cast("decimal(38,2)").alias("_more")))
        out, n = write_counted(marked.join(handed, "entity", "left").select(
            "entity", "far", (F.col("total") + more).cast("decimal(38,2)").alias("total"), F.col("_above").isNotNull().alias("_above")),
            "consolidated", "_above")
        done.append(out.filter("NOT _above").drop("_above"))
        now = out.filter("_above").drop("_above")
        if n == 0 or before is not None and 4 * n > 3 * before:
            break
        before = n
    left = n
    while left:
        low = now.filter("far IS NOT NULL")
        handed = low.groupBy(F.col("far").alias("entity")).agg(F.sum("total").cast("decimal(38,2)").alias("_more"))
        look = low.select(F.col("entity").alias("far"), F.col("far").alias("_further"))
        # entities that have arrived have no pointer, and would all meet in one task of this join
        onward = (low.join(look, "far", "left").select("entity", F.col("_further").alias("far"), "total")
                     .unionByName(now.filter("far IS NULL")))
        total = (F.col("total") + more).cast("decimal(38,2)")
        now, left = write_counted(onward.join(handed, "entity", "left").select("entity", "far", total.alias("total")), "consolidated", "far IS NOT NULL")
    out = reduce(DataFrame.unionByName, done, now).select("entity", "total").join(own, "entity", "left").join(closure.drop("parents"), "entity", "left")
    status = F.coalesce("status", F.lit(ROOT))
    return out.select("entity", status.alias("status"), F.when(F.col("status").isNull(), F.col("entity"))
                      .otherwise(F.col("ultimate_parent")).alias("ultimate_parent"),
                      F.when(F.col("status").isNull(), F.lit(0).cast("long")).otherwise(F.col("depth")).alias("depth"),
                      F.coalesce("own", zero).alias("own_exposure"),
                      F.when(status.isin(ROOT, OWNED), F.col("total")).alias("consolidated_exposure"))
