"""G. Queries over governance tables: column tags, consumer registry, lineage, access log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.joins import full_join
from ..session import write_counted, write_scratch
from .hierarchy import climb

TAG_COLUMNS = ("table_catalog", "table_schema", "table_name", "column_name")

# Order of sensitivity labels, least to most restrictive.
SENSITIVITY_ORDER = ("PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED")


def _alias_entries(tags: DataFrame, tag_name: str = "source_aliases") -> DataFrame:
    e = (tags.filter(F.col("tag_name") == tag_name)
             .select(*TAG_COLUMNS, F.explode(F.split("tag_value", ",")).alias("_entry"))
             .withColumn("_entry", F.trim("_entry")))
    parts = F.split("_entry", ":", 2)
    return e.select(*TAG_COLUMNS, "_entry", F.element_at(parts, 1).alias("app"),
                    F.element_at(parts, 2).alias("source_column"))


def find_canonical_column(tags: DataFrame, app: str, original_name: str) -> DataFrame:
    """G1: canonical column(s) whose alias tag lists ``app:original_name``.

    Exact match on the exploded entry: unlike a LIKE over the whole tag, a longer
    column name with the same prefix is not a hit.
    """
    return (_alias_entries(tags).filter(F.col("_entry") == f"{app}:{original_name}")
                                .select(*TAG_COLUMNS))


def find_aliases(tags: DataFrame, canonical_name: str | None = None) -> DataFrame:
    """All (app, source column) pairs of a canonical column (or of every column)."""
    e = _alias_entries(tags)
    if canonical_name is not None:
        e = e.filter(F.col("column_name") == canonical_name)
    return e.select(*TAG_COLUMNS, "app", "source_column")


def _window_start(as_of: str, days: int):
    return F.date_sub(F.lit(as_of).cast("date"), days)


def active_consumers(registry: DataFrame, as_of: str, days: int = 365,
                     product: str | None = None) -> DataFrame:
    """Consumers validated within ``days`` before ``as_of``, and not after it; NULL dates drop out."""
    r = registry if product is None else registry.filter(F.col("producer_product") == product)
    v = F.col("last_validated_date")
    return r.filter((v >= _window_start(as_of, days)) & (v <= F.lit(as_of).cast("date")))


def stale_consumers(registry: DataFrame, as_of: str, days: int = 365) -> DataFrame:
    """The rest: validated before the window, after ``as_of``, or never; business-critical first."""
    v = F.col("last_validated_date")
    active = (v >= _window_start(as_of, days)) & (v <= F.lit(as_of).cast("date"))
    return (registry.filter(~F.coalesce(active, F.lit(False)))
                    .orderBy(F.col("business_critical").desc(), v.asc_nulls_first(), "consumer_id"))


def _rank(label_col):
    """Place of a label in the order; a label that is not in it ranks most restrictive."""
    expr = F.lit(len(SENSITIVITY_ORDER) - 1)
    for i, name in enumerate(SENSITIVITY_ORDER):
        expr = F.when(F.upper(label_col) == name, F.lit(i)).otherwise(expr)
    return F.when(label_col.isNotNull(), expr)


def _label(rank_col):
    return F.when(rank_col >= 0, F.element_at(F.array(*[F.lit(s) for s in SENSITIVITY_ORDER]), F.greatest(rank_col, F.lit(0)) + 1))


def inherit_classification(lineage: DataFrame, labels: DataFrame, compact_every: int = 8) -> DataFrame:
    """Effective sensitivity of every product = most restrictive of its own label and
    of everything upstream; PII if anything upstream has it. A product with no label on
    or above it has sensitivity NULL; an unknown label counts as the most restrictive.

    Runs when called, to the fixpoint, whatever the depth (cycles end too), in two parts:

    - Products of one parent are climbed by path doubling (``hierarchy.climb``): a chain
      of any length folds its labels in log2(length) rounds and then stands for its top.
    - What is left are products of several parents and tops. Their labels spread along the
      shortened edges: each round joins only the products that changed in the last one
      (the frontier) to their children, and keeps the children that this raises. Rounds
      here are the depth counted in products of several parents.

    A round writes its frontier alone, and the rounds' tables are merged every
    ``compact_every`` rounds. The driver sees one count a round. A parent of very many
    children is split by adaptive execution, as both join sides are read from written tables.
    """
    edges = write_scratch(lineage.select("child", "parent").filter("child IS NOT NULL AND parent IS NOT NULL AND child != parent")
                          .distinct(), "lineage-edges")
    best = [F.max("rank").alias("rank"), F.max("pii").alias("pii")]
    own = write_scratch(
        labels.select("product_id", F.coalesce(_rank(F.col("sensitivity")), F.lit(-1)).alias("rank"),
                      F.coalesce(F.col("pii").cast("boolean").cast("int"), F.lit(0)).alias("pii"))
        .filter("product_id IS NOT NULL").groupBy("product_id").agg(*best), "lineage-own")

    def merged(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.groupBy("product_id").agg(*best)

    # chains: (node, top, rank, pii), folded over the node and all below the top
    single = edges.groupBy(F.col("child").alias("node")).agg(F.min("parent").alias("up"), F.count("*").alias("n")).filter("n = 1").drop("n")
    zero = {"rank": F.lit(-1), "pii": F.lit(0)}
    single = single.join(own.withColumnRenamed("product_id", "node"), "node", "left").select(
        "node", "up", *[F.coalesce(c, v).alias(c) for c, v in zero.items()])
    chains = climb(single, {"rank": F.greatest, "pii": F.greatest}).select("node", "top", "rank", "pii")

    # the graph without them: an edge from what stands above a product of several parents
    short = (edges.join(chains.select(F.col("node").alias("child")), "child", "left_anti")
                  .join(chains.withColumnRenamed("node", "parent"), "parent", "left"))
    short = write_scratch(short.select("child", F.coalesce("top", "parent").alias("parent"), "rank", "pii"), "lineage-short")
    start = own.unionByName(short.filter("rank IS NOT NULL").select(F.col("child").alias("product_id"), "rank", "pii"))
    parts = [write_scratch(start.groupBy("product_id").agg(*best), "lineage-start")]
    links = short.select("child", "parent").filter("child != parent").distinct()
    frontier = parts[0].filter("rank >= 0 OR pii = 1")
    while True:
        up = (links.join(frontier.withColumnRenamed("product_id", "parent"), "parent")
                   .groupBy(F.col("child").alias("product_id")).agg(*best))
        now = merged(parts).withColumnsRenamed({"rank": "_rank", "pii": "_pii"})
        frontier, n = write_counted(
            up.join(now, "product_id", "left")
              .filter((F.col("rank") > F.coalesce("_rank", F.lit(-1))) | (F.col("pii") > F.coalesce("_pii", F.lit(0))))
              .select("product_id", F.greatest("rank", F.coalesce("_rank", F.lit(-1))).alias("rank"),
                      F.greatest("pii", F.coalesce("_pii", F.lit(0))).alias("pii")), "lineage-frontier")
        if not n:
            break
        parts.append(frontier)
        if len(parts) > compact_every:
            parts = [write_scratch(merged(parts), "lineage-merged")]
    held = merged(parts)
    # a chain's products: their own part of the chain, and what its top has
    tops = held.select(F.col("product_id").alias("top"), F.col("rank").alias("_rank"), F.col("pii").alias("_pii"))
    climbed = chains.join(tops, "top", "left").select(
        F.col("node").alias("product_id"), F.greatest("rank", "_rank").alias("rank"), F.greatest("pii", "_pii").alias("pii"))
    nodes = (edges.select(F.explode(F.array("child", "parent")).alias("product_id"), F.lit(-1).alias("rank"), F.lit(0).alias("pii"))
             .unionByName(held).unionByName(climbed).groupBy("product_id").agg(*best))
    return nodes.select("product_id", _label(F.col("rank")).alias("sensitivity"), (F.col("pii") == 1).alias("pii"))


def column_closure(edges: DataFrame, starts: DataFrame, keeps: tuple[str, ...] = ("identity", "rename")) -> DataFrame:
    """G5 by column: every column fed, at any distance, by a column of ``starts``.

    edges: (product_id, column_name, upstream_product, upstream_column, transform), a
    contract's upstream list by column; starts: (product_id, column_name), such as those
    tagged as personal. Returns (start_product, start_column, product_id, column_name, hops,
    value_kept): hops is the least number of edges, value_kept whether some path has only
    transforms of ``keeps``, so that the start's very values arrive (a hash or a sum on every
    path keeps them back). A start is listed for itself with 0 hops.

    Semi-naive: a round joins the edges with the pairs that the last round found or
    improved alone, until there are none; rounds are the longest least path. Cycles end, as
    a pair can improve only once. A column that feeds very many is split by adaptive
    execution. The result has a row for each pair, so give the starts that matter.
    """
    end = ["upstream_product", "upstream_column"]
    e = edges.select("product_id", "column_name", *end, F.coalesce(F.col("transform").isin(*keeps), F.lit(False)).alias("keep"))
    e = e.dropna(subset=["product_id", "column_name", *end]).groupBy("product_id", "column_name", *end).agg(F.max("keep").alias("keep"))
    e = write_scratch(e, "column-edges")
    pair = ["start_product", "start_column", "product_id", "column_name"]
    first = starts.select("product_id", "column_name").dropna().distinct()
    frontier = write_scratch(first.select(F.col("product_id").alias("start_product"), F.col("column_name").alias("start_column"), "product_id",
                                          "column_name", F.lit(True).alias("value_kept")), "column-frontier")
    known, hops = frontier.withColumn("hops", F.lit(0)), 0
    n = 1
    while n:
        hops += 1
        source = frontier.select("start_product", "start_column", F.col("product_id").alias(end[0]), F.col("column_name").alias(end[1]), "value_kept")
        reached = source.join(e, end).groupBy(*pair).agg(F.max(F.col("value_kept") & F.col("keep")).alias("value_kept"))
        old = known.withColumnsRenamed({"value_kept": "_kept", "hops": "_hops"})
        better = reached.join(old, pair, "left").filter(F.col("_kept").isNull() | (F.col("value_kept") & ~F.col("_kept")))
        found, n = write_counted(better.select(*pair, "value_kept", F.coalesce("_hops", F.lit(hops)).alias("hops")), "column-frontier")
        frontier = found.drop("hops")
        known = write_scratch(known.unionByName(found).groupBy(*pair).agg(F.max("value_kept").alias("value_kept"), F.min("hops").alias("hops")),
                              "column-known") if hops % 4 == 0 else known.unionByName(found).groupBy(*pair).agg(
            F.max("value_kept").alias("value_kept"), F.min("hops").alias("hops"))
    return known.select(*pair, "hops", "value_kept")


def lineage_diff(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """Per product, upstream tables declared but never read and read but not declared; a
    NULL product or upstream equals itself."""
    d = declared.select("product_id", "upstream").distinct().withColumn("_d", F.lit(True))
    o = observed.select("product_id", "upstream").distinct().withColumn("_o", F.lit(True))
    j = full_join(d, o, ["product_id", "upstream"])
    return (j.filter(F.col("_d").isNull() | F.col("_o").isNull())
             .select("product_id", "upstream",
                     F.when(F.col("_o").isNull(), F.lit("DECLARED_NOT_READ"))
                      .otherwise(F.lit("READ_NOT_DECLARED")).alias("status")))


def consumer_coverage(sources: dict[str, DataFrame], registry_source: str = "registry",
                      log_source: str = "query_log",
                      keys: tuple[str, ...] = ("product_id", "consumer_id")) -> DataFrame:
    """Per product and consumer, which tracking sources know it, and whether it is
    seen in the query log without being registered. One union, one group-by (partial
    aggregation absorbs a hot consumer or product)."""
    names = list(sources)
    parts = [df.select(*keys)
               .select(*keys, *[F.lit(1 if n == name else 0).alias(f"in_{n}") for n in names])
             for name, df in sources.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    g = u.groupBy(*keys).agg(*[(F.max(f"in_{n}") == 1).alias(f"in_{n}") for n in names])
    count = sum(F.col(f"in_{n}").cast("int") for n in names)
    return (g.withColumn("sources", count)
             .withColumn("unregistered", F.col(f"in_{log_source}") & ~F.col(f"in_{registry_source}")))


def direct_access(query_log: DataFrame, allowed_catalog: str = "warehouse") -> DataFrame:
    """Who reads app-zone catalogs instead of the warehouse: reads and last read."""
    return (query_log.filter(F.col("table_catalog") != allowed_catalog)
                     .groupBy("consumer_id", "table_catalog", "table_name")
                     .agg(F.count("*").alias("reads"), F.max("read_time").alias("last_read")))
