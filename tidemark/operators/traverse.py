"""Bounded traversal of link graphs, and probing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .numbering import cut, numbered


def bfs(edges: DataFrame, seeds: DataFrame, max_depth: int, max_nodes: int | None = None, out_cap: int | None = None) -> DataFrame:
    """edges (src, dst), seeds (node): (node, depth, via).  ``via`` is the smallest neighbour that discovers a node first.

    Each level is a join, an aggregate and an anti-join with what has been seen; levels are written, so lineage stays short."""
    if out_cap is not None:
        first = Window.partitionBy("src").orderBy("dst")
        edges = edges.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= out_cap).drop("_n")
    kind = edges.schema["src"].dataType
    seen = cut(seeds.select(F.col("node").cast(kind)).distinct().withColumns({"depth": F.lit(0), "via": F.lit(None).cast(kind)}))
    frontier = seen
    for depth in range(1, max_depth + 1):
        new = frontier.select(F.col("node").alias("src")).join(edges, "src").groupBy(F.col("dst").alias("node")).agg(F.min("src").alias("via"))
        new = new.join(seen.select("node"), "node", "left_anti").select("node", F.lit(depth).alias("depth"), "via")
        if max_nodes is not None:
            room = max_nodes - seen.count()
            new = new.orderBy("node").limit(max(0, room))
        frontier = cut(new)
        if frontier.isEmpty():
            break
        seen = cut(seen.union(frontier))
    return seen


def discovered(edges: DataFrame, seeds: DataFrame, max_depth: int, max_nodes: int | None = None, out_cap: int | None = None, scope: DataFrame | None = None) -> DataFrame:
    """edges (src, dst, pos), seeds (node, pos): (node, depth, ordinal, via) in the order in which a queue discovers nodes.

    A queue takes a node's links by ``pos`` and nodes as they were found, so a node's place is that of the smallest (place of the page,
    pos of the link) that leads to it.  Each level is a join, an aggregate, an anti-join with what is known and a numbering by ranges.
    ``out_cap`` follows the first links of a node only, ``max_nodes`` ends with so many nodes, ``scope`` (node) bounds what is entered.
    Of links with one pos the smaller target is first; levels are written, and a job runs for each when called."""
    if out_cap is not None:
        first = Window.partitionBy("src").orderBy("pos", "dst")
        edges = edges.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= out_cap).drop("_n")
    if scope is not None:
        edges = edges.join(scope.select(F.col("node").alias("dst")).distinct(), "dst", "left_semi")
    kind, place = edges.schema["src"].dataType, edges.schema["pos"].dataType
    new = seeds.groupBy(F.col("node").cast(kind).alias("node")).agg(F.min(F.col("pos").cast(place)).alias("pos")).withColumns({"above": F.lit(0).cast("long"), "via": F.lit(None).cast(kind)})
    known, total = None, 0
    for depth in range(max_depth + 1):
        level, n = numbered(new, ["above", "pos", "node"], "ordinal", total)
        if max_nodes is not None:
            level = level.where(F.col("ordinal") < max_nodes)
        level = level.select("node", F.lit(depth).alias("depth"), "ordinal", "via")
        known, total = level if known is None else cut(known.union(level)), total + n
        if not n or max_nodes is not None and total >= max_nodes:
            break
        step = level.select(F.col("node").alias("src"), F.col("ordinal").alias("above")).join(edges, "src")
        best = step.groupBy(F.col("dst").alias("node")).agg(F.min(F.struct("above", "pos", F.col("src").alias("via"))).alias("b"))
        new = best.join(known.select("node"), "node", "left_anti").select("node", "b.pos", "b.above", "b.via")
    return known


def until_misses(probes: DataFrame, keys: list[str], order: str, hit: str, misses: int) -> DataFrame:
    """Probes up to the first run of so many misses in a row: gaps and islands, without a loop."""
    along = Window.partitionBy(*keys).orderBy(order)
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    p = probes.withColumn("_island", F.sum(F.col(hit).cast("int")).over(upto))
    run = Window.partitionBy(*keys, "_island").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    p = p.withColumn("_run", F.sum((~F.col(hit)).cast("int")).over(run))
    p = p.withColumn("_over", F.coalesce(F.max((F.col("_run") >= misses).cast("int")).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return p.where("_over = 0").drop("_island", "_run", "_over")
