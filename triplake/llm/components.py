"""Connected components of a graph too large for one machine.

Large-star and small-star steps alternate until nothing changes; each step is a join
and an aggregation that pre-sums, and the join deals frequent nodes out by broadcast, so
a node with very many neighbours is no single task's work. Every step is stored, so a
lost executor costs one step's tasks. Labels only fall, so the rounds end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.llm.common import join_counted, stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(neighbours: DataFrame, larger: bool) -> DataFrame:
    """Every neighbour v of u tied to the least of u and its neighbours; with ``larger``,
    only neighbours larger than u move, and u stays as it is."""
    least = neighbours.groupBy("u").agg(F.min("v").alias("least"), F.count(F.lit(1)).alias("n"))
    least = stored(least.select("u", F.least("u", "least").alias("least"), "n"), "least")
    tied = join_counted(neighbours.filter("v > u") if larger else neighbours, least, "u")
    rows = tied.select(F.col("v").alias("u"), F.col("least").alias("v"))
    if not larger:
        rows = rows.union(least.select("u", F.col("least").alias("v")))
    return rows.filter(F.col("u") != F.col("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    return _star(_both_ways(edges), larger=True)


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return _star(down.distinct(), larger=False)


def _mark(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that ``edges`` (u, v) touch with another; the root
    is the least node of its component. NULLs and loops are left out."""
    kept = edges.select("u", "v").filter(F.col("u") != F.col("v"))
    edges = stored(kept.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(edges)
    before = None
    while mark != before:
        edges = stored(_large_star(edges), "edges")
        edges = stored(_small_star(edges), "edges")
        before, mark = mark, _mark(edges)
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return nodes.union(roots)
