"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payments_lake.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node it is linked with.

    Large-star and small-star steps alternate until nothing changes: each joins nodes to the
    smallest neighbour that is known so far, which takes about log(n) rounds and never more rows
    than there are links. Minima are taken before the shuffle, so hubs cost one row per task.
    """
    ordered = links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges, mark = written(ordered.distinct(), "links"), None
    while True:
        edges = written(_small_star(_large_star(edges)), "stars")
        # No larger node points to two smaller ones, and none to one that points on: all stars.
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(new) == mark:
            break
        mark = tuple(new)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Joins each node's larger neighbours to its smallest neighbour (or itself)."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    larger = both.filter("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Joins each node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return moved.unionAll(own).filter("a <> b").distinct()
