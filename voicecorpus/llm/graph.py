"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point each node's neighbours (larger ones, or the others) to its smallest neighbour."""
    if large:
        arcs = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        arcs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = arcs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    moved = arcs.join(least, "a")
    if large:
        out = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes that stand in ``edges`` (a, b): component is the
    smallest node reachable.  Self-links and repeated links are allowed; null ends are
    dropped; no edges give an empty table.  Each step is cut in the shared folder, so a
    lost executor repeats one step at most.  Done is when a step changes no link: as many
    as before, and none that was not there; only these two facts come to the driver."""
    edges = cut(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct()
    )
    n = edges.count()
    while n:
        was, n_was = edges, n
        edges = cut(_star(_star(edges, True), False))
        n = edges.count()
        if n == n_was and edges.join(was, ["a", "b"], "left_anti").isEmpty():
            break
    inner = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return inner.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
