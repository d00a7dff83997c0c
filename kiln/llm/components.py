"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kiln.session import materialize


def _least(edges: DataFrame) -> DataFrame:
    """Each ``u`` with its smallest neighbour or itself, joined to its edges;
    the minimum is partly taken before the shuffle, so that a node with very
    many neighbours is no more than a split join."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return edges.join(least.select("u", F.least("u", "least").alias("least")), "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``u, v`` long): its
    component's smallest node.  Alternates large-star and small-star rounds,
    each written to the shared folder, until the edges no longer change; a
    round holds no more edges than the one before.  An edgeless table gives
    no rows."""
    edges = materialize(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    last = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        last = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = _least(large.distinct())
        small = small.filter("v != least").select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            small.select("u", F.col("least").alias("v")))
        edges = materialize(small.distinct(), "edges")
