"""Connected components of an edge table, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.staging import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on the smallest of them.

    The large star moves neighbours above the node, the small star those below
    it and the node itself.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # written, so that the join has a shuffle on both sides and can split the rows of
    # a node with very many neighbours
    lowest = stage(both.groupBy("u").agg(F.min("v").alias("m")), "lowest")
    lowest = lowest.select("u", F.least("u", "m").alias("m"))
    joined = both.join(lowest, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            lowest.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return moved.where("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node on an edge between different nodes.

    The component is its smallest node.  Rounds alternate large and small stars
    until every node hangs directly on its component; each round is written to
    the shared folder, so no lineage grows.  No edges give an empty result.
    """
    current = stage(
        edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "edges"
    )
    while not _all_stars(current):
        current = stage(_star(_star(current, large=True), large=False), "edges")
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node ``a`` hangs on one smaller ``b`` that hangs on nothing."""
    down = edges.agg(F.count(F.lit(1)), F.count_distinct("a"), F.count_if(F.col("a") < F.col("b")))
    n, n_hanging, n_wrong = down.first()
    if n != n_hanging or n_wrong:
        return False
    middle = edges.select(F.col("b").alias("a")).distinct()
    return edges.join(middle, "a", "left_semi").limit(1).count() == 0
