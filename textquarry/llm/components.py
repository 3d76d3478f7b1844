"""Connected components by alternating star contractions.

Every round is two joins of the edges with one minimum per node, so a node with very
many neighbours is an aggregate with a map-side step and a join that adaptive
execution may split; nothing is gathered per component or on the driver. Each round is
written to the shared folder. Rounds end as soon as every component is a star, which one
aggregate over the nodes tells. A table of few edges is worked on by few tasks: the driver keeps
a record of every task, so hundreds of empty ones a step cost more than the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.common import materialize

MAX_ROUNDS = 100
# Up to so many edges one task for each ``EDGES_PER_TASK``; beyond that as many as the session shuffles to.
FEW_EDGES, EDGES_PER_TASK = 1_000_000, 50_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of node and neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_least"))
    target = F.least(F.col("a"), F.col("_least"))
    return (
        both.where(F.col("b") > F.col("a"))
        .join(least, "a")
        .select(F.col("b").alias("a"), target.alias("b"))
        .where(F.col("a") != F.col("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node's smaller neighbours, and the node itself, to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("_least"))
    linked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    own = least.select("a", F.col("_least").alias("b"))
    return linked.union(own).where(F.col("a") != F.col("b")).distinct()


def _shape(edges: DataFrame) -> tuple[int, bool]:
    """The number of edges, and whether every component is a star around its smallest node."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("root"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    row = nodes.agg(F.sum("up"), F.count_if((F.col("up") > 1) | (F.col("up") + F.col("root") > 1))).first()
    return row[0] or 0, not row[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the undirected edges ``a, b``.

    ``component`` is the smallest node that can be reached. Loops and repeated edges
    are allowed; rows with a NULL end are ignored; nodes without an edge don't appear.
    """
    links = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    current = materialize(
        links.where(F.col("a") != F.col("b")).select(larger.alias("a"), smaller.alias("b")).distinct(), "edges"
    )

    def fitted(df: DataFrame) -> DataFrame:
        return df.coalesce(1 + count // EDGES_PER_TASK) if count <= FEW_EDGES else df

    for _ in range(MAX_ROUNDS):
        count, settled = _shape(current)
        if settled:
            break
        larger_linked = materialize(fitted(_large_star(fitted(current))), "large-star")
        current = materialize(fitted(_small_star(fitted(larger_linked))), "small-star")
    else:
        raise RuntimeError(f"components have not settled after {MAX_ROUNDS} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
