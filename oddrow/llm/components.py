"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrow.sources.storage import Scratch


def connected(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); the root is the smallest node reached.

    Every round hooks each node to its smallest neighbour, follows the hooks to their ends and
    contracts the graph; only nodes without a smaller neighbour are left, so rounds are few.
    Every round's tables are written, and a node with many edges is reduced before the shuffle.
    """
    left = scratch.keep(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter("a <> b")
        .distinct(),
        f"{name}-edges",
    )
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    labels = nodes.select("node", F.col("node").alias("root"))
    for number in range(1_000):
        if left.isEmpty():
            return labels
        hooks = scratch.keep(
            left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")),
            f"{name}-hooks-{number}",
        )
        ends = _follow(hooks, scratch, f"{name}-ends-{number}")
        labels = scratch.keep(
            labels.join(ends.withColumnRenamed("node", "root"), "root", "left").select(
                "node", F.coalesce("up", "root").alias("root")
            ),
            f"{name}-labels-{number}",
        )
        left = scratch.keep(_contracted(left, ends), f"{name}-left-{number}")
    raise RuntimeError("components did not settle")


def _follow(hooks: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Every hooked node with the end of its chain of hooks, found by doubling steps."""
    step = 0
    while True:
        above = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
        jumped = hooks.join(above, "up", "left").select(
            "node", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")
        )
        kept = scratch.keep(jumped, f"{name}-{step}")
        if kept.filter("moved").isEmpty():
            return kept.select("node", "up")
        hooks, step = kept.select("node", "up"), step + 1


def _contracted(edges: DataFrame, ends: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        to = ends.withColumnRenamed("node", side)
        edges = (
            edges.join(to, side, "left")
            .withColumn(side, F.coalesce("up", side))
            .drop("up")
        )
    return (
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter("a <> b")
        .distinct()
    )
