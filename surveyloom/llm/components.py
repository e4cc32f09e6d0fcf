"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.store import Scratch


def connected(links: DataFrame, scratch: Scratch, name: str = "parts") -> DataFrame:
    """``(node, part)`` of every node of ``links(a, b)``; a part is named by its smallest node.

    Each round joins every node to its smallest neighbour, shortens the resulting paths
    once, and puts the ends of the links in place of the nodes; links within a part go away.
    Smallest neighbours come from a partial aggregate, and the joins read tables on both
    sides, so a node with a large share of all links is split over tasks. No links: no rows.
    """
    left = scratch.keep(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(),
        f"{name}-links-0",
    )
    steps = []
    while not left.isEmpty():
        k = len(steps)
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        up = scratch.keep(least.select("node", F.least("node", "low").alias("up")), f"{name}-up-{k}")
        top = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
        step = scratch.keep(up.join(top, "up").select("node", F.col("top").alias("up")), f"{name}-step-{k}")
        a = step.select(F.col("node").alias("a"), F.col("up").alias("x"))
        b = step.select(F.col("node").alias("b"), F.col("up").alias("y"))
        moved = scratch.keep(left.join(a, "a").where("x <> b").select("x", "b"), f"{name}-moved-{k}")
        rest = moved.join(b, "b").where("x <> y")
        rest = rest.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        after = scratch.keep(rest, f"{name}-links-{k + 1}")
        scratch.drop(f"{name}-up-{k}", f"{name}-moved-{k}", f"{name}-links-{k}")
        steps.append(step)
        left = after
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("part"))
    # the last step's nodes are the roots of those before; go down the rounds
    parts = steps[-1].select("node", F.col("up").alias("part"))
    for k in range(len(steps) - 2, -1, -1):
        known = scratch.keep(parts, f"{name}-parts-{k}").withColumnRenamed("node", "up")
        parts = steps[k].join(known, "up", "left").select("node", F.coalesce("part", "up").alias("part"))
    return scratch.keep(parts, name)
