"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def _roots(pointers: DataFrame) -> DataFrame:
    """Where following the pointers ``node`` to ``root`` ends; each round doubles the reach."""
    while True:
        further = pointers.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = cut(
            pointers.join(further, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "pointers",
        )
        pointers = jumped.select("node", "root")
        if jumped.where("moved").isEmpty():
            return pointers


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a``, ``b``: the smallest node reachable.

    Each node points to its smallest neighbour if that is smaller than itself; the
    pointers are followed to their ends, and links between ends are all that is left.
    Only nodes smaller than all their neighbours remain, at most half of those with
    links, so the rounds are bounded by the logarithm of the nodes, and so are the
    jumps of a round. No list of neighbours is ever gathered.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    nodes = cut(links.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    found = nodes.withColumn("component", F.col("node"))
    left = cut(links.distinct(), "links")
    while not left.isEmpty():
        roots = _roots(cut(left.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), "pointers"))
        moved = roots.select(F.col("node").alias("component"), "root")
        found = cut(
            found.join(moved, "component", "left").select("node", F.coalesce("root", "component").alias("component")),
            "components",
        )
        for end in ("a", "b"):
            to = roots.select(F.col("node").alias(end), "root")
            kept = [c for c in ("a", "b") if c != end]
            left = left.join(to, end, "left").select(F.coalesce("root", end).alias(end), *kept)
        left = left.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        left = cut(left.distinct(), "links")
    return found
