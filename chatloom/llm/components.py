"""Connected components over a table of links, by alternating star contraction.

Large-star joins every node's larger neighbours to the smallest node around it,
small-star does so for the smaller ones; both only ever take a minimum per node,
by partial aggregation, so a hub's links are spread over tasks and no
neighbourhood is gathered.  Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.shared import cut

ROUNDS = 60


def _star(pairs: DataFrame) -> DataFrame:
    """``pairs`` (u, v): every v joined to the least of u's neighbours and u itself."""
    least = cut(pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m")), "star-least")
    joined = pairs.join(least, pairs["u"] == least["w"])
    return joined.select("u", "v", "m")


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of the links (``a``, ``b``); root is the least node reachable."""
    edges = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(ROUNDS):
        both = cut(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))), "star-both")
        large = cut(_star(both).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "star-large")
        small = _star(large.select(F.col("a").alias("u"), F.col("b").alias("v")))
        # Every smaller neighbour, and the node itself, goes to the least one.
        moved = small.select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        after = cut(moved.filter("a <> b").distinct(), "star-small")
        same = after.count() == edges.count() and not after.join(edges, ["a", "b"], "left_anti").take(1)
        edges = after
        if same:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b"), F.col("b")).distinct())
    raise RuntimeError(f"no fixed point after {ROUNDS} rounds")
