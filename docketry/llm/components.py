"""Connected components over edge tables, without the driver seeing them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.session import write_shared


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; root is the least node reached.

    Each round hooks every node onto its least smaller neighbour, jumps until all
    hang on the roots of their trees, and leaves the links between different roots
    for the next round.  A tree that hooks nowhere is least among its neighbours;
    of these only such as a neighbour chose outlast the next round, so two rounds
    at least halve the trees: rounds are logarithmic in the nodes, jumps in the
    depth of a tree, and it ends when no link is left.  Minima are pre-aggregated
    before every shuffle, and each step's table is written to the shared folder.
    """
    links = write_shared(_apart(edges.select("a", "b")), "cc-links")
    labels = None  # nodes that hang on another
    while not links.isEmpty():
        trees = write_shared(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), "cc-trees")
        while True:
            above = trees.select(F.col("node").alias("root"), F.col("root").alias("far"))
            stepped = write_shared(
                trees.join(above, "root", "left").select(
                    "node", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")
                ),
                "cc-trees",
            )
            trees = stepped.select("node", "root")
            if stepped.where("moved").isEmpty():
                break
        low = trees.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        high = trees.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        met = links.join(high, "b").join(low, "a", "left").select(F.coalesce("ra", "a").alias("a"), F.col("rb").alias("b"))
        links = write_shared(_apart(met), "cc-links")
        if labels is None:
            labels = trees
        else:
            above = trees.select(F.col("node").alias("root"), F.col("root").alias("far"))
            moved = labels.join(above, "root", "left").select("node", F.coalesce("far", "root").alias("root"))
            labels = write_shared(moved.unionByName(trees), "cc-labels")
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    if labels is None:
        return nodes.select("node", F.col("node").alias("root"))
    return write_shared(nodes.join(labels, "node", "left").select("node", F.coalesce("root", "node").alias("root")), "cc-labels")


def _apart(pairs: DataFrame) -> DataFrame:
    """The distinct links of two different nodes, smaller node first."""
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
