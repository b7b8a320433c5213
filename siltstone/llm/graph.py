"""Connected groups of an undirected graph given as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import save


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``: root is the least node it is connected to.

    Each round a node takes the least root among its neighbours, and then the
    root of that root, so chains shorten by half. Stops when nothing changes.
    One row per node is kept; a hub's edges are summed before they are moved.
    """
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = save(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    roots = both.groupBy("x").agg(F.min("y").alias("y")).select(
        F.col("x").alias("node"), F.least("x", "y").alias("root"))
    while True:
        roots = save(roots, "roots")
        near = both.join(roots, both["y"] == roots["node"]).groupBy("x").agg(F.min("root").alias("near"))
        step = save(
            roots.join(near, roots["node"] == near["x"])
            .select("node", F.col("root").alias("old"), F.least("root", "near").alias("root")), "steps")
        up = step.select(F.col("node").alias("up"), F.col("root").alias("top"))
        jumped = step.join(up, step["root"] == up["up"], "left").select(
            "node", "old", F.least("root", F.coalesce("top", "root")).alias("root"))
        jumped = save(jumped, "jumps")
        if jumped.filter("root <> old").isEmpty():
            return jumped.select("node", "root")
        roots = jumped.select("node", "root")
