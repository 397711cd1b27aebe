"""Connected components of links between integer ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteflow.llm.scratch import Scratch


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``component``) for every id in ``links`` (``a``, ``b``); the component is its smallest id.

    Each round lets every node point to the smallest of itself and its neighbours, follows the
    pointers to their ends, and merges all nodes with the same end, until no link is left. A round at
    least halves the nodes that still have links. Nothing is gathered per node but a minimum, so a
    node with very many links is no burden, and each step is written to the shared folder.
    """
    scratch = Scratch(links.sparkSession)
    links = scratch.table(links.select("a", "b").where("a <> b").distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    found = scratch.table(nodes.select("node", F.col("node").alias("component")), "components")
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        pointers = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
        pointers = scratch.table(pointers.select("node", F.least("node", "to").alias("to")), "pointers")
        moving = True
        while moving:
            onward = pointers.select(F.col("node").alias("to"), F.col("to").alias("next"))
            followed = pointers.join(onward, "to").select(
                "node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")
            )
            followed = scratch.table(followed, "pointers")
            scratch.release(pointers)
            pointers, moving = followed, not followed.where("moved").isEmpty()
        ends = pointers.select(F.col("node").alias("component"), "to")
        merged = found.join(ends, "component", "left")
        merged = scratch.table(merged.select("node", F.coalesce("to", "component").alias("component")), "components")
        at_a = pointers.select(F.col("node").alias("a"), F.col("to").alias("x"))
        at_b = pointers.select(F.col("node").alias("b"), F.col("to").alias("y"))
        left = links.join(at_a, "a").join(at_b, "b").where("x <> y")
        left = scratch.table(left.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "links")
        scratch.release(found, links, pointers)
        found, links = merged, left
    scratch.release(links)
    return found
