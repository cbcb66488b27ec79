"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long); a component's nodes share one root.

    Each round points every node at its least neighbour, follows the pointer once more, and contracts the
    graph to what the pointers reach; with names that are hashes it shrinks by a constant factor.
    Edges, pointers and roots are tables in the shared folder; only row counts reach the driver.
    """
    edges = scratch.write(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    roots: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        pointer = least.select("node", F.least("node", "least").alias("to"))
        then = pointer.select(F.col("node").alias("to"), F.col("to").alias("next"))
        pointer = scratch.write(pointer.join(then, "to").select("node", F.col("next").alias("to")), "pointers")
        if roots is None:
            new_roots = scratch.write(pointer.select("node", F.col("to").alias("root")), "roots")
        else:
            onward = pointer.select(F.col("node").alias("root"), "to")
            followed = roots.join(onward, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
            new_roots = scratch.write(followed, "roots")
            scratch.release(roots)
        roots = new_roots
        from_a = pointer.select(F.col("node").alias("a"), F.col("to").alias("new_a"))
        from_b = pointer.select(F.col("node").alias("b"), F.col("to").alias("new_b"))
        moved = edges.join(from_a, "a").join(from_b, "b").select(F.col("new_a").alias("a"), F.col("new_b").alias("b"))
        contracted = scratch.write(moved.filter("a <> b").distinct(), "edges")
        scratch.release(edges, pointer)
        edges = contracted
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    scratch.release(edges)
    return roots
