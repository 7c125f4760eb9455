"""Connected components of a link table: every node hooks to its smallest neighbour, jumps twice, and the edges shrink to those between different ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, tag: str, roots: DataFrame | None = None) -> DataFrame:
    """node, root (the smallest node of its component) for every node of ``links`` (columns a, b); written to ``scratch``.

    ``roots`` has the components of earlier links: their nodes are in the result too, only their roots meet the new links, and where these join nothing, it is the result.
    """
    if roots is not None:
        links = links.join(roots.toDF("a", "ra"), "a", "left").join(roots.toDF("b", "rb"), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    edges = scratch.save(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{tag}-edges-0")
    found, own, step = None, "", 0
    while edges.limit(1).count():
        ends = edges.select(F.col("b").alias("node"), F.col("a").alias("up")).union(edges.select(F.col("a").alias("node"), F.col("a").alias("up")))
        near = scratch.save(ends.groupBy("node").agg(F.min("up").alias("up")), f"{tag}-near-{step}")
        over = near.select(F.col("node").alias("up"), F.col("up").alias("over"))
        up = near.join(over, "up").select("node", F.col("over").alias("up"))
        up = scratch.save(up.join(over, "up").select("node", F.col("over").alias("up")), f"{tag}-up-{step}")
        # any map into the own component keeps what hangs together; these edges are all that is left to do
        left, right = up.select(F.col("node").alias("a"), F.col("up").alias("ua")), up.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        again = edges.join(left, "a").join(right, "b").where("ua <> ub").select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct()
        again = scratch.save(again, f"{tag}-edges-{step + 1}")
        scratch.drop(f"{tag}-edges-{step}", f"{tag}-near-{step}")
        if found is None:
            found, own = up.select("node", F.col("up").alias("root")), f"{tag}-up-{step}"
        else:
            found = scratch.save(lifted(found, up.toDF("root", "new")), f"{tag}-roots-{step}")
            scratch.drop(own, f"{tag}-up-{step}")
            own = f"{tag}-roots-{step}"
        edges, step = again, step + 1
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if found is None else found
    if found is None:
        return roots
    new = found.join(roots.select("node"), "node", "left_anti").select("node", "root")
    return scratch.save(lifted(roots, found.toDF("root", "new")).union(new), f"{tag}-roots")


def lifted(roots: DataFrame, up: DataFrame) -> DataFrame:
    """node, root, with the roots that ``up`` (root, new) names replaced."""
    return roots.join(up, "root", "left").select("node", F.coalesce("new", "root").alias("root"))
