"""Connected components by contraction, for edges that lead from a node to a smaller one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenweave.session import materialize, materialize_counting


def components(edges: DataFrame, run: str) -> DataFrame:
    """node, label (smallest node of its component) for all nodes of ``edges(a, b)``, where b < a.

    Each round hangs every node on its smallest neighbour below it, doubles these pointers until all lead to a root, and
    puts roots in the place of both ends of the other edges; what is left leads from a root to a smaller one. So no node
    is hung twice. A root with an edge left was given nodes or is hung in the next round, so two rounds halve the nodes.
    Every round is written.
    """
    hung, left = [], materialize(edges.select("a", "b").distinct(), f"{run}/edges-0")
    step = 0
    while not left.isEmpty():
        step += 1
        links = materialize(left.groupBy("a").agg(F.min("b").alias("b")), f"{run}/links-{step}")
        roots = _to_roots(links, f"{run}/roots-{step}")
        hung.append(roots)
        # a hangs on top, so an edge (a, b) connects what (b, top) does
        others = left.join(links.select("a", F.col("b").alias("top")), "a").where("b <> top").select("b", "top").distinct()
        for end in ("b", "top"):
            root = roots.select(F.col("a").alias(end), F.col("b").alias("root"))
            others = others.join(root, end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
        others = others.where("b <> top").select(F.greatest("b", "top").alias("a"), F.least("b", "top").alias("b"))
        left = materialize(others.distinct(), f"{run}/edges-{step}")
    if not hung:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    links = hung[0]
    for h in hung[1:]:
        links = links.union(h)
    if len(hung) > 1:
        links = _to_roots(links, f"{run}/labels")
    roots = links.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("label"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)


def _to_roots(links: DataFrame, path: str) -> DataFrame:
    """``links(a, b)``, one for each a, with every b replaced by the last one on its way."""
    changed, step = 1, 0
    while changed:
        step += 1
        up = links.select(F.col("a").alias("b"), F.col("b").alias("up"))
        jumped = links.join(up, "b", "left").select("a", F.coalesce("up", "b").alias("b"), F.col("up").isNotNull().alias("far"))
        links, seen = materialize_counting(jumped, f"{path}-{step}", far=F.col("far"))
        changed = seen["far"]
        links = links.select("a", "b")
    return links
