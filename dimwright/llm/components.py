"""Connected components of a link table, by hooking and contraction on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.llm.common import forget, stored


def _edges(links: DataFrame) -> DataFrame:
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _roots(parents: DataFrame) -> DataFrame:
    """``parents (node, parent)``, a forest, with every parent replaced by its root: pointer jumping."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("higher"))
        after = stored(
            parents.join(up, "parent").select("node", F.col("higher").alias("parent"),
                                              (F.col("higher") < F.col("parent")).alias("moved")), "parents", small=True)
        forget(parents)
        if after.where("moved").isEmpty():
            return after
        parents = after


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links (a, b)``; the component is its smallest node.

    Each round hooks every node to the smallest of itself and its neighbours, follows
    the hooks to their roots, and contracts the links to links between roots; so
    rounds work on ever fewer nodes and links.  Rounds and jumps grow
    with logarithms.  A hub's rows are reduced map-side by ``min`` before they
    shuffle; nothing leaves the executors.
    """
    edges = stored(_edges(links), "links", small=True)
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
            "node", F.least("node", "low").alias("parent"))
        roots = _roots(stored(hooks, "parents", small=True)).select("node", "parent")
        of_a, of_b = (roots.select(F.col("node").alias(c), F.col("parent").alias(f"root_{c}")) for c in ("a", "b"))
        contracted = edges.join(of_a, "a").join(of_b, "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        after = stored(_edges(contracted), "links", small=True)
        forget(edges)
        edges = after
        if labels is None:
            labels = roots.withColumnRenamed("parent", "component")
        else:
            further = roots.select(F.col("node").alias("component"), F.col("parent").alias("root"))
            labels = stored(labels.join(further, "component", "left").select(
                "node", F.coalesce("root", "component").alias("component")), "labels", small=True)
    return edges.select(F.col("a").alias("node"), F.col("a").alias("component")) if labels is None else labels
