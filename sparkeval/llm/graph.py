"""Connected components of large edge tables by contraction, in written rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkeval.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node of the edges (a, b); equal roots are connected, a root is one of its nodes.

    Each round lets every node point to the smallest among itself and its neighbours and replaces the edges by those
    between different targets. With ids in no order along the edges (hashes), each round removes a fixed share of the nodes
    of any component, a star at once. Hubs only meet in combining aggregates and joins; nothing is collected.
    """
    live = scratch.write(edges.select("a", "b").where("a <> b"), "edges")
    labels = scratch.write(live.selectExpr("explode(array(a, b)) AS node").distinct().selectExpr("node", "node AS root"), "labels")
    while not live.isEmpty():
        sides = live.selectExpr("inline(array(struct(a AS was, b AS other), struct(b AS was, a AS other)))")
        hooks = scratch.write(sides.groupBy("was").agg(F.min("other").alias("other")).select("was", F.least("was", "other").alias("up")), "hooks")
        new = scratch.write(labels.join(hooks, labels.root == hooks.was, "left").select("node", F.coalesce("up", "root").alias("root")), "labels")
        ends = live.join(hooks.withColumnsRenamed({"was": "a", "up": "x"}), "a").join(hooks.withColumnsRenamed({"was": "b", "up": "y"}), "b")
        left = scratch.write(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        scratch.drop(labels, live, hooks)
        labels, live = new, left
    scratch.drop(live)
    return labels


def merge(roots: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``roots`` after more edges (a, b) between its nodes or new ones: only the roots that the edges join are looked at."""
    a, b = roots.withColumnsRenamed({"node": "a", "root": "x"}), roots.withColumnsRenamed({"node": "b", "root": "y"})
    joined = edges.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
    over = components(joined.distinct(), scratch)
    moved = over.selectExpr("node AS root", "root AS up")
    known = roots.join(moved, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    new = scratch.write(known.unionByName(over.join(roots, "node", "left_anti")), "labels")
    scratch.drop(over, roots)
    return new
