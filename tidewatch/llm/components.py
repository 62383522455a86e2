"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.folders import written


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of some edges, and the smallest node that each reaches by them; nodes that are their
    own root are left out."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = places[: len(a)], places[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = np.minimum(new, new[label])
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Tie the larger (or the smaller and equal) neighbours of each node to its smallest one.

    The minimum is aggregated before the shuffle, and a hub's edges meet one row for it, so a node
    with very many neighbours can be split over tasks.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    tied = both.join(least, "a")
    if large:
        out = tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        own = least.select("a", F.col("m").alias("b"))
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own)
    return out.where("a <> b").distinct()


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that isn't its component's smallest node.

    Each round is written to the shared folder, which cuts the lineage. Rounds grow with the
    logarithm of the nodes; they end when every edge points at a node that no edge leaves.
    """
    current = written(edges.where("a <> b").select("a", "b"), purpose)
    while True:
        current = written(_stars(_stars(current, True), False), purpose)
        # done when it is a forest of stars: each node has one edge, to a root that has none
        chained = current.alias("x").join(
            current.select(F.col("a").alias("b")).distinct(), "b", "left_semi"
        )
        doubled = current.groupBy("a").count().where("count > 1")
        if chained.isEmpty() and doubled.isEmpty():
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
