"""Connected components of an edge list by alternating star contractions.

Each round turns neighbourhoods into stars around their smallest member (first
over larger neighbours, then over smaller ones); edges only ever shrink in
number of distinct ends, and the rounds needed grow with the logarithm of the
largest component. Hubs are pre-aggregated (``min``) before any shuffle and
the join back on a hub is one that adaptive execution can split.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges with ``u > v``."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    large = (both.filter("v > u").join(low, "u")
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    linked = large.join(low, "u")
    return (linked.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v"))).distinct())


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)`` that is not itself
    the root (the smallest node) of its component."""
    work = saved(edges.filter("a != b")
                 .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .distinct(), "component-edges")
    mark = None
    for _ in range(max_rounds):
        now = work.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or now[0] == 0:
            return work.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
        work = saved(_stars(work), "component-edges")
    raise RuntimeError("component rounds exhausted")


def local_components(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and their component's smallest node, for edge arrays in memory."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new
