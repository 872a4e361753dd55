"""Connected components: a local forest per task, then alternating large-star and small-star steps.

Every step is a join or an aggregate over staged tables; nothing but a flag comes to the driver. A step moves each node
closer to the smallest node it reaches, and the loop ends when the edges are stars, which one aggregate tells.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import stage, unstage

_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])
FOREST_EDGES = 1_000_000


def _forest(batches):
    """Edges of a partition as stars: each node with the smallest node of its local component."""
    def stars(a, b):
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        x, y = at[:len(a)], at[len(a):]
        root = np.arange(len(nodes))
        while True:
            low = np.minimum(root[x], root[y])
            before = root.copy()
            np.minimum.at(root, root[x], low)
            np.minimum.at(root, root[y], low)
            root = root[root]
            if (root == before).all() and (root[x] == root[y]).all():
                break
        moved = root != np.arange(len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], schema=_EDGES)

    held, size = [], 0
    for batch in batches:
        held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
        size += batch.num_rows
        if size >= FOREST_EDGES:
            yield stars(*(np.concatenate(x) for x in zip(*held)))
            held, size = [], 0
    if size:
        yield stars(*(np.concatenate(x) for x in zip(*held)))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    return (both.filter("b > a").join(least, "a")
                .select(F.col("b").alias("a"), F.least("least", "a").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).filter("a <> b").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge up and nothing hangs below a node that has one."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("b").alias("x"), F.lit(0).alias("up")))
    bad = ends.groupBy("x").agg(F.sum("up").alias("ups"), F.min("up").alias("least")).filter(
        "ups > 1 OR (ups = 1 AND least = 0)")
    return bad.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); a component is named by its smallest node.

    Repeated edges, self loops and an empty table are fine (a node that only has a self loop is not returned).
    """
    down = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stage(down.mapInArrow(_forest, "a long, b long"), "cc")
    while not _are_stars(edges):
        moved = stage(_small_star(_large_star(edges)), "cc")
        unstage(edges)
        edges = moved
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
