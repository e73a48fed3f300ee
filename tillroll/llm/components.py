"""Connected components of an edge table, without collecting it.

Every task first contracts its edges with union-find, so each node leaves a
task once per task at most. The remaining edges are contracted by alternating
large-star and small-star steps until they are stars around the smallest node
of each component. Steps are aggregations and joins; each is staged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import gathered, stage, tidied


@tidied
def _forest(batches):
    """Union-find over one task's edges: (node, smallest node of its tree)."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while (up := parent.get(x, x)) != root:
            parent[x], x = root, up
        return root

    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
                parent.setdefault(min(x, y), min(x, y))
    nodes = [n for n in parent if parent[n] != n]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(n) for n in nodes], pa.int64())],
                                     names=["a", "b"])


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return both.join(least, both["a"] == least["u"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    """``e`` has a > b."""
    least = e.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    hooked = e.join(least, e["a"] == least["u"])
    return (hooked.select("b", "m").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())


def _are_stars(e: DataFrame) -> bool:
    """Whether every node has one edge to a smaller one, which has none itself."""
    sides = e.select(F.col("a").alias("x"), F.lit(1).alias("up")).union(e.select("b", F.lit(0))).groupBy("x")
    return sides.agg(F.sum("up").alias("up"), F.min("up").alias("least")).filter("up > 1 OR up > least").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) with ``b`` the smallest node of the component of ``a``, for every
    node but the smallest ones. ``edges`` are two long columns; loops are
    allowed. The rounds grow with the logarithm of the longest path."""
    now = stage(gathered(edges.toDF("a", "b").filter("a <> b")).mapInArrow(_forest, "a long, b long"), "edges")
    while not _are_stars(now):
        now = stage(gathered(_small_star(_large_star(now))), "edges")
    return now


def spanning_forest(weight: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Edges of a heaviest spanning forest of a full weight matrix, using
    weights of ``least`` or more (Prim's algorithm, one row at a time)."""
    n = len(weight)
    best, via = np.full(n, -1.0), np.full(n, -1)
    left, out = np.ones(n, bool), []
    for _ in range(n):
        i = int(np.argmax(np.where(left, best, -2.0)))
        if best[i] >= least:
            out.append((int(via[i]), i))
        left[i] = False
        closer = left & (weight[i] > best)
        best[closer], via[closer] = weight[i][closer], i
    return out
