"""Connected components of a graph given as edges."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Stage = Callable[[str, DataFrame], DataFrame]


def _contracted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over each batch of edges: as many edges as nodes at most are left, each from a node
    to the least one it is joined to."""
    for frame in frames:
        parent: dict = {}

        def root(x):  # noqa: ANN001, ANN202
            top = x
            while parent.setdefault(top, top) != top:  # noqa: B023
                top = parent[top]  # noqa: B023
            while parent[x] != top:  # noqa: B023
                parent[x], x = top, parent[x]  # noqa: B023
            return top

        for a, b in zip(frame["a"], frame["b"], strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        rows = [(x, root(x)) for x in list(parent)]
        yield pd.DataFrame([r for r in rows if r[0] != r[1]], columns=["a", "b"])


def _large_star(edges: DataFrame, stage: Stage) -> DataFrame:
    """Joins the larger neighbours of each node to its least neighbour, or to the node itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    low = stage("low", least.select("a", F.least("low", "a").alias("low")))
    larger = both.join(low, "a").where(F.col("b") > F.col("a"))
    return larger.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame, stage: Stage) -> DataFrame:
    """Joins the smaller neighbours of each node, and the node, to the least of them."""
    low = stage("low", edges.groupBy("a").agg(F.min("b").alias("low")))
    joined = edges.join(low, "a").select(F.inline(F.array(
        F.struct(F.col("a").alias("a"), F.col("low").alias("b")),
        F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
    )))
    return joined.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """(node, comp): each node of `edges` (a, b) and the least node it is connected to.

    Edges are contracted within tasks, then stars are built alternately from larger and smaller
    neighbours until nothing changes; the number of rounds grows with the logarithm of the longest
    path. Only a checksum comes to the driver. Nodes are joined on written tables, so a hub's edges
    can be split.
    """
    kind = edges.select("a", "b").schema
    pairs = edges.select("a", "b").where(F.col("a") != F.col("b"))
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stage("edges", pairs.mapInPandas(_contracted, kind).distinct())
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
        now = stage("stars", _small_star(stage("large", _large_star(now, stage)), stage))
    children = now.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    return children.unionByName(roots)
