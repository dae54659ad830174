"""Connected components of an edge table, without any node or link passing through the driver.

Each task first replaces its edges by a spanning forest (at most one edge per node it holds). The rest are
alternating large-star and small-star rounds over the whole table, each written to the shared folder. The driver sees
two sums per round. Hubs are no hot groups: minima are combined map-side, and the joins are ones Spark can split.
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.store import written


def forest(a, b) -> list[tuple[int, int]]:
    """(node, smallest node of its component) for the nodes of the given edges other than that smallest one."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for x, y in zip(a, b):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return [(x, r) for x in list(parent) if (r := find(x)) != x]


def _forests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    a: list[int] = []
    b: list[int] = []
    for f in frames:
        pairs = forest(a + f["a"].tolist(), b + f["b"].tolist())
        a, b = [x for x, _ in pairs], [y for _, y in pairs]
    yield pd.DataFrame({"a": pd.Series(a, dtype="int64"), "b": pd.Series(b, dtype="int64")})


def connected_components(edges: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """(node, component): component is the smallest node reachable, for each node with an edge to a smaller one.

    Nodes that are the smallest of their component, or have no edge, are not listed. Null ends are ignored.
    """
    edges = (edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
             .where("a is not null and b is not null and a <> b").mapInPandas(_forests, "a long, b long"))
    seen = None
    for _ in range(rounds):
        edges = written(_small_star(_large_star(edges)), "components")
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
