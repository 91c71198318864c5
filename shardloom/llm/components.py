"""Connected components of an edge table, by alternating large and small stars.

Every step is two aggregations that combine before they shuffle and one join of
edges with one row a node; a node with very many edges is broadcast to them, so
that no hub's edges are gathered in one place.  As few edges as a broadcast may
have are joined on the driver instead: each step costs as many tasks as there are
shuffle partitions, however few the edges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import BROADCAST_VALUES
from .common import discard, joined_by_key, written, written_at

#: Edges, of two values each, that are joined on the driver.
FEW_EDGES = BROADCAST_VALUES // 2


def rooted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges (a, b) and the least node of each one's component."""
    node, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[: len(a)], place[len(a) :]
    root = np.arange(len(node))
    while (apart := root[a] != root[b]).any():  # every other edge is within a component
        a, b = a[apart], b[apart]
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        np.minimum.at(root, high, low)
        while ((up := root[root]) != root).any():
            root = up
    return node, node[root]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b), both long; root is the least node of the component.

    Edges from a node to itself keep it as its own root.  An empty table gives an
    empty result.
    """
    one_way = lambda a, b: (F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    spark = edges.sparkSession
    every, start = written_at(edges.select(*one_way(F.col("a"), F.col("b"))).distinct(), "edges")
    if every.count() <= FEW_EDGES:
        few = every.toArrow()
        discard(spark, start)
        found = rooted(few["a"].to_numpy(), few["b"].to_numpy())
        return written(spark.createDataFrame(pa.table(dict(zip(("node", "root"), found)))), "roots")
    nodes = every.select(F.col("a").alias("node")).union(every.select("b")).distinct()
    state, path = every.where("a <> b"), None
    sign = lambda df: df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    before = sign(state)
    while before.n:  # until nothing changes
        # Large star: what lies above a node moves to the least of its neighbourhood.
        both = state.select(F.col("a").alias("u"), F.col("b").alias("v")).union(state.select("b", "a"))
        least, at = written_at(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("edges")).select("u", F.least("u", "m").alias("m"), "edges"), "stars")
        moved = joined_by_key(both.where("v > u"), least, ["u"], "edges").select(*one_way(F.col("v"), F.col("m")))
        large, between = written_at(moved.distinct(), "edges")
        # Small star: a node and what lies below it move to the least below it.
        low, under = written_at(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("edges")), "stars")
        held = joined_by_key(large, low, ["a"], "edges")
        after = held.where("b <> m").select(*one_way(F.col("b"), F.col("m"))).union(low.select("a", F.col("m").alias("b"))).distinct()
        old, (state, path) = path, written_at(after, "edges")
        for done in filter(None, (old, at, between, under)):
            discard(spark, done)
        now = sign(state)
        if now == before:
            break
        before = now
    roots = state.groupBy("a").agg(F.min("b").alias("root"))
    return nodes.join(roots, nodes.node == roots.a, "left").select("node", F.coalesce("root", "node").alias("root"))
