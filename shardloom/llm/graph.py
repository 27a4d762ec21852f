"""Connected components of links that no driver and no task could hold.

Each round, every task first joins the links it has by union-find and passes on a forest,
then large-star and small-star steps hang all nodes on the least one they know. The rounds
end when every node hangs on one that hangs on none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.tables import kept

# Links that a task joins at once; the forest of each lot is passed on.
LOT = 1 << 20


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over links: every node that is not its root, with its root, the least node."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(flat[: len(a)].tolist(), flat[len(a) :].tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    roots = np.fromiter((root(x) for x in range(len(nodes))), np.int64, len(nodes))
    hung = roots != np.arange(len(nodes))
    return nodes[hung], nodes[roots[hung]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def flush():
        table = pa.Table.from_batches(held)
        u, v = forest(table.column("u").to_numpy(), table.column("v").to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= LOT:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one node, which hangs on none."""
    hung = edges.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    unsure = hung.filter("low != high").select("u").union(
        edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u")
    )
    return unsure.isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of BIGINT links ``(a, b)``: the least node reachable from each node.

    Every node of a link is there, the least as its own component. Repeated links and links
    of a node with itself are harmless, links with a null end are left out.
    """
    whole = links.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    nodes = kept(whole.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "links")
    edges = kept(nodes.filter("u != v").mapInArrow(_forests, "u bigint, v bigint"), "edges")
    while not _settled(edges):
        # Large star: larger neighbours of a node hang on the least of its neighbours.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        # Small star: a node and its lesser neighbours hang on the least of them.
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(
            F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e")
        )
        small = small.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).filter("u != v").distinct()
        edges = kept(small, "edges")
    hung = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    alone = nodes.filter("u = v").select(F.col("u").alias("node"), F.col("v").alias("component"))
    known = hung.union(roots)
    return known.union(alone.distinct().join(known.select("node"), "node", "left_anti"))
