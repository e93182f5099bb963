"""Connected components of a distributed edge list, by contraction of parts of it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize

EDGES_PER_TASK = 500_000


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of these edges and the smallest node each is connected to."""
    nodes, ends = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        if not apart.any():
            return nodes, nodes[root]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if parts:
        nodes, roots = forest(*(np.concatenate(x) for x in zip(*parts)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["node", "root"])


def components(edges: DataFrame, edges_per_task: int = EDGES_PER_TASK) -> DataFrame:
    """(node, root) for every node of `edges` (u, v); the root is the smallest node.

    Each task contracts a fixed number of edges to a forest. Where a node got several roots,
    those roots are connected: they are the edges of a smaller graph, treated alike.
    """
    edges = materialize(edges.select("u", "v"), "edges")
    parts = max(1, -(-edges.count() // edges_per_task))
    trees = materialize(edges.coalesce(parts).mapInArrow(_contract, "node long, root long"), "trees")
    if parts == 1:
        return trees
    least = materialize(trees.groupBy("node").agg(F.min("root").alias("least")), "trees")
    apart = trees.join(least, "node").where("root <> least").select(F.col("root").alias("u"), F.col("least").alias("v"))
    above = components(apart.distinct(), edges_per_task)
    above = above.select(F.col("node").alias("least"), F.col("root").alias("top"))
    joined = least.join(above, "least", "left")
    return materialize(joined.select("node", F.coalesce("top", "least").alias("root")), "trees")
