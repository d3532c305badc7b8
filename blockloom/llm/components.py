"""Connected components of a link table by contraction: every node hooks onto its least neighbour, trees are flattened."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.tables import stored

#: Links that one task takes at once, in some tens of megabytes; more are contracted by the cluster until so many are left.
ONE_TASK_LINKS = 500_000


def _flat(parent: DataFrame) -> DataFrame:
    """(node, root) of a forest (node, up) whose edges all lead to a lesser node; the depth halves with each round."""
    while True:
        up = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
        parent = stored(parent.join(up, "up", "left").select("node", F.coalesce("top", "up").alias("up"), (F.col("top") < F.col("up")).alias("moved")))
        if parent.where("moved").isEmpty():
            return parent.select("node", F.col("up").alias("root"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of all nodes of a few links: the greater root of a link hooks onto the lesser until none is left."""
    held = [(np.asarray(x["a"]), np.asarray(x["b"])) for x in batches if x.num_rows]
    if not held:
        return
    nodes, ends = np.unique(np.concatenate([np.concatenate(x) for x in zip(*held)]), return_inverse=True)
    a, b = ends[: len(ends) // 2], ends[len(ends) // 2 :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    yield pa.RecordBatch.from_pydict({"node": pa.array(nodes, pa.int64()), "root": pa.array(nodes[root], pa.int64())})


def components(links: DataFrame, one_task: int = ONE_TASK_LINKS) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: bigint); root is the least node of the component.

    Each round takes the links between the remaining roots, hooks each onto its least neighbour and drops what became a
    loop, so a round at least halves the roots of every component.  Only links and labels of linked nodes move.  As soon as
    no more than ``one_task`` links are left, a single task joins them.
    """
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    labels = None
    while left := edges.count():
        if left <= one_task:
            last = stored(edges.coalesce(1).mapInArrow(_joined, "node bigint, root bigint"))
            if labels is None:
                return last
            return stored(labels.join(last.toDF("root", "next"), "root", "left").select("node", F.coalesce("next", "root").alias("root")))
        both = edges.union(edges.select("b", "a"))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")).select("node", F.least("node", "up").alias("up"))
        roots = _flat(parent)
        if labels is None:
            labels = roots
        else:
            step = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = labels.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        labels = stored(labels)
        a = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = stored(
            edges.join(a, "a").join(b, "b").where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        )
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
