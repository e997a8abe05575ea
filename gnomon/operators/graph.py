"""Connected components by DataFrame joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gnomon.operators.tables import written

#: Edges that a task contracts at a time.
EDGES = 1 << 20


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges (a, b), and the smallest node of each one's component among these edges."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while (root[x] != root[y]).any():
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        np.minimum.at(root, high, low)
        while (root != root[root]).any():
            root = root[root]
    return nodes, nodes[root]


def contracted(pairs: DataFrame) -> DataFrame:
    """Edges (a, b) of the same components, fewer and shorter: of the edges that a task holds, EDGES at a time, those
    from a node to the smallest of its component among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= EDGES:
                held = [out(held)]
                # What became short takes more; only what stays long is let go.
                if held[0].num_rows > EDGES // 2:
                    yield held.pop()
        if held:
            yield out(held)

    def out(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        a, b = (np.concatenate([x.column(k).to_numpy() for x in held]) for k in (0, 1))
        nodes, root = stars(a, b)
        inner = nodes != root
        return pa.RecordBatch.from_arrays([pa.array(root[inner]), pa.array(nodes[inner])], ["a", "b"])

    return pairs.select("a", "b").mapInArrow(run, "a bigint, b bigint")


def smallest_reachable(pairs: DataFrame, *keys: str) -> DataFrame:
    """node and root, the smallest node of its component, of the nodes in pairs (a, b, and keys that are the same
    all over a component, if known; a and b are different bigints).

    Each task first contracts the edges that it holds to stars. Dealt and sorted by keys these are whole components, and
    one round of joins finds nothing left to do. Components that are larger than a task's share go on by rounds, in
    which labels run to neighbours and jump to the label of their label. With keys these joins sort: labels are many
    times more than the bytes of their files.
    """
    side = (lambda df: df.hint("merge")) if keys else (lambda df: df)
    short = contracted(pairs.repartition(*keys).sortWithinPartitions(*keys) if keys else pairs)
    edges = written(short.union(short.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("root")))
    while True:
        near = edges.join(side(label.select(F.col("node").alias("b"), "root")), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = label.join(side(near), "node").select("node", "root", F.least("root", "near").alias("next"))
        jump = label.select(F.col("node").alias("next"), F.col("root").alias("beyond"))
        step = written(step.join(side(jump), "next").select("node", "root", F.least("next", "beyond").alias("new")))
        moved = step.where("new < root").limit(1).count()
        label = step.select("node", F.col("new").alias("root"))
        if not moved:
            return label
