"""Connected components of a graph given by its links, as alternating star contractions on DataFrames."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import computed

#: Links of one task; a small graph is then not spread over many nearly empty files in every round.
TASK_LINKS = 100_000


def _towards_smallest(links: DataFrame) -> DataFrame:
    """Every node's neighbours, each with the smallest of them and the node itself."""
    low = links.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    return links.join(low, "a")


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes: each node but the smallest of its component with that one."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    inner = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[inner], nodes[label[inner]]


def _contracted(batches):
    """The links of a task as stars, some ``TASK_LINKS`` at a time."""
    held, n = [], 0

    def out():
        a, b = stars(*(np.concatenate([x.column(c).to_numpy() for x in held]) for c in "ab"))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n > 2 * TASK_LINKS:
            yield out()
            held, n = [], 0
    if n:
        yield out()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of a link (a, b); the label is the component's smallest node.

    Each task first makes stars of the links it has, which settles a graph of one task.  Then each round links larger
    neighbours, then smaller ones, to the smallest node in sight; when nothing changes every component is a star.  A node
    with many links is summed before the shuffle and its join can be split.
    """
    tasks = 1 + links.count() // TASK_LINKS
    edges = links.where("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long")).coalesce(tasks)
    edges = edges.mapInArrow(_contracted, "a long, b long")
    edges = computed(edges if tasks == 1 else edges.distinct().coalesce(tasks))
    state = None
    for _ in range(most_rounds if tasks > 1 else 0):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(tasks)
        large = _towards_smallest(both).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        near = _towards_smallest(large.where("a <> b").coalesce(tasks))
        small = near.select(F.col("b").alias("a"), F.col("low").alias("b")).union(near.select("a", F.col("low").alias("b")))
        edges = computed(small.where("a <> b").coalesce(tasks).distinct().coalesce(tasks))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        if tasks > 1:
            raise RuntimeError("the components did not settle")
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return found.union(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()).coalesce(tasks)
