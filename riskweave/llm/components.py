"""Connected components of a link table, wholly on the executors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.tables import Scratch


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links (a, b) in order, and the smallest node reachable from each."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        if (low == high).all():
            return nodes, nodes[root]
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]


def thinned(links: DataFrame) -> DataFrame:
    """The links (a, b) of each partition as stars; no connection is lost.

    A task holds the links of its own partition only, whose size is that of a
    shuffle partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            a = np.append(a, batch.column(0).to_numpy())
            b = np.append(b, batch.column(1).to_numpy())
            if len(a) > 1 << 20:
                a, b = local_roots(a, b)
                a, b = a[a != b], b[a != b]
        a, b = local_roots(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], ["a", "b"])

    return links.select("a", "b").mapInArrow(run, "a long, b long")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node reachable.

    Large and small stars in turn: every node's larger neighbours, then its smaller
    ones, move to the smallest neighbour, until all links point at a root. Minima are
    written before they are joined, so a node with very many links is split by the join.
    """
    ends = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = scratch.write(thinned(ends).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = scratch.write(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "low")
        moved = both.where(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = scratch.write(moved.distinct(), "large")
        least = scratch.write(large.groupBy("a").agg(F.min("b").alias("low")), "least")
        moved = large.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where(F.col("a") != F.col("b"))
        small = moved.unionByName(least.select("a", F.col("low").alias("b"))).distinct()
        old, edges = edges, scratch.write(small, "small")
        scratch.drop(old, low, large, least)
        # Done when every node has one link and no root has one of its own.
        per_node = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        loose = per_node.where(F.col("n") > 1).isEmpty() and edges.join(
            edges.select(F.col("b").alias("root")).distinct(), F.col("a") == F.col("root"), "left_semi"
        ).isEmpty()
        if loose:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
