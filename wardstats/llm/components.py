"""Connected components of a table of links: forests in the tasks, then alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored

TASK_LINKS = 1_000_000  # links whose components one task finds in memory, some 100 MB


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the links (a, b), ascending, and the smallest node that it reaches.

    Each round hooks both roots of every link under the smaller one, then lets
    nodes point to their roots; it ends when both sides of all links agree.
    """
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
    return nodes, nodes[root]


def forests(links: DataFrame, size: int = TASK_LINKS) -> DataFrame:
    """Links (a, b) with the same components: those of each ``size`` links of a task become stars around their smallest node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def star() -> pa.RecordBatch:
            nodes, roots = forest(*map(np.concatenate, zip(*held)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["a", "b"])

        for batch in batches:
            for i in range(0, batch.num_rows, size):
                part = batch.slice(i, size)
                held.append(tuple(np.array(part.column(c), np.int64) for c in ("a", "b")))
                if sum(len(x) for x, _ in held) >= size:
                    yield star()
        if held:
            yield star()

    return links.select("a", "b").mapInArrow(run, "a long, b long")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).collect()[0])


def components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b): the smallest node it reaches.

    Each task first turns its own links into stars, so that links that say the
    same don't travel. Where they are ``task_links`` by count, or fewer, one
    task finds the components of all. Beyond that alternating stars do: each
    round ties every node's larger neighbours to its smallest one, then its
    smaller ones; a logarithmic number of rounds turns each component into a
    star. Only sums come to the driver. Links may repeat; a link to itself is
    allowed; without links there is no row. The table is written.
    """
    edges = stored(forests(links, task_links), "links")
    if edges.count() <= task_links:
        found = stored(forests(edges.coalesce(1), task_links).select(F.col("a").alias("node"), F.col("b").alias("label")), "labels")
        discard(edges)
        return found
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written first: a join of two plain shuffles can split a node with very many links.
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.join(least, "a").where("b >= a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "large-stars")
        least_large = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        tied = large.join(least_large, "a")
        small = tied.select("a", F.col("m").alias("b")).unionByName(tied.select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        old, edges = edges, stored(small, "stars")
        for table in (old, least, large, least_large):
            discard(table)
        new = _state(edges)
        if new == state:
            found = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")), "labels")
            discard(edges)
            return found
        state = new
