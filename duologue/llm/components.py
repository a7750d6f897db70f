"""Connected components of a graph that is itself a table of edges.

Alternating rounds re-hang neighbours on the smallest node around (first from each node's
larger neighbours, then from its smaller ones) until every node hangs on the smallest of
its component; few rounds do, as paths shrink by half and more.  Each round is joins and
map-side minima, stored before the next.  Nodes with very many neighbours are joined by
broadcast (a thousand at most), so that no task gets all of a hub's edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duologue.llm import workers


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer edges that connect the same nodes: each node with the smallest of its part."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        for end in (x, y):
            np.minimum.at(new, root[end], low)
            np.minimum.at(new, end, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            break
        root = new
    hung = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[hung], nodes[root[hung]]


def contract(edges: Iterator[tuple[np.ndarray, np.ndarray]], limit: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Streams edges through ``forest``, at most about ``limit`` at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            u, v = forest(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
            held.clear()
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    size = 0
    for a, b in edges:
        if len(a):
            held.append((a, b))
            size += len(a)
        if size >= limit:
            yield from flush()
            size = 0
    yield from flush()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) but the roots; the root is the component's smallest node.

    Loops, repeated edges and either direction are fine, rows with a null end are left
    out, and no edges give no rows.
    """
    now = workers.stored(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    state = _state(now)
    while state[0]:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        total = 2 * state[0]
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = workers.join_counted(both.where("v > u"), least, "u", total).where("v <> m")
        large = workers.stored(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = workers.join_counted(large, low, "u", total).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = workers.stored(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
