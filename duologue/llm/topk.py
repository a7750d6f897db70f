"""Exact top-k by inner product, with bounds from segment statistics, coarse to fine.

A vector is cut into segments; each keeps its mean and the length of its deviations from
it.  For two vectors the products of the means plus the products of these lengths bound
the inner product from above (equally, they bound the distance from below).  A few
segments bound all pairs of a batch with one small matrix product; pairs that may still
reach a query's k best so far are bounded again with more segments, and only what is left
is multiplied in full.

Queries are taken in blocks of bounded size.  A block is broadcast, candidates stay where
they are, and each task keeps at most k rows per query; first bounds come from an exact
search over a hashed part of the candidates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duologue.llm import workers

SCALE = 1024
#: Segments of each level, coarse to fine.
LEVELS = (4, 16)
#: Queries of a block; with their bounds they are what is broadcast.
QUERY_BLOCK = 8192
#: Every so-many-th candidate by digest gives the first bounds.
PILOT = 32
#: Pairs of a numpy pass.
PASS_PAIRS = 1 << 21


def vectors(column: pa.Array, ids: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Scaled, floored vectors by their length: ids and rows.  Leaves out rows with a null id, null vectors and those with null or non-finite parts."""
    lists = column.cast(pa.list_(pa.float64()))
    flat = lists.flatten()
    values = flat.to_numpy(zero_copy_only=False)  # null parts become NaN
    sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False).astype(float), nan=0).astype(np.int64)
    given = lists.is_valid().to_numpy(zero_copy_only=False) & ids.is_valid().to_numpy(zero_copy_only=False)
    begins = np.cumsum(sizes) - sizes
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(values * SCALE)
    numbers = ids.fill_null(0).to_numpy(zero_copy_only=False)
    out = {}
    for size in np.unique(sizes[given]).tolist():
        rows = np.flatnonzero(given & (sizes == size))
        matrix = scaled[begins[rows][:, None] + np.arange(size)]
        fine = np.isfinite(matrix).all(axis=1)
        out[size] = (numbers[rows[fine]], matrix[fine])
    return out


def statistics(matrix: np.ndarray, segments: int) -> np.ndarray:
    """Per segment, the mean times the root of its width, and the length of the deviations: their products bound inner products."""
    parts = np.array_split(np.arange(matrix.shape[1]), min(segments, max(1, matrix.shape[1])))
    out = np.zeros((len(matrix), 2 * len(parts)))
    for k, at in enumerate(parts):
        if len(at):
            part = matrix[:, at]
            mean = part.mean(axis=1)
            out[:, 2 * k] = mean * np.sqrt(len(at))
            out[:, 2 * k + 1] = np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1))
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of ``a`` with all of ``b``; both hold whole numbers as doubles.

    A product beyond the range of a long is the nearest long.
    """
    bound = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if bound < 2.0**53:
        return (a @ b.T).astype(np.int64)
    if bound < 2.0**62:
        return np.einsum("ij,kj->ik", a.astype(np.int64), b.astype(np.int64))
    whole = [[int(x) for x in row] for row in b]
    limit = 1 << 63
    exact = [[min(limit - 1, max(-limit, sum(int(x) * y for x, y in zip(row, other, strict=True)))) for other in whole] for row in a]
    return np.array(exact, np.int64).reshape(len(a), len(b))


@dataclass
class Block:
    """Queries of one length, and the least score that can still be among the k best of each."""

    ids: np.ndarray
    matrix: np.ndarray
    least: np.ndarray

    def __post_init__(self) -> None:
        self.stats = [statistics(self.matrix, n) for n in LEVELS]
        self.norms = np.sqrt((self.matrix**2).sum(axis=1))


NO_SCORE = np.iinfo(np.int64).min


class Best:
    """The k best (score high, then id low) of each query so far."""

    def __init__(self, k: int, least: np.ndarray) -> None:
        self.k, self.least = k, least.copy()
        self.rows = [np.zeros(0, np.int64)] * 3  # query, id, score

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        query, ids, score = (np.concatenate(x) for x in zip(self.rows, (query, ids, score), strict=True))
        order = np.lexsort((ids, ~score, query))  # ~score turns the order round without overflow
        query = query[order]
        first = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else query
        rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        keep = order[rank < self.k]
        self.rows = [query[rank < self.k], ids[keep], score[keep]]
        full = rank == self.k - 1
        at = query[full]
        self.least[at] = np.maximum(self.least[at], score[order][full])


def search(block: Block, best: Best, ids: np.ndarray, matrix: np.ndarray) -> None:
    """Offers candidates to all queries of a block."""
    step = max(1, PASS_PAIRS // max(1, len(block.ids)))
    for a in range(0, len(ids), step):
        own, rows = ids[a : a + step], matrix[a : a + step]
        slack = 1e-9 * np.sqrt((rows**2).sum(axis=1)).max(initial=0) * block.norms + 1e-6
        wanted = best.least - slack  # rounding may lower a bound
        at = np.arange(len(own))
        may = np.ones((len(own), len(block.ids)), bool)
        for level, stats in zip(LEVELS, block.stats, strict=True):
            may = may[:, :] & (statistics(rows[at], level) @ stats.T >= wanted)
            left = may.any(axis=1)
            at, may = at[left], may[left]
            if not len(at):
                break
        if not len(at):
            continue
        score = products(rows[at], block.matrix)
        may &= (score >= best.least) & (own[at][:, None] != block.ids)
        c, q = np.nonzero(may)
        best.add(q, own[at][c], score[c, q])


def _partial(rows: DataFrame, blocks: dict[int, Block], k: int) -> DataFrame:
    """(query_id, vec_id, score): at most k rows of each query from each task."""
    sent = rows.sparkSession.sparkContext.broadcast(blocks)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {n: Best(k, b.least) for n, b in sent.value.items()}
        for batch in batches:
            for n, (ids, matrix) in vectors(batch["vector"], batch["id"]).items():
                if n in best:
                    search(sent.value[n], best[n], ids, matrix)
        for n, found in best.items():
            query, ids, score = found.rows
            yield pa.RecordBatch.from_arrays([pa.array(sent.value[n].ids[query]), pa.array(ids), pa.array(score)], ["query_id", "vec_id", "score"])

    return rows.mapInArrow(each, "query_id long, vec_id long, score long")


def _ranked(partial: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(embeddings: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products, ties to the smaller id.

    Candidates are all rows with another id and as many components.  Vectors that are null
    or have null or non-finite components take no part, nor do rows with a null id.
    Repeated rows are candidates each for itself; rows that share a query's id are one
    query (the least vector counts) and not its candidates.  An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    workers.importable(spark)
    rows = embeddings.select(embeddings[key].cast("long").alias("id"), embeddings[vector].alias("vector"))
    asked = embeddings.where(is_query).select(embeddings[key].cast("long").alias("id"), embeddings[vector].alias("vector"))
    valid = F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    queries = workers.stored(asked.where(F.col("id").isNotNull() & valid).groupBy("id").agg(F.min("vector").alias("vector")))
    pilot = rows.where(F.pmod(F.xxhash64("id"), F.lit(PILOT)) == 0)
    number = -(-queries.count() // block)
    found = []
    for b in range(number):
        # about ``block`` rows, whatever the number of queries
        part = queries.where(F.pmod(F.xxhash64("id", F.lit("block")), F.lit(number)) == b).toArrow().combine_chunks()
        blocks = {}
        for n, (ids, matrix) in vectors(pa.chunked_array(part["vector"]).combine_chunks(), pa.chunked_array(part["id"]).combine_chunks()).items():
            blocks[n] = Block(ids, matrix, np.full(len(ids), NO_SCORE))
        first = _ranked(_partial(pilot, blocks, k), k).where(F.col("rank") == k).select("query_id", "score").toArrow()
        known = dict(zip(first["query_id"].to_pylist(), first["score"].to_pylist(), strict=True))
        for x in blocks.values():
            x.least = np.array([known.get(i, NO_SCORE) for i in x.ids.tolist()], np.int64)
        found.append(workers.stored(_partial(rows, blocks, k)))
    none = spark.createDataFrame([], "query_id long, vec_id long, score long")
    return _ranked(reduce(DataFrame.union, found, none), k).select("query_id", "rank", "vec_id", "score")
