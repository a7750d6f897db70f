"""Small helpers shared by the operators: shipping code, Arrow batches, word splitting."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain, count
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duologue.session import checkpoint_root

#: Words are runs of anything but space and the control characters 9 to 13.
#: ``bytes.split`` cuts at exactly these six characters.
WORD = r"[^\x20\x09-\x0D]+"

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let Python workers of this application import the package from where the driver did.

    A cluster usually installs the package or ships it with ``--py-files``; the extra
    entry does no harm there.
    """
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *filter(None, known)])


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with a function from one record batch to one record batch (or None)."""
    importable(df.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = function(batch)
            if out is not None:
                yield out

    return df.mapInArrow(each, schema)


def strings(column: pa.Array) -> list[str]:
    """Texts of a column, null as the empty text."""
    return [x or "" for x in column.to_pylist()]


def utf8(column: pa.Array) -> list[bytes]:
    """Texts of a column as UTF-8, null as the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def groups_of(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of items whose sizes add up to about ``limit`` (one item at least)."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


class Numbering(dict):
    """Gives each new key the next number."""

    def __init__(self) -> None:
        self._next = count().__next__

    def __missing__(self, key) -> int:
        self[key] = n = self._next()
        return n


def number_words(docs: list[list[bytes]]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Word numbers of all documents in a row, the words by number, and each document's first position (one more at the end)."""
    starts = np.zeros(len(docs) + 1, np.int64)
    np.cumsum([len(d) for d in docs], out=starts[1:])
    numbers = Numbering()
    ids = np.fromiter(map(numbers.__getitem__, chain.from_iterable(docs)), np.int64, int(starts[-1]))
    return ids, list(numbers), starts


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of each document's values; documents may be empty."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads neighbours (the splitmix64 finish)."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_remainder(doc_id: Column, modulus: int) -> Column:
    """CRC-32 of the id as text, by ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read back.

    Cuts the lineage: what comes after reads files that outlive any executor, and nothing
    before is computed a second time.
    """
    path = f"{checkpoint_root(df.sparkSession)}/llm-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, limit: int = 8 << 20) -> DataFrame:
    """A stored table marked for broadcast if its rows, measured, stay below ``limit`` bytes; else as it is.

    Whoever joins with it gets the same rows either way.
    """
    width = sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) + 24 for c in df.columns), F.lit(0))
    total = df.select(F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= limit else df


def join_counted(left: DataFrame, right: DataFrame, key: str, total: int, share: int = 1000) -> DataFrame:
    """Inner join of ``left`` with a stored table that has one row per key and in ``n`` how many of the ``total`` left rows it meets.

    Keys that meet at least one in ``share`` rows, of which there are ``share`` at most, are
    broadcast, so that no task gets all rows of a frequent key; the others are shuffled.
    """
    frequent = F.col("n") * share >= total
    hot = F.broadcast(right.where(frequent))
    rest = left.join(F.broadcast(right.where(frequent).select(key)), key, "left_anti")
    return left.join(hot, key).unionByName(rest.join(right.where(~frequent), key)).drop("n")
