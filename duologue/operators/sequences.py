"""What keeps its order between two numberings of the same rows."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moved_rows(pairs: DataFrame, key: str, first: str, second: str, chunk: int = 4096) -> DataFrame:
    """``key, first`` of the rows that are off a longest run of rows ascending by both numbers.

    ``first`` and ``second`` are whole numbers, each at most once per key.  Where several
    longest ones exist: it ends with the last row (by ``first``) that the greatest length
    ends at, and before each row comes the last earlier one whose own length is one less.

    Rows with successive numbers in both orders stay or move together.  So each task of a
    range partition first joins its rows to such stretches, and only these go through the
    patience search, which holds two numbers per stretch of a key: as many as there are
    breaks in its order, however long it is.
    """
    kind = dict(pairs.dtypes)[key]
    rows = pairs.select(F.col(key).alias("key"), F.col(first).cast("long").alias("a"), F.col(second).cast("long").alias("b"))
    placed = rows.repartitionByRange("key", "a").sortWithinPartitions("key", "a")

    def stretches(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["key", "a", "last", "b", "rows"]
        now: list | None = None  # a, last a, b, rows, key
        for batch in batches:
            out: list[list] = []
            for i, (name, a, b) in enumerate(zip(*(batch[c].to_pylist() for c in ("key", "a", "b")), strict=True)):
                if now is not None and name == now[5] and a == now[1] + 1 and b == now[2] + now[3]:
                    now[1], now[3] = a, now[3] + 1
                else:
                    if now is not None:
                        out.append(now)
                    now = [a, a, b, 1, batch["key"].slice(i, 1), name]
            if out:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([r[4] for r in out]), *(pa.array([r[i] for r in out], pa.int64()) for i in range(4))], names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([now[4], *(pa.array([now[i]], pa.int64()) for i in range(4))], names)

    def off(batches: Iterator) -> Iterator:
        from bisect import bisect_left

        import pyarrow as pa

        def lost(key: pa.Array, spans: list, before: list, ends: list) -> Iterator:
            """Stretches that the chain from the last end leaves out, in pieces of ``chunk`` numbers."""
            kept, at = set(), ends[-1] if ends else -1
            while at >= 0:
                kept.add(at)
                at = before[at]
            found = []
            for i, (a, last) in enumerate(spans):
                if i not in kept:
                    found += [(x, min(last, x + chunk - 1)) for x in range(a, last + 1, chunk)]
            for x in range(0, len(found), chunk):
                some = found[x : x + chunk]
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([key] * len(some)), *(pa.array([s[i] for s in some], pa.int64()) for i in range(2))], ["key", "from_", "to_"]
                )

        key = name = None
        spans: list = []
        before: list = []
        # per length that some chain ends at: the smallest end, its length, its stretch
        tops: list = []
        lengths: list = []
        ends: list = []
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("key", "a", "last", "b", "rows")]
            for i, (this, a, last, b, n) in enumerate(zip(*columns, strict=True)):
                if key is None or this != name:
                    if key is not None:
                        yield from lost(key, spans, before, ends)
                    key, name, spans, before, tops, lengths, ends = batch["key"].slice(i, 1), this, [], [], [], [], []
                at = bisect_left(tops, b)
                length = (lengths[at - 1] if at else 0) + n
                before.append(ends[at - 1] if at else -1)
                end = at
                while end < len(tops) and lengths[end] <= length:
                    end += 1
                tops[at:end], lengths[at:end], ends[at:end] = [b + n - 1], [length], [len(spans)]
                spans.append((a, last))
        if key is not None:
            yield from lost(key, spans, before, ends)

    runs = placed.mapInArrow(stretches, f"key {kind}, a long, last long, b long, rows long")
    ranges = runs.repartition("key").sortWithinPartitions("key", "a").mapInArrow(off, f"key {kind}, from_ long, to_ long")
    return ranges.select(F.col("key").alias(key), F.explode(F.sequence("from_", "to_")).alias(first))


def edit_distance(left: Column, right: Column) -> Column:
    """Exact Levenshtein distance at every length: narrow bands first, all cells only for texts that differ much."""
    banded = [F.levenshtein(left, right, limit) for limit in (16, 256, 4096)]
    return F.coalesce(*[F.when(d >= 0, d) for d in banded], F.levenshtein(left, right))
