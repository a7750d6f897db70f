"""Ordered operations that stay parallel when one key holds most of the rows.

A plain ``Window.partitionBy(key)`` sends a key to one task.  Here rows are windowed
inside ``(key, part)`` and one small row per part carries the state of all earlier parts
forward.  Parts come from split points of a sample, for the few keys that hold many rows
(``with_parts``), or are *blocks* of an ordinal that the caller has (``pos div size``).
Results do not depend on either, only the balance of the work does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duologue.session import cut_lineage

BLOCK_ROWS = 4096

_FOLD = {"sum": F.sum, "max": F.max, "min": F.min}

#: Share of rows looked at for split points, and how many of these a key must have to be split.
SAMPLE = 0.01
SPLIT_ROWS = 508
#: Split points of a key (one less than a power of two), and how many keys are split.
SPLIT_BITS = 7
SPLIT_KEYS = 64


def split_points(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``keys, _splits``: ordered split points of the most frequent keys, ``SPLIT_KEYS`` rows at most.

    The sample reads key and order columns only.  Each task keeps the ``SPLIT_ROWS`` rows of
    a key with the smallest digests, so that a hot key is cut down before the shuffle; the
    smaller the largest digest kept, the more rows the key has.
    """
    at = F.struct(*order)
    picked = df.select(*keys, at.alias("_at")).sample(SAMPLE, seed=7).withColumn("_digest", F.xxhash64("_at"))
    nearest = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_digest")
    picked = picked.withColumn("_place", F.row_number().over(nearest)).where(F.col("_place") <= SPLIT_ROWS)
    found = picked.groupBy(*keys).agg(
        F.array_sort(F.collect_list("_at")).alias("_all"), F.max("_digest").alias("_spread"), F.count("*").alias("_rows")
    )
    hot = found.where(F.col("_rows") >= SPLIT_ROWS).orderBy("_spread").limit(SPLIT_KEYS)
    every = max(1, SPLIT_ROWS >> SPLIT_BITS)
    inner = F.transform(F.sequence(F.lit(1), F.lit((1 << SPLIT_BITS) - 1)), lambda i: F.get("_all", (i * every).cast("int")))
    return hot.select(*keys, F.array_distinct(F.filter(inner, lambda x: x.isNotNull())).alias("_splits"))


def with_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds ``_part``: for keys that are split, how many of their split points a row is not before; else null.

    Parts of a key follow ``order`` (ascending, nulls first).
    """
    points = split_points(df, keys, order)
    at = F.struct(*order)
    if keys:
        names = [f"_split_{i}" for i in range(len(keys))]
        points = F.broadcast(points.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], "_splits"))
        joined = df.join(points, _same(keys, names), "left")
    else:
        names = []
        joined = df.withColumn("_splits", points.scalar())
    # binary search; beyond the last point the comparison is null
    step = lambda n, bit: F.when(F.get("_splits", n + bit - 1) <= at, n + bit).otherwise(n)
    found = F.aggregate(F.array(*[F.lit(1 << b) for b in range(SPLIT_BITS - 1, -1, -1)]), F.lit(0), step)
    return joined.withColumn("_part", F.when(F.col("_splits").isNotNull(), found)).drop("_splits", *names)


def _same(keys: Sequence[str], names: Sequence[str]) -> Column:
    out = F.lit(True)
    for key, name in zip(keys, names, strict=True):
        out &= F.col(key).eqNullSafe(F.col(name))
    return out


def part_window(keys: Sequence[str], order: Sequence[str]):
    """Rows of a key's part up to the current one."""
    return Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def join_parts(rows: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the columns of their part's state; ``state`` has a row for each part of the split keys, which is few."""
    names = [f"_of_{i}" for i in range(len(keys))]
    few = F.broadcast(state.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col("_part").alias("_of_part"), *[c for c in state.columns if c not in (*keys, "_part")]))
    return rows.join(few, _same(keys, names) & (F.col("_part") == F.col("_of_part")), "left").drop("_of_part", *names)


def block_of(position: Column, size: int = BLOCK_ROWS) -> Column:
    """Block number of a non-negative ordinal."""
    return F.floor(position / F.lit(size)).cast("bigint")


def block_window(keys: Sequence[str], blocks: Sequence[str], order: Sequence[str | Column]):
    return Window.partitionBy(*keys, *blocks).orderBy(*order)


def _merge(kind: str, carried: Column, local: Column) -> Column:
    if kind == "sum":
        return F.coalesce(carried, F.lit(0)) + F.coalesce(local, F.lit(0))
    return (F.greatest if kind == "max" else F.least)(carried, local)


def carry_over(
    df: DataFrame,
    keys: Sequence[str],
    blocks: Sequence[str],
    spec: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """Per ``(key, block)``: the fold of ``spec`` over all earlier blocks of the key."""
    totals = df.groupBy(*keys, *blocks).agg(
        *[_FOLD[kind](value).alias(name) for name, (kind, value) in spec.items()]
    )
    names = list(spec)
    kinds = {name: kind for name, (kind, _) in spec.items()}

    def before(rows: DataFrame, scope: list, order: Sequence[str]) -> list[Column]:
        earlier = Window.partitionBy(*(scope or [F.lit(0)])).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return [_FOLD[kinds[n]](F.col(n)).over(earlier).alias(n) for n in names]

    if len(blocks) > 1 or dict(totals.dtypes)[blocks[0]] not in ("tinyint", "smallint", "int", "bigint"):
        return totals.select(*keys, *blocks, *before(totals, list(keys), blocks))
    # Blocks of blocks: one window sees 4096 of them, the top one a 4096th of their number.
    above = totals.withColumn("_above", F.floor(F.col(blocks[0]) / F.lit(BLOCK_ROWS)))
    tops = above.groupBy(*keys, "_above").agg(*[_FOLD[kinds[n]](n).alias(n) for n in names])
    tops = tops.select(*keys, "_above", *[x.alias(f"_top_{n}") for n, x in zip(names, before(tops, list(keys), ["_above"]), strict=True)])
    inner = above.select(*keys, *blocks, "_above", *before(above, [*keys, "_above"], blocks))
    joined = inner.join(tops, [*keys, "_above"], "left")
    return joined.select(*keys, *blocks, *[_carried(kinds[n], F.col(f"_top_{n}"), F.col(n)).alias(n) for n in names])


def _carried(kind: str, above: Column, inner: Column) -> Column:
    """Fold of two parts of which either may be absent; absent if both are."""
    if kind == "sum":
        return F.coalesce(above + inner, above, inner)
    return (F.greatest if kind == "max" else F.least)(above, inner)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    blocks: Sequence[str] | None,
    spec: Mapping[str, tuple[str, Column]],
    *,
    inclusive: bool = True,
) -> DataFrame:
    """Add running sums, maxima or minima per key, in ``order``.

    Without ``blocks`` the keys that hold many rows are split by a sample: ``order`` must
    then be column names, ascending.  ``blocks`` are existing columns that follow ``order``:
    all rows of an earlier block precede all rows of a later one.  Use exact types
    (integers, decimals) for sums, so that the result does not depend on the parts.
    """
    if blocks is None:
        return _running_in_parts(df, keys, order, spec, inclusive)
    carried = {f"_carry_{name}": item for name, item in spec.items()}
    state = carry_over(df, keys, blocks, carried)
    frame = block_window(keys, blocks, order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if inclusive else -1
    )
    local = df.select(
        "*", *[_FOLD[kind](value).over(frame).alias(f"_local_{name}") for name, (kind, value) in spec.items()]
    )
    joined = local.join(state, [*keys, *blocks], "left")
    return joined.select(
        *df.columns,
        *[
            _merge(kind, F.col(f"_carry_{name}"), F.col(f"_local_{name}")).alias(name)
            for name, (kind, _) in spec.items()
        ],
    )


def _running_in_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str], spec: Mapping[str, tuple[str, Column]], inclusive: bool) -> DataFrame:
    parted = with_parts(df, keys, order)
    upto = part_window(keys, order)
    frame = upto if inclusive else upto.rowsBetween(Window.unboundedPreceding, -1)
    local = parted.select("*", *[_FOLD[kind](value).over(frame).alias(f"_local_{name}") for name, (kind, value) in spec.items()])
    totals = parted.where(F.col("_part").isNotNull()).groupBy(*keys, "_part").agg(*[_FOLD[kind](value).alias(f"_carry_{name}") for name, (kind, value) in spec.items()])
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    state = totals.select(*keys, "_part", *[_FOLD[kind](F.col(f"_carry_{n}")).over(earlier).alias(f"_carry_{n}") for n, (kind, _) in spec.items()])
    merged = [_merge(kind, F.col(f"_carry_{n}"), F.col(f"_local_{n}")).alias(n) for n, (kind, _) in spec.items()]
    return join_parts(local, state, keys).select(*df.columns, *merged)


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    blocks: Sequence[str] | None = None,
    name: str = "pos",
) -> DataFrame:
    """1-based row number per key, in ``order``; parts or blocks as for ``running``."""
    return running(df, keys, order, blocks, {name: ("sum", F.lit(1).cast("bigint"))})


def with_halo(
    df: DataFrame, pos: str = "pos", size: int = BLOCK_ROWS, *, before: int = 1, after: int = 1
) -> DataFrame:
    """Cut rows with a dense 1-based position into overlapping blocks.

    Adds ``_block`` and ``_own``.  The last ``before`` rows of every block also
    appear, with ``_own`` false, in the next block, and the first ``after`` rows in
    the previous one, so that ``lag`` and ``lead`` up to these distances see their
    true neighbours inside ``(key, _block)``.
    """
    if max(before, after) > size:
        raise ValueError("a block must be at least as long as its overlap")
    ordinal = F.col(pos) - 1
    block = block_of(ordinal, size)
    within = ordinal % F.lit(size)
    copies = F.filter(
        F.array(
            F.struct(block.alias("b"), F.lit(True).alias("own")),
            F.struct(F.when(within >= size - before, block + 1).alias("b"), F.lit(False).alias("own")),
            F.struct(
                F.when((within < after) & (block > 0), block - 1).alias("b"), F.lit(False).alias("own")
            ),
        ),
        lambda copy: copy["b"].isNotNull(),
    )
    return df.select("*", F.explode(copies).alias("_copy")).select(
        *df.columns, F.col("_copy.b").alias("_block"), F.col("_copy.own").alias("_own")
    )


def number_by_text(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """1-based row number per key in the order of a text column.

    Rows are range partitioned by key and text and stored, so that neither a frequent key
    nor texts with a common head meet in one task.  A row's number is its place among its
    partition's rows of the key, plus the key's rows in earlier partitions; the latter are
    one small row per key and partition.
    """
    order = [*keys, column]
    placed = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", 33).alias("_part")
    blocks = placed.groupBy(*keys, part).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*keys, "_part", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    rows = placed.withColumn("_part", part)
    same = rows["_part"] == blocks["_part"]
    for key in keys:
        same &= rows[key].eqNullSafe(blocks[key])
    return rows.join(blocks, same).select(*[rows[c] for c in df.columns], (F.col("_at") - F.col("_first") + F.col("_before") + 1).alias(name))
