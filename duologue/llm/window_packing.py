"""Packing whole documents into few windows, by a configuration linear program.

A document longer than a window is cut into full windows and a shorter first piece; all
others stay whole.  So only lengths matter: a *configuration* is a multiset of lengths that
fits a window, and the linear program asks for the fewest configurations that cover the
histogram of lengths.  It is solved by multiplicative weights: every length has a price,
a knapsack dynamic program finds the dearest configuration, which is taken, and prices of
covered lengths fall.  The counts are rounded down and what is left over goes through the
same program again, until few pieces are left or lengths have fewer than a configuration takes,
so that their number does not grow with the corpus.  These are packed best fit, longest
first.

The histogram has one number per length below the window, whatever the corpus, so the
program runs on the driver.  Documents never do: they are numbered within their length by
task (counts per task and length, then prefix sums), and a document's number alone says
which window and offset it has.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duologue.llm import workers
from duologue.llm.packing import END, encoder

WINDOW = 2048
#: Prices a round of the linear program goes through, and how near the dearest configuration others may be.
STEPS = 40
CLOSE = 0.01
#: Rounds go on until so many pieces are left, or none of a round's counts is a whole one.
REST = 8192
#: How fast the price of a covered length falls.
RATE = 0.5
#: Powers of the size by which prices begin, steps and nearness; one after the other, until the lower bound is met to within ``NEAR``.
NEAR = 1e-4
TRIES = ((1.3, STEPS, CLOSE), (1.3, 3 * STEPS, 0.0), (2.0, STEPS, CLOSE))
#: Sequences of full windows begin here, by task; below lie those of the program.
FULL = 1 << 61

Bins = list[tuple[int, list[int]]]


def knapsack(prices: np.ndarray, room: int) -> tuple[np.ndarray, list[int]]:
    """By dynamic programming, for every room up to ``room``: the dearest price of lengths (with repeats) that fit, and a length of them.

    A length without a price is not used; a choice of 0 means that one token less is as good.
    """
    worth = np.full(room + 1, -1.0, np.float32)
    known = np.where(prices > 0, prices, -1.0)[: room + 1]
    worth[: len(known)] = known
    # value[room - c] is the best for a room of c: both addends are then read forwards
    value, choice, sums = np.zeros(room + 1, np.float32), [0] * (room + 1), np.empty(room + 1, np.float32)
    for c in range(1, room + 1):
        gain = np.add(worth[1 : c + 1], value[room - c + 1 :], out=sums[:c])
        best = int(gain.argmax())
        if gain[best] > value[room - c + 1]:
            value[room - c], choice[c] = gain[best], best + 1
        else:
            value[room - c] = value[room - c + 1]
    return value[::-1], choice


def traced(choice: list[int], room: int) -> list[int]:
    out = []
    while room > 0:
        if choice[room]:
            out.append(choice[room])
            room -= choice[room]
        else:
            room -= 1
    return out


def filled(config: list[int], prices: np.ndarray, left: np.ndarray, window: int) -> list[int]:
    """``config`` with no more of a length than are left; the room this leaves is offered again, to the other lengths."""
    out, taken, prices = [], np.zeros(len(left), np.int64), prices.copy()
    while True:
        short = False
        for s in config:
            if taken[s] < left[s]:
                taken[s] += 1
                out.append(s)
            else:
                short, prices[s] = True, 0.0
        prices[taken >= left] = 0.0
        room = window - sum(out)
        if not short or not room:
            return out
        config = traced(knapsack(prices, room)[1], room)
        if not config:
            return out


def program(histogram: np.ndarray, window: int, slope: float, steps: int = STEPS, close: float = CLOSE, rate: float = RATE) -> tuple[dict[tuple[int, ...], float], float]:
    """Fractional counts of configurations that cover the histogram (nearly), and a lower bound of any packing's windows.

    Every step takes the dearest configuration, and for each length the dearest one that has
    it, if that comes within ``close`` of the dearest: as often as an equal share of the
    expected windows, no length beyond its pieces.  The price of a length grows a little
    faster than its size, so that short pieces stay to fill gaps, times an exponential of how
    far its coverage lags behind the steps made.
    """
    sizes = np.arange(len(histogram))
    need = histogram.astype(float)
    bound = float(need @ sizes) / window
    share = bound / steps
    worth = (sizes / window) ** slope
    rest, lag = need.copy(), np.zeros(len(need))
    counts: dict[tuple[int, ...], float] = {}

    def take(config: list[int]) -> float:
        kinds, times = np.unique(config, return_counts=True)
        most = float((rest[kinds] / times).min())
        much = min(share, most) if share > 1 else most
        if much > 1e-9:
            name = tuple(sorted(config, reverse=True))
            counts[name] = counts.get(name, 0.0) + much
            rest[kinds] -= times * much
        return max(much, 0.0)

    for step in range(steps):
        alive = rest > 1e-9
        if not alive.any():
            break
        lag[alive] = min(1.0, (step + 1) / steps) - (need[alive] - rest[alive]) / need[alive]
        prices = np.where(alive, worth * np.exp(rate * lag), 0.0)
        value, choice = knapsack(prices, window)
        bound = max(bound, float(prices @ need) / float(value[window]) * (1 - 1e-5))  # a solution of the dual, less what single precision may add
        done = take(filled(traced(choice, window), prices, np.ceil(rest).astype(np.int64), window))
        having = prices + value[window - sizes]
        for s in np.argsort(-having, kind="stable"):
            if done >= share or having[s] < (1 - close) * value[window]:
                break
            if rest[s] >= 1:
                done += take([int(s), *traced(choice, window - int(s))])
    return counts, bound


def best_fit(pieces: list[int], window: int) -> list[list[int]]:
    """Longest first, each into the fullest window that has room."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some window has room r
    for size in sorted(pieces, reverse=True):
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, at = window, len(bins)
            bins.append([])
        bins[at].append(size)
        by_room.setdefault(room - size, []).append(at)
        rooms |= 1 << (room - size)
    return bins


def rounded(histogram: np.ndarray, window: int, slope: float, steps: int = STEPS, close: float = CLOSE) -> tuple[Bins, float]:
    """Whole counts of configurations for exactly the histogram's pieces, and the lower bound of the first round."""
    left = histogram.astype(np.int64).copy()
    out: Bins = []
    least = 0.0
    before = -1
    while left.sum() != before and (left.sum() > REST or not least):
        before = left.sum()
        counts, bound = program(left, window, slope, steps, close)
        least = least or bound
        for config, much in sorted(counts.items(), reverse=True):
            kinds, times = np.unique(config, return_counts=True)
            n = min(int(much + 1e-6), int((left[kinds] // times).min()))
            if n > 0:
                left[kinds] -= times * n
                out.append((n, list(config)))
    rest = np.repeat(np.arange(len(left)), left).tolist()
    return out + [(1, b) for b in best_fit(rest, window)], least


def solve(histogram: np.ndarray, window: int = WINDOW) -> Bins:
    """Configurations and how many windows each has; together exactly the histogram's pieces.

    ``histogram[s]`` is the number of pieces of ``s`` tokens, below the window.
    """
    best: Bins = []
    for slope, steps, close in TRIES:
        bins, bound = rounded(histogram, window, slope, steps, close)
        if not best or windows(bins) < windows(best):
            best = bins
        if windows(best) <= bound * (1 + NEAR) + 1 - 1e-9:
            break
    return best


def windows(bins: Bins) -> int:
    return sum(n for n, _ in bins)


def slots(bins: Bins) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of a length go: ``size, first, end, sequence, each, offset``.

    Pieces numbered from ``first`` to ``end`` fill windows from ``sequence`` on, ``each`` of
    them side by side from ``offset``.
    """
    out, used, sequence = [], {}, 0
    for n, config in bins:
        offset = 0
        for size in sorted(set(config), reverse=True):
            each = config.count(size)
            first = used.get(size, 0)
            used[size] = first + n * each
            out.append((size, first, first + n * each, sequence, each, offset))
            offset += size * each
        sequence += n
    return out


def encoded(docs: DataFrame, key: str, text: str, window: int, with_ids: bool) -> DataFrame:
    """Stored lengths: ``key, tokens, size`` of the piece below a window (0: none), its number among the task's, checksums (and ids) of all pieces."""
    workers.importable(docs.sparkSession)
    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    names = ["key", "tokens", "size", "part", "number", "full", "crcs", *["ids"] * with_ids]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder().ids, np.array([END], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        seen, full = np.zeros(window, np.int64), 0
        for batch in batches:
            texts = batch["text"]
            for a in range(0, len(texts), 256):
                columns: list[list] = [[] for _ in names[1:]]
                for i in range(a, min(a + 256, len(texts))):
                    ids = encode(texts[i].as_py() or "") + end
                    tokens = len(ids) // 4
                    size = tokens % window
                    cuts = [0, *range(4 * size, len(ids) + 1, 4 * window)] if size else [*range(0, len(ids) + 1, 4 * window)]
                    pieces = [ids[x:y] for x, y in zip(cuts, cuts[1:])]
                    values = [tokens, size, part, int(seen[size]), full, [zlib.crc32(x) for x in pieces]]
                    if with_ids:
                        values.append([np.frombuffer(x, "<u4").astype(np.int32) for x in pieces])
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
                    seen[size] += 1
                    full += tokens // window
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int32()))]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
                yield pa.RecordBatch.from_arrays([batch["key"].slice(a, len(columns[0])), *arrays], names)

    schema = f"key {dict(rows.dtypes)['key']}, tokens long, size int, part int, number long, full long, crcs array<long>"
    return workers.stored(rows.mapInArrow(each, schema + ", ids array<array<int>>" * with_ids))


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``key, piece, start, length, ids_crc32, sequence_id, offset`` (``ids`` if asked for).

    A null text counts as empty; every document ends with id 0, so each has a piece.
    Repeated rows are documents of their own, null keys stay null, an empty table gives no
    pieces, other columns are not read.
    """
    spark = docs.sparkSession
    rows = encoded(docs, key, text, window, with_ids)
    counts = rows.where("size > 0").groupBy("part", "size").agg(F.count("*").alias("n"))
    histogram = np.zeros(window, np.int64)
    for size, n in counts.groupBy("size").agg(F.sum("n")).collect():  # at most one row per length
        histogram[size] = n
    earlier = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "size", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    places = slots(solve(histogram, window)) or [(0, 0, 0, 0, 0, 0)]
    # a row for each length of a configuration: steps times rounds, and these grow with the logarithm of the documents
    places = F.broadcast(spark.createDataFrame(places, "size int, first long, end long, sequence long, each long, place long"))
    numbered = rows.join(bases, ["part", "size"], "left").withColumn("at", F.col("base") + F.col("number"))
    placed = numbered.join(places, (numbered["size"] == places["size"]) & F.col("at").between(F.col("first"), F.col("end") - 1), "left").drop(places["size"])
    within = F.col("at") - F.col("first")
    short = F.col("size") > 0
    pieces = placed.select(
        "*",
        (F.col("sequence") + F.floor(within / F.col("each"))).alias("sequence_id"),
        (F.col("place") + within % F.col("each") * F.col("size")).alias("offset"),
        F.posexplode("crcs").alias("piece", "ids_crc32"),
    )
    first = short & (F.col("piece") == 0)
    whole = F.col("piece") - short.cast("int")
    base = F.lit(FULL) + F.shiftleft(F.col("part").cast("long"), 36)
    return pieces.select(
        "key",
        "piece",
        F.when(first, 0).otherwise(F.col("size") + whole * window).cast("long").alias("start"),
        F.when(first, F.col("size")).otherwise(window).cast("long").alias("length"),
        "ids_crc32",
        F.when(first, F.col("sequence_id")).otherwise(base + F.col("full") + whole).cast("long").alias("sequence_id"),
        F.when(first, F.col("offset")).otherwise(0).cast("long").alias("offset"),
        *[F.get("ids", F.col("piece")).alias("ids")] * with_ids,
    )
