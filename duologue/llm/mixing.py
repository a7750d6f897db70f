"""Mixing sources to target weights by entropy balancing.

Each document gets a rate between 0 and 2 copies.  Among all rates that give a source its
target of words, the ones closest to 1 in (bounded) relative entropy have the form
``2 / (1 + exp(-tilt * size))``, with one multiplier ``tilt`` per source: the dual problem
is convex.  Newton steps, held inside a bracket, find the multipliers of all sources at
once; each step is one aggregation over the counts of (source, size).  Rates then become
whole copies by a digest of the row, with a per-source shift of the rounding threshold
that brings the source's total to within about a document of its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duologue.llm import workers
from duologue.operators.ordered import running

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
#: Largest error of a source's expected words, as a part of its target.
TOLERANCE = 1e-6
MAX_STEPS = 60
#: The rounding threshold is found in two passes of this many bits each.
BITS = 12
SALT = 8675309
#: Rows of a group of repeats that are made at once.
RUN = 4096


def source_key(source: Column) -> Column:
    """A text for every source, null included, in the order code point, null last."""
    return F.coalesce(F.concat(F.lit("a"), source.cast("string")), F.lit("b"))


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, source_key, size, spot) per row; ``spot`` is a repeatable draw from [0, 1).

    Rows that repeat key, source and size are counted, not told apart; their draws lie
    evenly spread around the first.
    """
    rows = docs.select(docs[key].alias("key"), source_key(docs[source]).alias("source_key"), workers.word_count(docs[text]).alias("size"))
    counted = workers.stored(rows.groupBy("key", "source_key", "size").agg(F.count("*").alias("n")))
    few = counted.where(F.col("n") <= RUN).withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    # a group of very many rows is dealt to tasks in runs
    runs = counted.where(F.col("n") > RUN).withColumn("low", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN).cast("long")))).repartition("key", "source_key", "size", "low")
    many = runs.withColumn("nth", F.explode(F.sequence(F.col("low"), F.least(F.col("low") + RUN, F.col("n")) - 1))).drop("low")
    spot = _spot(F.col("key"), F.col("source_key"), F.col("size"), F.col("nth"), F.col("n"))
    return few.unionByName(many).select("key", "source_key", "size", spot.alias("spot"))


def _spot(key: Column, source: Column, size: Column, nth: Column, n: Column) -> Column:
    first = F.pmod(F.xxhash64(F.lit(SALT), key, source, size), F.lit(1 << 52)) / F.lit(float(1 << 52))
    return F.when(n == 1, first).otherwise((first + nth / n) % 1.0)


def weigh(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds ``weight``, repeating over the sources in order; sources may be many, so ranks come from range partitions."""
    cycle = len(weights)
    placed = workers.stored(
        totals.repartitionByRange("source_key").sortWithinPartitions("source_key").withColumn("at", F.monotonically_increasing_id())
    )
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    before, offsets = 0, {}
    for p, n in sorted(placed.groupBy(part.alias("p")).count().collect()):  # one number per partition
        offsets[p], before = before % cycle, before + n
    first = F.create_map(*(F.lit(x) for pair in offsets.items() for x in pair))[part] if offsets else F.lit(0)
    chosen = F.array(*map(F.lit, weights))[((row + first) % cycle).cast("int")]
    return placed.withColumn("weight", chosen).drop("at")


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """(source_key, source_size, weight, target): shares by weight, none above ``most`` times its source's size.

    What a source can't take goes to the others by weight, until none is above.
    """
    rows = workers.stored(weigh(totals, weights).withColumn("full", F.lit(False)))
    while True:
        everything, taken, weight = rows.select(
            F.sum("source_size"),
            F.sum(F.when(F.col("full"), F.col("source_size") * most)),
            F.sum(F.when(~F.col("full"), F.col("weight"))),
        ).first()
        left = share * (everything or 0) - (taken or 0)
        wanted = F.lit(float(left)) * F.col("weight") / F.lit(float(weight or 1))
        over = ~F.col("full") & (wanted > F.col("source_size") * most)
        if not weight or rows.where(over).isEmpty():
            break
        rows = workers.stored(rows.withColumn("full", F.col("full") | over))
    target = F.when(F.col("full"), (F.col("source_size") * most).cast("double")).otherwise(wanted)
    return rows.select("source_key", "source_size", "weight", target.alias("target"))


def _rate(tilt: Column, size: Column, scale: Column) -> Column:
    return MOST_COPIES / (1 + F.exp(-tilt * size / scale))


def balance(counts: DataFrame, wanted: DataFrame, tolerance: float = TOLERANCE, max_steps: int = MAX_STEPS) -> DataFrame:
    """Adds ``tilt`` and ``scale`` to ``wanted`` by Newton steps on (source_key, size, n).

    A source whose target is the most it can give has an infinite tilt (every document
    twice); one without words keeps 0.
    """
    spread = counts.groupBy("source_key").agg(
        (F.sum(F.col("n") * F.col("size").cast("double") * F.col("size")) / F.greatest(F.sum(F.col("n") * F.col("size")), F.lit(1))).alias("scale")
    )
    at_most = F.col("target") >= F.col("source_size") * MOST_COPIES * (1 - 1e-12)
    state = workers.stored(
        wanted.join(spread, "source_key").select(
            "source_key", "source_size", "target",
            F.round(F.greatest("scale", F.lit(1.0)), 6).alias("scale"),
            F.when((F.col("source_size") > 0) & at_most, F.lit(float("inf"))).otherwise(0.0).alias("tilt"),
            F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"),
            ((F.col("source_size") == 0) | at_most).alias("done"),
        )
    )
    for _ in range(max_steps):
        if state.where("not done").isEmpty():
            break
        rate = _rate(F.col("tilt"), F.col("size"), F.col("scale"))
        words = F.col("n") * F.col("size")
        sums = counts.join(state.where("not done"), "source_key").groupBy("source_key").agg(
            F.sum(words * rate).alias("got"),
            F.sum(words * F.col("size") / F.col("scale") * rate * (1 - rate / MOST_COPIES)).alias("slope"),
        )
        gap = F.col("got") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - gap / F.greatest("slope", F.lit(1e-300))
        middle = (
            F.when(F.col("low") == float("-inf"), F.least(2 * F.col("high"), F.col("high") - 1))
            .when(F.col("high") == float("inf"), F.greatest(2 * F.col("low"), F.col("low") + 1))
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        near = F.abs(gap) <= tolerance * F.col("target")
        moved = state.join(sums, "source_key", "left").withColumns({"low": low, "high": high})
        inside = (step > F.col("low")) & (step < F.col("high")) & (F.abs(step - F.col("tilt")) <= F.abs(F.col("tilt")) + 2)
        state = workers.stored(
            moved.select(
                "source_key", "source_size", "target", "scale",
                F.when(F.col("done") | near, F.col("tilt")).when(inside, step).otherwise(middle).alias("tilt"),
                "low", "high", (F.col("done") | near).alias("done"),
            )
        )
    # the last digits depend on the order of summing; reruns should not
    return state.select("source_key", "source_size", "target", "scale", F.round("tilt", 6).alias("tilt"))


def _rounded(prefix: str = "") -> tuple[Column, Column, Column]:
    """Whole copies of a rate, whether one more is possible, and the row's place in the order of getting it."""
    tilt, size, scale, spot = (F.col(f"{prefix}{c}") for c in ("tilt", "size", "scale", "spot"))
    rate = F.when(tilt == float("inf"), F.lit(float(MOST_COPIES))).otherwise(_rate(tilt, size, scale))
    whole = F.floor(rate)
    place = F.floor((spot - (rate - whole) + 1) * (1 << 2 * BITS - 1)).cast("long")
    return whole, whole < MOST_COPIES, place


def cuts(items: DataFrame, tilted: DataFrame) -> DataFrame:
    """Adds ``cut`` to the sources: rows whose place is below it get one copy more."""
    whole, more, place = _rounded()
    placed = items.join(workers.small_side(tilted), "source_key").select(
        "source_key", "size", "target", whole.alias("whole"), more.alias("more"), place.alias("place")
    )
    base = placed.groupBy("source_key").agg(F.first("target").alias("target"), F.sum(F.col("whole") * F.col("size")).alias("base"))
    ordered = "sum(words) OVER (PARTITION BY source_key ORDER BY bin) AS upto"
    # 4096 rows for a source at most, whatever its size
    coarse = placed.where("more").groupBy("source_key", F.shiftright("place", BITS).alias("bin")).agg(F.sum("size").alias("words"))
    missing = F.col("target") - F.col("base")
    edge = (
        coarse.selectExpr("source_key", "bin", "words", ordered)
        .join(base, "source_key")
        .where(F.col("upto") <= missing)
        .groupBy("source_key")
        .agg(F.max("bin").alias("bin"), F.max("upto").alias("below"))
    )
    edge = workers.stored(
        base.join(edge, "source_key", "left").select(
            "source_key", missing.alias("missing"), (F.coalesce("bin", F.lit(-1)) + 1).alias("bin"), F.coalesce("below", F.lit(0)).alias("below")
        )
    )
    inner = placed.where("more").join(workers.small_side(edge), "source_key").where(F.shiftright("place", BITS) == F.col("bin"))
    fine = inner.groupBy("source_key", F.col("place").alias("bin")).agg(F.sum("size").alias("words"))
    reached = (
        fine.selectExpr("source_key", "bin", "words", ordered)
        .join(edge.drop("bin"), "source_key")
        .select("source_key", (F.col("bin") + 1).alias("cut"), F.abs(F.col("below") + F.col("upto") - F.col("missing")).alias("error"))
    )
    start = edge.select("source_key", F.shiftleft("bin", BITS).alias("cut"), F.abs(F.col("below") - F.col("missing")).alias("error"))
    best = start.unionByName(reached).groupBy("source_key").agg(F.min(F.struct("error", "cut"))["cut"].alias("cut"))
    return workers.stored(tilted.join(best, "source_key"))


def solve(items: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(source_key, source_size, target, scale, tilt, cut): all it takes to tell any row's copies."""
    counts = workers.stored(items.groupBy("source_key", "size").agg(F.count("*").alias("n")))
    totals = counts.groupBy("source_key").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    return cuts(items, balance(counts, targets(totals, weights, share)))


def copies(prefix: str = "") -> Column:
    """Copies of a row that has its source's multipliers."""
    whole, more, place = _rounded(prefix)
    return (whole + (more & (place < F.col(f"{prefix}cut"))).cast("int")).cast("int")


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per input row: key, size, source_size, target, copies, taken.

    A null text has size 0.  Null sources are one source, the last.  Rows that repeat a
    key, source and size share out their copies evenly; a null key is a key like any other here.  An
    empty table gives no rows.  Other columns are not read.
    """
    items = workers.stored(sized(docs, key, text, source))
    solved = items.join(workers.small_side(solve(items, weights, share)), "source_key")
    return solved.select("key", "size", "source_size", "target", copies().alias("copies"), (copies() * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Each row as often as its copies say, with its columns as they are; texts move only if sources are too many to broadcast.

    Rows that repeat key, source and size are numbered by a digest of all their columns,
    equal rows counted before they move.
    """
    items = workers.stored(sized(docs, key, text, source))
    solved = solve(items, weights, share).select(*(F.col(c).alias(f"__mix_{c}") for c in ("source_key", "tilt", "scale", "cut")))
    again = workers.stored(items.groupBy("key", "source_key", "size").agg(F.count("*").alias("n")).where("n > 1"))
    again = workers.small_side(again.select(*(F.col(c).alias(f"__mix_{c}s") for c in ("key", "source_key", "size")), F.col("n").alias("__mix_all")))
    wide = docs.withColumns({"__mix_key": F.col(f"`{key}`"), "__mix_of": source_key(docs[source]), "__mix_size": workers.word_count(docs[text])})
    same = F.col("__mix_key").eqNullSafe(F.col("__mix_keys")) & (F.col("__mix_of") == F.col("__mix_source_keys")) & (F.col("__mix_size") == F.col("__mix_sizes"))
    wide = wide.join(again, same, "left").drop("__mix_keys", "__mix_source_keys", "__mix_sizes")
    once = wide.where(F.col("__mix_all").isNull()).withColumns({"__mix_all": F.lit(1).cast("long"), "__mix_nth": F.lit(0).cast("long")})
    columns = [f"`{c}`" for c in wide.columns]
    equal = wide.where(F.col("__mix_all").isNotNull()).groupBy(*columns).agg(F.count("*").alias("__mix_rows")).withColumn("__mix_digest", F.xxhash64(*columns))
    group = ["__mix_key", "__mix_of", "__mix_size"]
    placed = running(equal, group, ["__mix_digest"], None, {"__mix_upto": ("sum", F.col("__mix_rows"))})
    first = F.col("__mix_upto") - F.col("__mix_rows")
    placed = placed.withColumn("__mix_low", F.explode(F.sequence(first, F.col("__mix_upto") - 1, F.lit(RUN).cast("long"))))
    nth = F.explode(F.sequence(F.col("__mix_low"), F.least(F.col("__mix_low") + RUN, F.col("__mix_upto")) - 1))
    placed = placed.withColumn("__mix_nth", nth).select(*columns, "__mix_nth")
    spot = _spot(*map(F.col, (*group, "__mix_nth", "__mix_all")))
    joined = once.unionByName(placed).withColumn("__mix_spot", spot).join(workers.small_side(solved), F.col("__mix_of") == F.col("__mix_source_key"))
    repeated = joined.withColumn("__mix_n", F.explode(F.array_repeat(F.lit(0), copies("__mix_"))))
    return repeated.select(*(F.col(f"`{c}`") for c in docs.columns))
