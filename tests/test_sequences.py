"""Rows off a longest ascending run, against plain patience; distances against the whole table."""

import random

import pytest
from pyspark.sql import functions as F

from duologue.operators import sequences


def moved(pairs):
    """By the definition: lengths of chains, then from the last end back through the last predecessors."""
    pairs = sorted(pairs)
    length = []
    for i, (_, b) in enumerate(pairs):
        length.append(1 + max((length[j] for j in range(i) if pairs[j][1] < b), default=0))
    kept, n, below = set(), max(length, default=0), float("inf")
    for i in range(len(pairs) - 1, -1, -1):
        if length[i] == n and pairs[i][1] < below:
            kept.add(pairs[i][0])
            n, below = n - 1, pairs[i][1]
    return {a for a, _ in pairs} - kept


def shuffled(rng, n):
    """Numbers with blocks moved about, gaps in both orders."""
    lines = sorted(rng.sample(range(2 * n), n)) if rng.random() < 0.5 else list(range(n))
    turns = list(range(n))
    for _ in range(rng.randint(0, 6)):
        at, size, to = rng.randrange(n + 1), rng.randint(1, 4), rng.randrange(n + 1)
        block = turns[at : at + size]
        del turns[at : at + size]
        turns[to:to] = block
    if rng.random() < 0.3:
        rng.shuffle(turns)
    wide = rng.choice([1, 3])
    return [(a, b * wide) for a, b in zip(lines, turns)]


@pytest.mark.parametrize("parts", [1, 5])
def test_moved_rows(spark, parts):
    rng = random.Random(parts)
    made = {k: shuffled(rng, rng.choice([1, 2, 7, 30, 90])) for k in [None, *range(25)]}
    data = [(k, a, b, "x") for k, pairs in made.items() for a, b in pairs]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "conv_id long, line long, turn long, key string").repartition(parts)
    got = {}
    for r in sequences.moved_rows(df, "conv_id", "line", "turn", chunk=3).collect():
        got.setdefault(r.conv_id, []).append(r.line)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in ((k, moved(p)) for k, p in made.items()) if v}


def test_a_long_conversation_in_order_is_a_few_stretches(spark):
    """A hundred thousand rows, one block moved: the search sees stretches of tasks, not rows."""
    n = 100_000
    turn = F.when(F.col("id").between(500, 509), F.col("id") + n).otherwise(F.col("id"))
    df = spark.range(n, numPartitions=6).select(F.lit(1).alias("k"), F.col("id").alias("line"), turn.alias("turn"))
    assert sorted(r.line for r in sequences.moved_rows(df, "k", "line", "turn").collect()) == list(range(500, 510))


def test_empty(spark):
    assert sequences.moved_rows(spark.createDataFrame([], "k string, a int, b int"), "k", "a", "b").count() == 0


def test_edit_distance(spark):
    rng = random.Random(2)
    pairs = [("", ""), ("a", ""), ("kitten", "sitting"), ("x" * 6000, "y" * 5500), ("ab" * 3000, "ba" * 3000)]
    for n in (5, 40, 300):
        text = "".join(rng.choice("abcd") for _ in range(n))
        other = [c for c in text if rng.random() > 0.2]
        pairs.append((text, "".join(other)))

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = [r.d for r in df.select("i", sequences.edit_distance(F.col("a"), F.col("b")).alias("d")).orderBy("i").collect()]
    assert got[:3] == [0, 1, 3] and got[3] == 6000 and got[4] == 2
    assert got[5:] == [plain(*p) for p in pairs[5:]]
