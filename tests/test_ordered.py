"""Block-wise prefixes equal plain ones, whatever the blocks and however hot a key is."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from duologue.operators import ordered, planning
from duologue.operators.ordered import block_of, number_by_text, number_rows, running, with_halo


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    # key 0 holds a third of all rows
    keys = [0] * 200 + [draw.randrange(1, 40) for _ in range(400)]
    return [(k, i, draw.randrange(-5, 9)) for i, k in enumerate(keys)]


@pytest.mark.parametrize("size", [1, 7, 64, 100000])
def test_running_matches_plain_prefix(spark, rows, size):
    df = spark.createDataFrame(rows, "k long, o long, x long").withColumn("b", block_of(F.col("o"), size))
    out = running(df, ["k"], ["o"], ["b"], {"s": ("sum", F.col("x")), "hi": ("max", F.col("x")), "lo": ("min", F.col("x"))})
    got = {(r.k, r.o): (r.s, r.hi, r.lo) for r in out.collect()}
    for key, group in itertools.groupby(sorted(rows), key=lambda r: r[0]):
        seen = []
        for _, o, x in group:
            seen.append(x)
            assert got[(key, o)] == (sum(seen), max(seen), min(seen))
    assert len(got) == len(rows)


@pytest.mark.parametrize("size", [1, 50])
def test_exclusive_running_and_numbers(spark, rows, size):
    df = spark.createDataFrame(rows, "k long, o long, x long").withColumn("b", block_of(F.col("o"), size))
    before = running(df, ["k"], ["o"], ["b"], {"s": ("sum", F.col("x"))}, inclusive=False)
    numbered = number_rows(before, ["k"], ["o"], ["b"])
    by_key = {}
    for r in sorted(numbered.collect(), key=lambda r: (r.k, r.o)):
        total, count = by_key.get(r.k, (0, 0))
        assert (r.s, r.pos) == (total, count + 1)
        by_key[r.k] = (total + r.x, count + 1)


@pytest.mark.parametrize("before,after", [(1, 1), (2, 0), (0, 2)])
def test_halo_shows_true_neighbours(spark, before, after):
    from pyspark.sql import Window

    df = spark.range(1, 30).select(F.lit(1).alias("k"), F.col("id").alias("pos"))
    blocks = with_halo(df, "pos", 4, before=before, after=after)
    w = Window.partitionBy("k", "_block").orderBy("pos")
    seen = blocks.select(
        "*", F.lag("pos", max(before, 1)).over(w).alias("p"), F.lead("pos", max(after, 1)).over(w).alias("n")
    ).where("_own")
    got = {r.pos: (r.p, r.n) for r in seen.collect()}
    assert len(got) == 29
    for pos, (p, n) in got.items():
        if before:
            assert p == (pos - before if pos > before else None)
        if after:
            assert n == (pos + after if pos + after <= 29 else None)


def test_text_numbering_with_common_and_early_different_heads(spark):
    draw = random.Random(4)
    names = {f"spk_{draw.randrange(16**6):06x}" for _ in range(300)} | {"", "s", "spk", "spk_", "zz", "a\u0100", "\u00e9t\u00e9"}
    df = spark.createDataFrame([(len(n) % 2, n) for n in names], "k int, name string")
    names |= {"unknown_spk_" + "x" * 50 + str(i) for i in range(100)}
    df = spark.createDataFrame([(len(n) % 2, n) for n in names], "k int, name string")
    for parts in (1, 7):
        got = {(r.k, r.name): r.no for r in number_by_text(df.repartition(parts), ["k"], "name", "no").collect()}
        for key in (0, 1):
            ordered = sorted((n for n in names if len(n) % 2 == key), key=lambda n: n.encode())
            assert [got[(key, n)] for n in ordered] == list(range(1, len(ordered) + 1))


@pytest.fixture
def dense_sample(monkeypatch):
    """Splits already at small sizes: every row is looked at, and 16 of a key are enough."""
    monkeypatch.setattr(ordered, "SAMPLE", 1.0)
    monkeypatch.setattr(ordered, "SPLIT_ROWS", 16)
    monkeypatch.setattr(ordered, "SPLIT_BITS", 3)


def outcomes(spark):
    """One instance has half of all rows, all in one month; ties in time are broken by number."""
    draw = random.Random(9)
    rows = [(0 if i % 2 else draw.choice([None, *range(1, 30)]), 100 + i // 7, i, draw.random() < 0.3, "x") for i in range(900)]
    draw.shuffle(rows)
    return rows, spark.createDataFrame(rows, "corpus_combination_id long, at long, n long, accepted boolean, _rows string").repartition(3)


def test_hot_keys_are_split_by_a_sample(spark, dense_sample):
    rows, df = outcomes(spark)
    parts = ordered.with_parts(df, ["corpus_combination_id"], ["at", "n"]).collect()
    hot = {}
    for r in parts:
        if r.corpus_combination_id == 0:
            hot.setdefault(r._part, []).append((r.at, r.n))
    assert len(hot) >= 6 and max(map(len, hot.values())) < 250  # 450 rows over 8 parts
    ends = [(min(hot[p]), max(hot[p])) for p in sorted(hot)]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    assert len(parts) == len(rows)


@pytest.mark.parametrize("keys", [["corpus_combination_id"], []])
@pytest.mark.parametrize("inclusive", [True, False])
def test_parts_change_nothing(spark, dense_sample, keys, inclusive):
    rows, df = outcomes(spark)
    spec = {"s": ("sum", F.col("n")), "hi": ("max", F.when(F.col("accepted"), F.col("n")))}
    got = {r.n: (r.s, r.hi) for r in ordered.running(df, keys, ["at", "n"], None, spec, inclusive=inclusive).collect()}
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (str(r[0]) if keys else "", r[1], r[2])), key=lambda r: str(r[0]) if keys else ""):
        total, high = 0, None
        for _, _, n, accepted, _ in group:
            before = (total, high)
            total, high = total + n, n if accepted else high
            if accepted and before[1] is not None:
                high = max(before[1], n)
            want = (total, high) if inclusive else before
            assert got[n] == want
    assert len(got) == len(rows)


def test_failure_runs_over_parts(spark, dense_sample):
    rows, df = outcomes(spark)
    got = {r.n: (r.attempt_no, r.consecutive_failures) for r in planning.failure_runs(df, ["at", "n"]).collect()}
    state = {}
    for key, _, n, accepted, _ in sorted(rows, key=lambda r: (r[1], r[2])):
        number, run = state.get(key, (0, 0))
        state[key] = (number + 1, 0 if accepted else run + 1)
        assert got[n] == state[key]


def test_a_part_is_a_task_of_its_own(spark, dense_sample):
    """No window sees all rows of a split key, and what is broadcast has a row for each part of the split keys."""
    _, df = outcomes(spark)
    parted = ordered.with_parts(df, ["corpus_combination_id"], ["at", "n"])
    points = ordered.split_points(df, ["corpus_combination_id"], ["at", "n"]).collect()
    assert 0 < len(points) <= ordered.SPLIT_KEYS and all(len(p._splits) < 1 << ordered.SPLIT_BITS for p in points)
    state = parted.where("_part is not null").groupBy("corpus_combination_id", "_part").count()
    assert state.count() <= len(points) << ordered.SPLIT_BITS
