"""Spans of all lengths meet as all pairs do, and a long one lies in few buckets."""

import random

import pytest

from duologue.operators import overlap

SCHEMA = "conv_id long, pos long, turn_id string, speaker string, planned_start_sec double, planned_end_sec double"


def spans(seed, n=60):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        start = rng.choice([rng.uniform(-50, 400), rng.uniform(0, 10_000), 160.0 * rng.randint(0, 9)])
        length = rng.choice([0.0, 0.01, rng.uniform(0, 9), 10.0, 160.0, rng.uniform(10, 3000), 1e7 if i == 7 else 5.0])
        out.append((i % 3, i, f"t{i}", rng.choice(["a", "b"]), start, start + length))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_equals_all_pairs(spark, seed):
    rows = spans(seed)
    want = []
    for i, x in enumerate(rows):
        for y in rows[i + 1 :]:
            if x[0] == y[0] and x[3] != y[3] and min(x[5], y[5]) > max(x[4], y[4]) and x[5] > x[4] and y[5] > y[4]:
                want.append((x[0], x[2], y[2]))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [(r.conv_id, r.turn_a, r.turn_b) for r in overlap.simultaneous_speech(df).collect()]
    assert sorted(got) == sorted(want)


def test_a_span_of_months_lies_in_few_buckets(spark):
    rows = [(1, 0, "long", "a", 0.0, 1e7)] + [(1, i, f"t{i}", "b", i * 1e5, i * 1e5 + 3) for i in range(1, 40)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert overlap.simultaneous_speech(df).count() == 39
    visits, _ = overlap.bucket_visits(df, ["conv_id"], 10.0)
    assert max(r["count"] for r in visits.groupBy("turn_id").count().collect()) <= 2 * overlap.LEVELS


def test_empty(spark):
    assert overlap.simultaneous_speech(spark.createDataFrame([], SCHEMA)).count() == 0
