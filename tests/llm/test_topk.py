import math
import random

import pytest
from pyspark.sql import functions as F

from duologue.llm import topk


def plain(vectors, queries, k):
    whole = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.setdefault(i, []).append([math.floor(1024 * x) for x in v])
    out = []
    for q in queries:
        if q in whole:
            mine = min(whole[q])
            scored = [(-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(mine, v, strict=True)))), i) for i, vs in whole.items() if i != q for v in vs if len(v) == len(mine)]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def found(spark, vectors, k=10, every=5, **kw):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors], "vec_id long, embedding array<double>, rank string, score int").repartition(3)
    got = topk.top_k(df, F.col("vec_id") % every == 0, k, **kw)
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("block", [3, 8192])
def test_against_all_pairs(spark, block):
    rng = random.Random(block)
    vectors = [(i, [rng.gauss(0, 1) for _ in range(24)]) for i in range(300)]
    vectors += [(300 + i, vectors[7][1]) for i in range(40)]  # ties
    assert found(spark, vectors, block=block) == plain(vectors, range(0, 340, 5), 10)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (0, [1.0, 2.0]), (0, [0.5, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]),
        (5, [inf, 1.0]), (6, [-1.0, 0.0005]), (None, [1.0, 1.0]), (7, [1.0, 2.0, 3.0]), (8, []), (10, []), (15, [1.0, 2.0, 3.0]),
        (20, [1e6, -1e6]), (25, [3e5, 1.0]), (30, [1e9, 1e9]), (35, [1e9, 3.0]),
    ]
    assert found(spark, vectors, 3) == plain(vectors, range(0, 40, 5), 3)
    assert found(spark, [], 3) == []
    assert found(spark, [(1, [1.0])], 3) == []


def test_bounds_are_bounds():
    rng = random.Random(1)
    import numpy as np

    a, b = (np.array([[rng.gauss(0, 9) for _ in range(21)] for _ in range(50)]) for _ in range(2))
    exact = a @ b.T
    for segments in (1, 4, 16, 40):
        assert (topk.statistics(a, segments) @ topk.statistics(b, segments).T >= exact - 1e-9).all()
