import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from duologue.llm import suffix_tree, workers
from tests.llm import rows


def words(text):
    return (text or "").encode().lower().split() + [suffix_tree.END]


def plain(texts, trains, depth, frequent, share, entry, smoothing):
    """The same tree and scores with dictionaries; texts in, (n_known, base, score) out."""
    docs = [words(t) for t in texts]
    trained = Counter(w for d, t in zip(docs, trains, strict=True) if t for w in d)
    total = Counter(w for d in docs for w in d)
    n, v = sum(trained.values()), len(trained)
    below = n + v + 1
    own = {w for w, c in total.items() if (c >= frequent * sum(total.values()) or w == suffix_tree.END) and trained[w]}
    symbol = lambda w: w if w in own else None
    root = {w: (trained[w] + 1) / below for w in own}
    root[None] = 1 - sum(root.values())
    lines = [[symbol(suffix_tree.END)] * depth + [symbol(w) for w in d] for d in docs]
    kept = {}

    def chance(context, x):
        while context and context not in kept:
            context = context[1:]
        if not context:
            return root[x]
        c, entries = kept[context]
        rest = c - sum(entries.values()) + smoothing
        return (entries.get(x, 0) + rest * chance(context[1:], x)) / (c + smoothing)

    raw = {s: root[s] * below - 1 for s in root}
    tried = [(s,) for s in root if raw[s] >= max(1, share * n) - 1e-9]
    for level in range(1, depth + 1):
        follows, older = {c: Counter() for c in tried}, Counter()
        for line, t in zip(lines, trains, strict=True):
            for i in range(depth, len(line) if t else 0):
                context = tuple(line[i - level : i])
                if context in follows:
                    follows[context][line[i]] += 1
                    if level < depth:
                        older[tuple(line[i - level - 1 : i])] += 1
        new = {}
        for context, counts in follows.items():
            c = sum(counts.values())
            suffix = {x: chance(context[1:], x) for x in counts}
            gain = sum(k * math.log((k - 1 + smoothing * suffix[x]) / ((c - 1 + smoothing) * suffix[x])) for x, k in counts.items())
            if c and gain > 0:
                new[context] = (c, {x: k for x, k in counts.items() if k >= entry * n})
        kept |= new
        tried = [c for c, k in older.items() if k >= max(1, share * n)]
    out = []
    for d, line in zip(docs, lines, strict=True):
        base = [math.log10((trained[w] + 1) / below) for w in d]
        points = 0.0
        for i, w in enumerate(d):
            x = symbol(w)
            points += math.log10(chance(tuple(line[i : i + depth]), x)) + (base[i] - math.log10(root[x]) if x is None else 0)
        out.append((sum(trained[w] > 0 for w in d), sum(base), points))
    return out, len(kept)


@pytest.mark.parametrize("frequent, share, entry", [(2**-18, 2**-13, 2**-21), (0.01, 0.02, 0.0), (0.004, 0.004, 0.001)])
def test_against_plain_tree(spark, frequent, share, entry):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(60).collect()]
    texts += ["the cat sat on the mat " * 30, None, "", "unseen words only here", "the cat sat on"]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, row int, score string").repartition(3)
    trains = [zlib.crc32(str(i).encode()) % 7 != 2 for i in range(len(texts))]
    options = {"depth": 3, "frequent": frequent, "share": share, "entry": entry, "smoothing": 16.0}
    got = {r.key: r for r in suffix_tree.score(docs, workers.hash_remainder(F.col("doc_id"), 7) != 2, **options).collect()}
    want, contexts = plain(texts, trains, **options)
    assert contexts > 3
    for i, (known, base, points) in enumerate(want):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known) == (not trains[i], len(words(texts[i])), known)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(points, rel=1e-9)


def test_probabilities_add_up(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").withColumn("trains", F.lit(True))
    model, _ = suffix_tree.train(docs.select("trains", "text"), frequent=0.001, share=0.003, entry=0.0005)
    states = np.unique(model.state)
    assert len(states) > 5
    every = np.arange(model.symbols)
    for s in states:
        assert model.probability(np.full(model.symbols, s), every).sum() == pytest.approx(1)


def test_held_out_texts_score_better_than_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scored = suffix_tree.score(docs, workers.hash_remainder(F.col("doc_id"), 7) != 2).where("held_out")
    base, score = scored.selectExpr("sum(base_score)", "sum(score)").first()
    assert score > base


def test_awkward_rows(spark):
    docs = rows.nasty(spark)
    got = suffix_tree.score(docs, workers.hash_remainder(F.col("doc_id"), 7) != 2).collect()
    assert len(got) == docs.count() and all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert {r.n_tokens for r in got if r.key in (3, 4, 5)} == {1}
    untrained = suffix_tree.score(docs, F.lit(False)).collect()
    assert all(r.train_tokens == r.n_known == 0 and r.base_score == r.score == 0 for r in untrained)
    assert suffix_tree.score(rows.empty(spark), F.lit(True)).count() == 0
