import math
import zlib

import pytest
from pyspark.sql import functions as F

from duologue.llm import queries, suffix_counts, workers
from tests.llm import rows
from tests.llm.test_suffix_tree import plain, words

WHOLE = {"depth": 3, "frequent": 0.0, "share": 0.0, "entry": 0.0, "smoothing": 16.0}


@pytest.mark.parametrize("hot", [2, 1000, 10**9])
def test_against_plain_tree(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_counts, "HOT_SHARE", hot)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(60).collect()]
    texts += ["the cat sat on the mat " * 30, None, "", "unseen words only here", "the cat sat on"]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, row int, score string").repartition(3)
    trains = [zlib.crc32(str(i).encode()) % 7 != 2 for i in range(len(texts))]
    got = {r.key: r for r in suffix_counts.score(docs, workers.hash_remainder(F.col("doc_id"), 7) != 2).collect()}
    want, _ = plain(texts, trains, **WHOLE)
    for i, (known, base, points) in enumerate(want):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known) == (not trains[i], len(words(texts[i])), known)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(points, rel=1e-9)


def test_rare_contexts_stay_as_the_corpus_grows(spark, tmp_path):
    # a phrase seen eight times among 200,000 tokens is below 2^-13 of them
    other = [" ".join(f"w{(i * 7919 + j * j * 31) % 5003}" for j in range(400)) for i in range(500)]
    texts = other + ["zeta eta theta iota"] * 9
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op3_suffix_tree(spark, str(tmp_path)).where("doc_id >= 500").collect()
    assert all(r.score > r.base_score + 4 for r in got)
    trains = [zlib.crc32(str(i).encode()) % 7 != 2 for i in range(len(texts))]
    want, _ = plain(texts, trains, **WHOLE)
    assert all(r.score == pytest.approx(want[r.doc_id][2], rel=1e-9) for r in got)


def test_awkward_rows(spark):
    docs = rows.nasty(spark)
    got = suffix_counts.score(docs, workers.hash_remainder(F.col("doc_id"), 7) != 2).collect()
    assert len(got) == docs.count() and all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert {r.n_tokens for r in got if r.key in (3, 4, 5)} == {1}
    untrained = suffix_counts.score(docs, F.lit(False)).collect()
    assert all(r.train_tokens == r.n_known == 0 and r.base_score == r.score == 0 for r in untrained)
    assert suffix_counts.score(rows.empty(spark), F.lit(True)).count() == 0


@pytest.mark.parametrize("hot, top, group, part, positions", [(10**9, 0, 500, 100, 700), (10**9, 40, 10**9, 10**9, 10**9), (200, 300, 300, 200, 2000), (20, 0, 1000, 10, 300), (4, 1000, 2000, 10**9, 10**9)])
def test_groups_slices_hot_contexts(spark, monkeypatch, hot, top, group, part, positions):
    for name, value in (("HOT", hot), ("TOP", top), ("GROUP", group), ("SLICE", part), ("POSITIONS", positions)):
        monkeypatch.setattr(suffix_counts, name, value)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(40).collect()]
    texts += ["The cat  sat on the mat " * 30, None, "", "unseen words only here", "the cat sat on", "the cat sat on the mat"] * 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    trains = [zlib.crc32(str(i).encode()) % 7 != 2 for i in range(len(texts))]
    got = {r.key: r for r in suffix_counts.score(docs, workers.hash_remainder(F.col("doc_id"), 7) != 2).collect()}
    want, _ = plain(texts, trains, **WHOLE)
    for i, (known, base, points) in enumerate(want):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known) == (not trains[i], len(words(texts[i])), known)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(points, rel=1e-9)


def test_bytes_shuffled_for_a_token(spark):
    store = spark.sparkContext._jsc.sc().statusStore()
    first = max(store.lastStageAttempt(i).stageId() for i in _stages(spark))
    got = queries.op3_suffix_tree(spark, "/root/testdata/sf0.01").agg(F.sum("n_tokens"), F.count("score")).first()
    written = sum(store.lastStageAttempt(i).shuffleWriteBytes() for i in _stages(spark) if i > first)
    assert got[1] == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    # every token goes once to a group, with three words before it
    assert written < 18 * got[0]


def _stages(spark):
    """Numbers of all stages so far."""
    spark.range(10).repartition(2).count()
    tracker = spark.sparkContext.statusTracker()
    return [i for job in tracker.getJobIdsForGroup(None) for i in tracker.getJobInfo(job).stageIds if tracker.getStageInfo(i)]
