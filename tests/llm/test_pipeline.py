"""Every stage of the pipeline against plain Python on its own input."""

import numpy as np
import pytest

import corpus_pipeline
from duologue.llm import mixing, packing, pii, workers
from tests.llm import rows
from tests.llm.test_mixing import plain_targets
from tests.llm.test_repetition import brute
from tests.llm.test_simhash import plain_fingerprint, plain_groups

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The input and output of each stage, and the result."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = []
    for _, stage in corpus_pipeline.STAGES:
        out = workers.stored(stage(spark, docs, FOLDER))
        found.append((docs, out))
        docs = out
    return found


def test_schemas(spark, stages):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    assert all(out.schema == schema for _, out in stages[:-1])


def test_quality(stages):
    docs, out = stages[0]
    kept = {r.doc_id for r in out.collect()}
    failed = {r.doc_id for r in docs.collect() if brute(r.text or "")[-1]}
    assert failed and not kept & failed
    assert len(kept) > 0.8 * (docs.count() - len(failed))


def test_near_duplicates(stages):
    docs, out = stages[1]
    prints = {r.doc_id: plain_fingerprint(r.text or "") for r in docs.collect()}
    root = plain_groups(list(prints.values()))
    least = {}
    for i, f in prints.items():
        least[root[f]] = min(i, least.get(root[f], i))
    assert sorted(r.doc_id for r in out.collect()) == sorted(least.values()) and len(least) < len(prints)


def test_personal_data(stages):
    docs, out = stages[2]
    want = {r.doc_id: pii.mask(r.text) for r in docs.collect()}
    assert {r.doc_id: r.text for r in out.collect()} == want
    assert all(r.n_chars == len(r.text) for r in out.collect())
    assert any("<EMAIL>" in t for t in want.values())


def test_mixture(stages):
    docs, out = stages[3]
    size = lambda t: len((t or "").encode().split())
    sizes, taken, most = {}, {}, {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + size(r.text)
        most[r.source] = max(size(r.text), most.get(r.source, 0))
    for r in out.collect():
        taken[r.source] = taken.get(r.source, 0) + size(r.text)
    for s, t in plain_targets(sizes).items():
        assert abs(taken.get(s, 0) - t) <= most[s], s
    assert out.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= mixing.MOST_COPIES


def test_windows(stages):
    docs, out = stages[4]
    encode = packing.encoder().whole.encode
    want = sorted(encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs.collect())
    pieces = {}
    for r in out.collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert sum(r.length for x in pieces.values() for r in x) == sum(map(len, want))
    # copies of a document have equal pieces only by chance, so ids are compared as a whole
    got = np.sort(np.concatenate([r.ids for x in pieces.values() for r in x]))
    assert (got == np.sort(np.concatenate(want))).all()


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, FOLDER).count() == stages[-1][1].count()


def test_awkward_rows(spark):
    for start in (rows.nasty(spark).select("doc_id", "text", "lang", "source", "n_chars"), rows.empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, start, FOLDER).collect()
