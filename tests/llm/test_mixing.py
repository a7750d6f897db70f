import pytest

from duologue.llm import mixing
from tests.llm import rows


def plain_targets(sizes, weights=(5, 2, 1), share=1.5):
    """sizes: source -> words, null last."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        open_ = sum(weight[s] for s in sizes if s not in full)
        over = {s for s in sizes if s not in full and left * weight[s] / open_ > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in full else left * weight[s] / open_ for s in sizes}
        full |= over


def documents(spark, n=900):
    sources = ["a", "b", "B", "é", "\U0001f600", "\uffee", None, "zz"]
    table = [(i, rows.prose(i, 5 + i * 37 % 200 + (3000 if i == 17 else 0)), sources[min(i % 13, 7)]) for i in range(n)]
    return spark.createDataFrame([(*r, 1.0, "x") for r in table], "doc_id long, text string, source string, size double, tilt string")


def test_targets_and_totals(spark):
    docs = documents(spark)
    got = mixing.plan(docs).join(docs.select("doc_id", "source"), mixing.F.col("key") == mixing.F.col("doc_id")).collect()
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert r.taken in (0, r.size, 2 * r.size) and r.taken == r.copies * r.size
    want = plain_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9)
    for s, t in want.items():
        assert taken[s] == pytest.approx(t, abs=250), s


def test_reruns_and_partitions_agree(spark):
    docs = documents(spark, 300)
    runs = [sorted((r.key, r.copies) for r in mixing.plan(d).collect()) for d in (docs, docs.repartition(9), docs.coalesce(1))]
    assert runs[0] == runs[1] == runs[2]


def test_mix_follows_the_plan(spark):
    docs = rows.nasty(spark)
    copies = {}
    for r in mixing.plan(docs).collect():
        copies[r.key] = copies.get(r.key, 0) + r.copies
    mixed = mixing.mix(docs)
    assert mixed.schema == docs.schema
    got = {}
    for r in mixed.select("doc_id").collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: n for k, n in copies.items() if n}


def test_awkward_rows(spark):
    docs = rows.nasty(spark)
    plan = mixing.plan(docs)
    assert plan.count() == docs.count()
    assert plan.where("key in (3, 4, 5)").selectExpr("sum(size) + sum(taken)").first()[0] == 0
    assert mixing.plan(rows.empty(spark)).count() == mixing.mix(rows.empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", "s")], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.plan(blank).collect()] == [(0, 0.0, 0)] * 2


def test_repeated_rows_meet_their_target(spark, monkeypatch):
    """A thousand rows without an id, equal or of equal size, next to sources of distinct rows."""
    monkeypatch.setattr(mixing, "RUN", 64)
    texts = ["a b c d e f g h i j", "k l m n o p q r s t"]
    data = [(None, texts[i % 3 == 0], "en", "b", i % 2) for i in range(1000)] + [(i, rows.prose(i, 30), "en", "a" if i % 2 else None, 0) for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, spot int").repartition(3)
    plan = mixing.plan(docs)
    got = plan.where("key is null").selectExpr("max(target) as target", "sum(taken) as taken", "count(*) as n").first()
    assert got.n == 1000 and abs(got.taken - got.target) <= 40 and 0 < got.target
    mixed = mixing.mix(docs)
    assert mixed.schema == docs.schema
    assert mixed.where("doc_id is null").count() * 10 == got.taken
    kinds = {r.text: r["count"] for r in mixed.where("doc_id is null").groupBy("text").count().collect()}
    assert set(kinds) == set(texts)
    counts = [{r.source: r["count"] for r in m.groupBy("source").count().collect()} for m in (mixed, mixing.mix(docs.repartition(5)))]
    assert counts[0] == counts[1]
