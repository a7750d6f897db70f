from pyspark.sql import functions as F

from duologue.llm import language, workers
from tests.llm import rows


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = workers.hash_remainder(F.col("doc_id"), 4) == 2
    model = language.train(docs.where(~held), F.col("lang"), F.col("text"))
    found = language.predict(docs.where(held), model).join(docs.select("doc_id", "lang"), F.col("key") == F.col("doc_id"))
    right, n = found.selectExpr("avg(cast(lang = lang_pred AS int))", "count(*)").first()
    assert n > 100 and right > 0.98


def test_scores_against_plain_python(spark):
    texts = [("en", "the cat"), ("de", "die katze ß"), ("en", "a thing"), (None, "not used"), ("fr", None)]
    docs = spark.createDataFrame([(i, t, n) for i, (n, t) in enumerate(texts)], "doc_id long, text string, lang string")
    model = language.train(docs, F.col("lang"), F.col("text"), buckets=1 << 12)
    assert model.languages == ["de", "en"]
    import math

    import numpy as np

    def grams(text):
        out = []
        for hashed, _ in language.ngram_buckets([text], 1 << 12):
            out += hashed.tolist()
        return out

    counts = {n: np.full(1 << 12, language.SMOOTHING) for n in model.languages}
    for n, t in texts:
        if n in counts and t:
            for g in grams(t):
                counts[n][g] += 1
    probe = "the die"
    points = [math.log(p) + sum(math.log(c[g] / c.sum()) for g in grams(probe)) for p, c in zip((1 / 3, 2 / 3), counts.values(), strict=True)]
    odds = [math.exp(x - max(points)) for x in points]
    names, best = language.predict_texts(model, [probe])
    assert names == [model.languages[odds.index(1.0)]] and abs(best[0] - 1 / sum(odds)) < 1e-4
    # a document's n-grams don't depend on its neighbours
    many = language.predict_texts(model, ["x", probe, "", probe + " y"])
    assert many[0][1] == names[0] and abs(many[1][1] - best[0]) < 1e-6


def test_awkward_rows(spark):
    docs = rows.nasty(spark)
    model = language.train(docs, F.col("lang"), F.col("text"))
    got = language.predict(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    named = {r.key: r.lang_pred for r in got}
    assert all(named[k] == "und" for k in (3, 4, 5, 8)) and named[9] != "und"
    nothing = language.train(rows.empty(spark), F.col("lang"), F.col("text"))
    assert {(r.lang_pred, r.score) for r in language.predict(docs, nothing).collect()} == {("und", 0.0)}
    assert language.predict(rows.empty(spark), model).count() == 0


def test_too_many_languages(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(language, "MAX_LANGUAGES", 2)
    docs = spark.createDataFrame([(str(i), "text") for i in range(3)], "lang string, text string")
    with pytest.raises(ValueError):
        language.train(docs, F.col("lang"), F.col("text"))
