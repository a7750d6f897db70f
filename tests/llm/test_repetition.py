import random
import re
from collections import Counter

from duologue.llm import repetition
from tests.llm import rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


def test_counts_against_plain_python(spark):
    rng = random.Random(1)
    texts = []
    for _ in range(300):
        parts = [" ".join(rng.choice("ab cé #d".split()) for _ in range(rng.randint(0, 30))) for _ in range(3)]
        texts.append(rng.choice("\n \t").join(rng.choice(parts) for _ in range(rng.randint(0, 6))) + rng.choice(["", "\n", "\x0b", "\u00a0", "\x1c"]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.key: r for r in repetition.judge(docs).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t), t
        assert not (r.kept and r.base_failed)


def test_passes_do_not_change_results(spark, monkeypatch):
    docs = rows.nasty(spark)
    texts = [(r.text or "").encode() for r in docs.collect()]
    whole = repetition._judge(texts, repetition.Rules())
    monkeypatch.setattr(repetition, "PASS_BYTES", 1)
    assert all(a.equals(b) for a, b in zip(whole, repetition._judge(texts, repetition.Rules()), strict=True))


def test_verdicts(spark):
    good = rows.prose(5, 400)
    line = "this same line comes again and again\n"
    cases = [
        (1, good, True),
        (2, "word " * 19, False),
        (3, line * 30, False),
        (4, " ".join(f"w{i} $$$" for i in range(100)), False),
        (5, " ".join(f"w{i // 5}" for i in range(200)), False),
        (6, None, False),
        (7, "", False),
        (8, good + "\n" + good[:60], True),
    ]
    docs = spark.createDataFrame([c[:2] for c in cases], "doc_id long, text string")
    assert {r.key: r.kept for r in repetition.judge(docs).collect()} == {c[0]: c[2] for c in cases}
    assert sorted(r.doc_id for r in repetition.keep_good(docs).collect()) == [1, 8]


def test_awkward_rows(spark):
    docs = rows.nasty(spark)
    got = repetition.judge(docs)
    assert got.count() == docs.count() and got.where("key is null").count() == 1
    kept = repetition.keep_good(docs)
    assert kept.schema == docs.schema
    assert kept.count() == got.where("kept").count()
    assert repetition.judge(rows.empty(spark)).count() == repetition.keep_good(rows.empty(spark)).count() == 0
