import random
import re
from collections import Counter, defaultdict

import pytest

from duologue.llm import collocations
from tests.llm import rows


def plain(docs, order=3, least=10, inside=50, top=2000):
    counts = defaultdict(Counter)
    for lang, text in docs:
        lang = "und" if lang is None else lang
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", folded):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            for n in range(1, order + 1):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for p, a in candidates.items():
            for x in {p[i:j] for i in range(len(p)) for j in range(i + 2, len(p) + 1)} - {p}:
                longest[x] = max(longest[x], a)
        found = []
        for p, a in candidates.items():
            if longest[p] * 100 >= inside * a:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def prose(seed, words, vocabulary=12):
    rng = random.Random(seed)
    return "".join(rng.choice("abcdefghijkl"[:vocabulary]) * rng.randint(1, 2) + rng.choice([" ", " ", "  ", "\t", ". ", ",", " \n", "\x0b", "! "]) for _ in range(words))


def run(spark, docs, **options):
    df = spark.createDataFrame([(i, lang, text, "x", 1) for i, (lang, text) in enumerate(docs)], "doc_id long, lang string, text string, rest string, c int")
    return sorted(tuple(r) for r in collocations.collocations(df.repartition(3), **options).collect())


@pytest.mark.parametrize("order, least", [(2, 3), (3, 2), (3, 10), (4, 3)])
def test_equals_plain_python(spark, order, least):
    docs = [(random.Random(s).choice(["en", "de", None, ""]), prose(s, 150)) for s in range(12)]
    assert run(spark, docs, order=order, least=least) == plain(docs, order, least)


def test_ties_and_limit(spark):
    docs = [("en", "a b. c d. e f. a b. c d. e f.")] * 3
    got = run(spark, docs, least=2, top=2)
    assert got == plain(docs, 3, 2, top=2) and [r[2] for r in got] == ["a b", "c d"]


def test_long_text_in_parts(spark, monkeypatch):
    docs = [("en", prose(1, 4000)), (None, prose(2, 50)), ("en", "z" * 5000 + " y"), ("de", prose(3, 900))]
    want = plain(docs, 3, 4)
    windows = collocations.Windows(3, {"en": [(b"a",), (b"b", b"c"), (b"a", b"b")]})
    windows.chunk = 64
    monkeypatch.setattr(collocations, "FLUSH_WORDS", 37)
    monkeypatch.setattr(collocations, "OUT_ROWS", 7)
    counts = defaultdict(Counter)
    where = {}
    batches = []
    for lang, text in docs:
        batches += windows.add(lang or "und", text.encode())
    batches += windows.flush()
    for b in batches:
        for r in b.to_pylist():
            window = (r["first"], *r["rest"].split())
            assert where.setdefault((r["lang"], window), r["salt"]) == r["salt"]
            counts[r["lang"]][window] += r["c"]
    for lang, n in {(r[0], r[6]) for r in want}:
        assert sum(counts[lang].values()) == n
    for lang, _, phrase, a, *_ in want:
        p = tuple(phrase.split())
        assert sum(c for w, c in counts[lang].items() if w[: len(p)] == p) == a


def test_spread_leads_change_nothing(spark, monkeypatch):
    docs = [("en", "the of " + prose(s, 3)) for s in range(40)] + [("en", prose(s, 60)) for s in range(4)]
    monkeypatch.setattr(collocations, "hot_leads", lambda sample: [("en", "the"), ("en", "the", "of"), ("en", "a", "b"), ("de", "b")])
    assert run(spark, docs, least=3) == plain(docs, 3, 3)


def test_nasty_rows(spark):
    df = rows.nasty(spark)
    want = plain([(r.lang, r.text) for r in df.collect()])
    assert sorted(tuple(r) for r in collocations.collocations(df).collect()) == want and want


def test_empty(spark):
    assert collocations.collocations(rows.empty(spark)).count() == 0
