import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from duologue.llm import pii
from tests.llm import rows

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def passes(kind, s):
    digits = re.sub("[^0-9]", "", s)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in s.split(".")),
        "card": lambda: 14 <= len(digits) <= 19 and plain_luhn(digits),
        "phone": lambda: 10 <= len(digits) <= 15,
    }[kind]()


def brute(text):
    found = [(m.start(), list(BASE).index(k), k, m.end()) for k, p in BASE.items() for m in re.finditer(p, text) if passes(k, m.group())]
    return [(k, s, e) for s, _, k, e in sorted(found)]


PIECES = st.sampled_from(["a@b.c", "@", ".", "-", " ", "+", "1", "42", "255", "256", "4111111111111111", "4111 1111-1111 1111", "+1 (234) 567-8901", "x", "é", "10.0.0.1", "a.b", "(", "_"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=25).map("".join))
def test_base_spans_against_plain_patterns(text):
    assert [x[:3] for x in pii.find(text) if x[0] in BASE] == brute(text)


def test_every_document(spark):
    got = pii.find_spans(rows.nasty(spark)).collect()
    want = rows.nasty(spark).select("doc_id", "text").collect()
    assert len(got) == len(want)
    for g in got:
        texts = {w.text or "" for w in want if w.doc_id == g.key}
        assert any([(s.kind, s.start, s.end) for s in g.spans] == brute(t) for t in texts if len(t) < 50_000) or max(map(len, texts)) >= 50_000


@pytest.mark.parametrize("text", ["1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" + " " * 300_000, "A1" * 150_000, "@" * 300_000, "-" * 300_000])
def test_time_is_linear(text):
    begin = time.time()
    pii.find(text)
    assert time.time() - begin < 5


def test_checksums_and_context():
    assert [x[0] for x in pii.find("IBAN GB82 WEST 1234 5698 7654 32 end")] == ["iban"]
    assert pii.find("IBAN GB82 WEST 1234 5698 7654 33 end") == []
    assert pii.find("part 123-45-6789 of it") == []
    assert [x[:3] for x in pii.find("my SSN: 123-45-6789.")] == [("national_id", 8, 19)]
    near, far = pii.find("card 4111111111111111")[0], pii.find("4111111111111111")[0]
    assert near[3] > far[3]


def test_masking(spark):
    assert pii.mask("write to a.b@c.de, now") == "write to <EMAIL>, now"
    assert pii.mask("nothing here") == "nothing here"
    docs = rows.nasty(spark)
    out = pii.mask_documents(docs)
    assert out.schema == docs.schema and out.count() == docs.count()
    assert out.where("doc_id = 3").first().text is None
    one = spark.createDataFrame([(1, "x +1 (234) 567-8901 é", 21)], "doc_id long, text string, n_chars int")
    r = pii.mask_documents(one).first()
    assert (r.text, r.n_chars) == ("x <PHONE> é", 11)
    assert pii.find_spans(rows.empty(spark)).count() == 0


def test_capitals_behind_an_iban():
    for text in ("BE68 5390 0754 7034 THE", "pay BE68539007547034 THE", "BE68 5390 0754 7034 the", "DE89 3704 0044 0532 0130 00 AND NOW", "BE68 5390 0754 7034 BE68 5390 0754 7034"):
        spans = [text[s:e] for k, s, e, _ in pii.find(text) if k == "iban"]
        assert spans and all(x.replace(" ", "") in ("BE68539007547034", "DE89370400440532013000") for x in spans), text
    assert not [x for x in pii.find("BE68 5390 0754 7034ABC and BE69 5390 0754 7034") if x[0] == "iban"]


def test_context_is_whole_words():
    assert pii.score("ip", "the ship 1.2.3.4 sails", 9, 16) == pii.PRIOR["ip"]
    assert pii.score("ip", "the host 1.2.3.4 answers", 9, 16) > pii.PRIOR["ip"]
