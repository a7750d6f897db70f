import random
import zlib

import numpy as np
import pytest

from duologue.llm import packing
from tests.llm import rows

TEXTS = [
    "a  b\n\nc \n d\t\t e",
    "it's they'll 'x  's 12ab\u00b2 \u2167",
    " lead and trail  ",
    "\u00a0x\u2003y\x85z",
    "a\x1cb \x1f c",
    "end <|endoftext|> of",
    "",
    "\n",
    "   ",
    "é\u0301 ñ 日本語 \U0001f600\U0001f600 x",
    "tab\tthen space \t x",
    "$%& a,b;c!! ",
]


def test_ids_equal_the_tokenizers():
    rng = random.Random(4)
    made = ["".join(rng.choice(["a", " ", "  ", "\n", "'s", "é", "1", ".", "\t", "\r\n", "\u3000", "ab"]) for _ in range(60)) for _ in range(300)]
    encode = packing.encoder()
    for text in TEXTS + made:
        want = encode.whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode.ids(text), "<u4").tolist() == want, repr(text)


@pytest.mark.parametrize("seed", range(5))
def test_windows_are_full(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, 5, 60, 300, 1023, 1024, 1025, 5000, rng.randint(1, 3000)]) for _ in range(rng.randint(0, 80))]
    windows = packing.pack(lengths)
    sizes = [sum(p[2] for p in w) for w in windows]
    assert all(s & (s - 1) == 0 and 0 < s <= 1024 for s in sizes)  # no padding at all
    assert sum(s < 1024 for s in sizes) <= 10
    spans = {}
    for w in windows:
        for doc, start, length in w:
            assert length > 0
            spans.setdefault(doc, []).append((start, length))
    for doc, total in enumerate(lengths):
        at = 0
        for start, length in sorted(spans[doc]):
            assert start == at
            at += length
        assert at == total


def test_step_groups_are_even():
    windows = packing.pack([random.Random(1).randint(1, 900) for _ in range(900)])
    groups = packing.step_groups(windows)
    counts = np.bincount(groups)
    work = np.bincount(groups, [sum(n * n for _, _, n in w) for w in windows])
    assert counts.max() - counts.min() <= 1 and work.max() < 1.2 * work.min()


def test_every_token_in_one_piece(spark):
    docs = rows.nasty(spark)
    got = packing.packed(docs.where("doc_id <> 2 or doc_id is null"), with_ids=True).collect()
    want = {r.doc_id: packing.encoder().whole.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    assert {r.key for r in got} == {k for k in want if k != 2}
    for key, ids in want.items():
        if key == 2:
            continue
        at = 0
        for r in sorted((r for r in got if r.key == key), key=lambda r: r.start):
            part = ids[at : at + r.length]
            assert (r.start, list(r.ids), r.doc_tokens) == (at, part, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.packed(docs).where("key = 2").count() >= 2
    assert packing.packed(rows.empty(spark)).count() == 0
