import random
import zlib
from functools import cache

import numpy as np
import pytest

from duologue.llm import packing, window_packing
from tests.llm import rows


def histogram(pieces, window):
    return np.bincount(pieces, minlength=window)


def fewest(pieces, window):
    """The least number of windows, by trying every subset."""
    n = len(pieces)
    weight = [sum(p for i, p in enumerate(pieces) if m >> i & 1) for m in range(1 << n)]

    @cache
    def best(left):
        if not left:
            return 0
        low = left & -left
        out, sub = n, left
        while sub:
            if sub & low and weight[sub] <= window:
                out = min(out, 1 + best(left ^ sub))
            sub = (sub - 1) & left
        return out

    return best((1 << n) - 1)


@pytest.mark.parametrize("seed", range(12))
def test_few_windows(seed):
    rng = random.Random(seed)
    window = rng.choice([16, 40, 64])
    pieces = [rng.randint(1, window - 1) for _ in range(rng.randint(0, 9))]
    bins = window_packing.solve(histogram(pieces, window), window)
    assert sorted(x for n, b in bins for x in b * n) == sorted(pieces)
    assert all(sum(b) <= window for _, b in bins)
    assert window_packing.windows(bins) <= fewest(pieces, window) + 1


def test_bound_is_no_more_than_the_fewest():
    rng = random.Random(3)
    for _ in range(20):
        pieces = [rng.randint(1, 31) for _ in range(8)]
        _, bound = window_packing.program(histogram(pieces, 32), 32, 1.3)
        assert bound <= fewest(pieces, 32) + 1e-9


def test_near_the_bound_on_many_pieces():
    rng = np.random.default_rng(1)
    pieces = np.minimum(2047, 1 + rng.exponential(600, 20_000).astype(int))
    counts = histogram(pieces, 2048)
    bins = window_packing.solve(counts)
    got = np.zeros(2048, int)
    for n, config in bins:
        assert sum(config) <= 2048
        np.add.at(got, config, n)
    assert (got == counts).all()
    assert window_packing.windows(bins) <= -(-int(counts @ np.arange(2048)) // 2048) + 1


def test_a_length_with_a_third_of_all_pieces_takes_many_windows_of_few_configurations():
    counts = np.zeros(2048, np.int64)
    counts[512] = 10**9
    counts[1000:1048] = 10**7
    bins = window_packing.solve(counts)
    assert len(bins) < 20_000
    assert window_packing.windows(bins) <= (counts @ np.arange(2048)) / 2048 * 1.02


def test_slots_cover_every_number_once():
    bins = [(3, [9, 4, 4]), (2, [9, 9]), (1, [4])]
    seen = {}
    for size, first, end, sequence, each, offset in window_packing.slots(bins):
        for at in range(first, end):
            assert (size, at) not in seen
            seen[size, at] = (sequence + (at - first) // each, offset + (at - first) % each * size)
    assert len(seen) == 3 * 3 + 2 * 2 + 1 and len(set(seen.values())) == len(seen)
    assert {s for s, _ in seen.values()} == set(range(6))


def check(spark, docs, window):
    encode = packing.encoder().ids
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    out = window_packing.packed(docs, window=window, with_ids=True).collect()
    want = sorted((d is not None, d or 0, np.frombuffer(encode(t), "<u4").tolist() + [0]) for d, t in texts)
    by_sequence = {}
    for r in out:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        assert r.length == window or r.piece == 0
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= window
    # documents again: pieces in order; repeated rows give equal pieces, so compare as multisets
    pieces = sorted((r.key is not None, r.key or 0, r.piece, r.start, r.ids) for r in out)
    expected = []
    for known, d, ids in want:
        size = len(ids) % window
        cuts = [0, *range(size, len(ids) + 1, window)] if size else list(range(0, len(ids) + 1, window))
        expected += [(known, d, i, x, ids[x:y]) for i, (x, y) in enumerate(zip(cuts, cuts[1:]))]
    assert pieces == sorted(expected)
    return len(by_sequence)


def test_nasty_rows(spark):
    assert check(spark, rows.nasty(spark).repartition(3), 512)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    used = check(spark, docs, 2048)
    lengths = [len(packing.encoder().ids(r.text or "")) // 4 + 1 for r in docs.collect()]
    assert used <= -(-sum(lengths) // 2048) + 2


def test_empty(spark):
    assert window_packing.packed(rows.empty(spark)).count() == 0
