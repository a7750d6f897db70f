import random

import numpy as np
import xxhash

from duologue.llm import components, simhash
from tests.llm import rows


def plain_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    bits = sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))
    return bits - (1 << 64) if bits >> 63 else bits


def plain_groups(fps):
    """Smallest linked fingerprint of each, by comparing all pairs."""
    nodes = np.array(sorted(set(fps)), np.int64)
    root = {f: f for f in nodes.tolist()}
    for f in nodes.tolist():
        reach, todo = set(), [f]
        while todo:
            x = todo.pop()
            if x not in reach:
                reach.add(x)
                todo += nodes[np.bitwise_count((nodes ^ np.int64(x)).view(np.uint64)) <= 4].tolist()
        root[f] = min(reach)
    return root


def clustered(n, seed):
    rng = random.Random(seed)
    found = [rng.getrandbits(64) for _ in range(max(2, n // 40))]
    while len(found) < n:
        x = rng.choice(found[:20] + found[-20:])
        for _ in range(rng.randint(0, 6)):
            x ^= 1 << rng.randrange(64)
        found.append(x)
    return [x - (1 << 64) if x >> 63 else x for x in found]


def test_links_lose_nothing_at_any_block_size(spark):
    for n, block in ((400, 2048), (400, 14), (1500, 60)):
        fps = clustered(n, n + block)
        distinct = spark.createDataFrame([(f,) for f in set(fps)], "fp long").repartition(5)
        got = {r.node: r.root for r in components.connected(simhash.links(distinct, block)).collect()}
        want = plain_groups(fps)
        assert all(got.get(f, f) == r for f, r in want.items())


def test_dense_cluster(spark):
    # all numbers over 11 bits: one component with thousands of links at every node
    distinct = spark.range(1 << 11).selectExpr("id << 20 AS fp")
    edges = simhash.links(distinct, 100)
    assert components.connected(edges).where("root = 0").count() == (1 << 11) - 1
    assert edges.count() < 60 * (1 << 11)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(230)] + [(1000 + i, 1001 + i) for i in range(150)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
    assert components.connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_fingerprints_and_groups(spark):
    docs = rows.nasty(spark)
    got = simhash.groups(docs).collect()
    source = docs.select("doc_id", "text").collect()
    assert len(got) == len(source)
    root = plain_groups([plain_fingerprint(r.text or "") for r in source])
    least = {}
    for r in source:
        at = root[plain_fingerprint(r.text or "")]
        least[at] = min(x for x in (least.get(at), r.doc_id) if x is not None) if r.doc_id is not None or at in least else None
    want = sorted((str(r.doc_id), plain_fingerprint(r.text or ""), str(least[root[plain_fingerprint(r.text or "")]])) for r in source)
    assert sorted((str(r.key), r.fp, str(r.group)) for r in got) == want
    # no words: fingerprint 0, linked like any other
    assert {r.group for r in got if r.key in (3, 4, 5)} == {3}


def test_keep_first(spark):
    docs = rows.nasty(spark)
    kept = simhash.keep_first(docs)
    assert kept.schema == docs.schema
    ids = [r.doc_id for r in kept.collect()]
    want = {r.group for r in simhash.groups(docs).where("key is not null").collect()}
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 1
    assert simhash.keep_first(rows.empty(spark)).count() == simhash.groups(rows.empty(spark)).count() == 0


def test_keep_first_takes_rows_not_keys(spark):
    a, b = rows.prose(21, 300), rows.prose(22, 300)
    found = [(1, b, "x"), (1, a, "x"), (2, b, "y"), (2, a, "y"), (None, a, "z"), (None, rows.prose(23, 300), "z"), (None, rows.prose(23, 300), "z"), (1, a, "w")]
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(found)
        docs = spark.createDataFrame(found, "doc_id long, text string, source string").repartition(4)
        kept = sorted(map(str, simhash.keep_first(docs).collect()))
        # one row of each of three groups: both texts of the repeated key 1 lead one
        assert len(kept) == 3 and sum("doc_id=1," in r for r in kept) == 2 and sum("doc_id=None" in r for r in kept) == 1
        want = want or kept
        assert kept == want
