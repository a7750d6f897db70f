"""SimHash near-duplicates: pigeonring candidate filtering, exact links, connected groups.

A fingerprint's 64 bits lie on a ring of five segments.  If two differ in at most four
bits, there is a segment from which every chain of ``l`` segments differs in at most
``floor(l * 4 / 5)`` bits.  Chains of two (0, then at most 1 bit) serve as join keys: each
fingerprint is listed under its own chains, and under those with one bit of the second
segment raised, so that of two that differ there one meets the other.  In a key's group,
longer chains thin the pairs out before all 64 bits are compared.

Only distinct fingerprints take part.  Groups of one key that are too large for a task
are dealt out as pairs of blocks; from any group only a spanning forest of its links
leaves, so a cluster of copies costs as many rows as it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from duologue.llm import components, workers

SHINGLE = 4
SEED = 42
MAX_DISTANCE = 4
SEGMENTS = 5
#: Shingles per numpy pass.
PASS_SHINGLES = 100_000
#: Rows of one key that a task takes at once; larger groups are dealt out by blocks.
BLOCK = 2048
#: Key groups up to this size are compared by shifted arrays, larger ones by search.
SHORT_RUN = 8

WIDTHS = [13, 13, 13, 13, 12]
SHIFTS = [0, 13, 26, 39, 52]
MASKS = [np.uint64(((1 << w) - 1) << s) for w, s in zip(WIDTHS, SHIFTS, strict=True)]


def shingle_hashes(words: list[bytes], size: int = SHINGLE) -> list[int]:
    """XXH64 of each run of words, space-joined; of all words if they are fewer."""
    if len(words) <= size:
        return [xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = [0, *(ends[: -size] + 1).tolist()]
    return [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begins, ends[size - 1 :].tolist(), strict=True)]


def bit_counts(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each bit, lowest first."""
    total = np.zeros(64, np.int64)
    for a in range(0, len(hashes), PASS_SHINGLES):
        part = np.array(hashes[a : a + PASS_SHINGLES], np.uint64)
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def fingerprint_texts(texts: list[bytes]) -> np.ndarray:
    """A signed 64-bit fingerprint for each text; no words give 0."""
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        hashes = shingle_hashes(text.lower().split())
        if hashes:
            out[i] = np.packbits(bit_counts(hashes) * 2 > len(hashes), bitorder="little").view(np.uint64)[0]
    return out.view(np.int64)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp) for every row; a null or empty text has fingerprint 0.  No shuffle."""
    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch["key"], pa.array(fingerprint_texts(workers.utf8(batch["text"])))], ["key", "fp"])

    return workers.map_batches(rows, each, f"key {dict(rows.dtypes)['key']}, fp long")


def chain_keys(fps: np.ndarray, raised: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all chains of two segments, and which fingerprint each belongs to.

    With ``raised``, also those with one more bit in the second segment.
    """
    x = fps.view(np.uint64)
    everyone = np.arange(len(x))
    keys, owners = [], []
    for i in range(SEGMENTS):
        own = _folded(x, i)
        keys.append(own)
        owners.append(everyone)
        for b in range(WIDTHS[(i + 1) % SEGMENTS] if raised else 0):
            low = everyone[(own >> b) & 1 == 0]
            keys.append(own[low] | (1 << b))
            owners.append(low)
    return np.concatenate(keys), np.concatenate(owners)


def _folded(x: np.ndarray, i: int) -> np.ndarray:
    """Segment i and the next of each number, and i itself, as one small number."""
    j = (i + 1) % SEGMENTS
    first = (x & MASKS[i]) >> np.uint64(SHIFTS[i])
    second = (x & MASKS[j]) >> np.uint64(SHIFTS[j])
    return ((np.uint64(i) << np.uint64(26)) | (first << np.uint64(13)) | second).astype(np.int64)


def linked(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which pairs are within the distance, by chains of 3 and 4 segments from ``start``, then in full."""
    diff = (a ^ b).view(np.uint64)
    chains = np.array([[_chain(i, n) for n in (3, 4)] for i in range(SEGMENTS)], np.uint64)
    near = np.bitwise_count(diff & chains[start, 0]) <= 3 * MAX_DISTANCE // SEGMENTS
    near &= np.bitwise_count(diff & chains[start, 1]) <= 4 * MAX_DISTANCE // SEGMENTS
    at = np.flatnonzero(near)
    near[at] = np.bitwise_count(diff[at]) <= MAX_DISTANCE
    return near


def _chain(start: int, n: int) -> int:
    return sum(int(MASKS[(start + k) % SEGMENTS]) for k in range(n))


def spanning(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all of one group's linked members: a search that compares only what isn't reached yet."""
    left = np.unique(fps)
    us, vs = [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count((left ^ x).view(np.uint64)) <= MAX_DISTANCE
            if near.any():
                found, left = left[near], left[~near]
                us.append(np.full(len(found), x))
                vs.append(found)
                queue.extend(found)
    none = np.zeros(0, np.int64)
    return (np.concatenate(us), np.concatenate(vs)) if us else (none, none)


def _links_in(keys: np.ndarray, parts: np.ndarray, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links inside the groups of equal (key, part); rows are sorted by these."""
    if len(keys) < 2:
        return
    same = (keys[1:] == keys[:-1]) & (parts[1:] == parts[:-1])
    begins = np.flatnonzero(np.concatenate([[True], ~same]))
    sizes = np.diff(np.append(begins, len(keys)))
    size = np.repeat(sizes, sizes)
    left = np.repeat(begins + sizes, sizes) - np.arange(len(keys))
    for d in range(1, SHORT_RUN):
        at = np.flatnonzero((size <= SHORT_RUN) & (left > d))
        if not len(at):
            break
        hit = at[linked(fps[at], fps[at + d], keys[at] >> 26)]
        yield fps[hit], fps[hit + d]
    for k in np.flatnonzero(sizes > SHORT_RUN):
        yield spanning(fps[begins[k] : begins[k] + sizes[k]])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links in a partition sorted by (key, part); a group may go over several batches."""
    held = [np.zeros(0, np.int64)] * 3
    for batch in batches:
        now = [np.concatenate([h, batch[c].to_numpy()]) for h, c in zip(held, ("key", "part", "fp"), strict=True)]
        last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        yield from _links_in(*(x[:cut] for x in now))
        held = [x[cut:] for x in now]
    yield from _links_in(*held)


def large_keys(distinct: DataFrame, block: int) -> DataFrame:
    """(key, blocks) of the keys whose group is dealt out.

    A key's group has the fingerprints that own it and those that reach it by one raised
    bit, from at most 13 other keys.  So counts of owned keys, and only those of a
    14th of a block and more, tell each group's size but for less than one block.
    """
    most = max(WIDTHS) + 1

    def owned(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, n = np.unique(chain_keys(batch["fp"].to_numpy(), raised=False)[0], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], ["key", "n"])

    def reached(batch: pa.RecordBatch) -> pa.RecordBatch:
        key, n = batch["key"].to_numpy(), batch["n"].to_numpy()
        width = np.array(WIDTHS)[((key >> 26) + 1) % SEGMENTS]
        keys, counts = [key], [n]
        for b in range(max(WIDTHS)):
            low = ((key >> b) & 1 == 0) & (b < width)
            keys.append(key[low] | (1 << b))
            counts.append(n[low])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, counts)], ["key", "n"])

    counts = workers.map_batches(distinct.select("fp"), owned, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    large = workers.map_batches(counts.where(F.col("n") * most >= block), reached, "key long, n long")
    sized = large.groupBy("key").agg(F.ceil(F.sum("n") / block).cast("int").alias("blocks"))
    return sized.where("blocks > 1")


def links(distinct: DataFrame, block: int = BLOCK) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column ``fp``) that connect all that link."""
    workers.importable(distinct.sparkSession)

    def keyed(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = batch["fp"].to_numpy()
        keys, owners = chain_keys(fps)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[owners])], ["key", "fp"])

    rows = workers.map_batches(distinct.select("fp"), keyed, "key long, fp long")

    hot = workers.stored(large_keys(distinct, block))
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1)).alias("other")
    dealt = (
        rows.join(workers.small_side(hot), "key", "left")
        .select("key", "fp", "blocks", F.coalesce(mine, F.lit(0)).alias("mine"), other)
        .select("key", "fp", (F.least("mine", "other") * F.coalesce("blocks", F.lit(1)) + F.greatest("mine", "other")).alias("part"))
    )
    together = dealt.repartition("key", "part").sortWithinPartitions("key", "part")
    return together.mapInArrow(lambda batches: components.contract(_links(batches)), "u long, v long")


def _rooted(distinct: DataFrame, block: int) -> DataFrame:
    """(fp, root) of the fingerprints that have a link."""
    hung = components.connected(links(distinct, block))
    return hung.union(hung.select("root", "root").distinct()).toDF("fp", "root")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per input row: key, fp, and ``group``, the smallest key that links reach.

    Rows with equal fingerprints are one node, so repeated rows and texts without words
    link like any others.  A null key stays null and never names a group; a group of only
    such rows has a null ``group``.  Other columns are not read.
    """
    prints = workers.stored(fingerprints(docs, key, text))
    distinct = prints.groupBy("fp").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    rooted = distinct.join(_rooted(distinct, block), "fp")
    lowest = rooted.groupBy("root").agg(F.min("first").alias("lowest"))
    named = rooted.join(lowest, "root").select("fp", "lowest")
    of = workers.stored(distinct.join(named, "fp", "left").select("fp", "n", F.coalesce("lowest", "first").alias("group")))
    return workers.join_counted(prints, of, "fp", prints.count()).select("key", "fp", "group")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group, the one with the smallest key; columns as they are.

    Of several rows with that key it is the one with the smallest digest of its text, then
    of all its columns, so a rerun chooses the same.  Rows with a null key come last, and
    one of them stays only if its group has no other rows.
    """
    every = F.sha2(F.to_json(F.struct(*(docs[c] for c in docs.columns)), {"ignoreNullFields": "false"}), 256)
    own = F.sha2(F.coalesce(docs[text].cast("string"), F.lit("")), 256)
    order = F.struct(docs[key].isNull().alias("last"), docs[key].alias("key"), own.alias("own"), every.alias("every"))
    prints = fingerprints(docs.select(order.alias("order"), docs[text].alias("text")), "order", "text")
    distinct = workers.stored(prints.groupBy("fp").agg(F.min("key").alias("first")))
    at = F.coalesce("root", "fp").alias("root")
    least = distinct.join(_rooted(distinct, BLOCK), "fp", "left").select(at, "first").groupBy("root").agg(F.min("first").alias("first"))
    keep = workers.stored(least.select(F.col("first.every").alias("every")))
    marked = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), every.alias("every"))
    return marked.join(keep, "every", "left_semi").dropDuplicates(["every"]).select("row.*")
