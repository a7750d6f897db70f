"""Language-model scores from a whole probabilistic suffix tree.

The tree is that of ``suffix_tree`` without shares: every trained word is a symbol, every
context of up to ``DEPTH`` words is tried, and every next word seen in a kept context has
an entry.  Only the divergence test decides.  A context seen once gains nothing and can't
pass it.

A run of words (a gram) is named by 64 bits.  With a kept context of count ``c`` the word
after it, seen ``n`` times there, has the probability ``(n + s q') / (c + s)``, where ``q'``
is that after the context without its oldest word and ``s`` the smoothing; otherwise ``q'``.

All contexts that end with the same word are judged in one group: a token goes there once,
with the words before it, packed with other tokens of its task, and the group counts, tests
and scores every level.  It needs the root's probability of the token, which is broadcast
for the most frequent words and joined for the others.  Contexts of more than ``HOT`` tokens
are no groups: their entries are tables (name, n, m, q, root), made level by level with
joins, their tokens take ``q`` from there and go to the groups of the contexts one word longer.

What is broadcast otherwise is a bit table of bounded size of the words seen twice.  It lets
a task leave out words that no kept context has; as it fills, it leaves out less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from duologue.llm import workers
from duologue.llm.suffix_tree import DEPTH, END, HELD, SMOOTHING

#: The table of words that were seen twice has 2 to the power of this many bits at most, and about this many bits for each of them.
SEEN_BITS = 27
BITS_EACH = 8
#: Bytes of text that are split into words at once; a longer document makes a pass of its own.
PASS_BYTES = 3 << 19
#: Tokens or names that a task holds before it hands them on.
POSITIONS = 1_000_000
#: Keys that meet one in so many rows are broadcast in joins.
HOT_SHARE = 1000
#: Tokens after a context from which on its entries are tables.
HOT = 4_000_000
#: Tokens of a group, about, and of a slice of it that is worked on at once.
GROUP = 2_500_000
SLICE = 250_000
#: Names at most whose probability is broadcast.
TOP = 1 << 19
STEP = np.uint64(0x9E3779B97F4A7C15)


END_NAME = np.uint64(xxh64_intdigest(END))


def longer(name: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Names of grams with one more word at their end."""
    return workers.mix64(name * STEP + word)


def passes(texts: pa.Array, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Passes over documents: the first one's number, their sizes, places of their tokens, word numbers of all places, and the words' names; ends, the last of the words, lie before each document."""
    for a, b in workers.groups_of(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), PASS_BYTES):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.slice(a, b - a), "")))
        encoded = lists.flatten().dictionary_encode()
        words = encoded.dictionary.cast(pa.binary()).to_pylist()
        numbers = encoded.indices.to_numpy()
        # spaces at both ends of a text leave empty words
        inside = np.array([bool(w) for w in words], bool)[numbers] if len(words) else np.zeros(0, bool)
        upto = np.zeros(len(numbers) + 1, np.int64)
        np.cumsum(inside, out=upto[1:])
        sizes = np.diff(upto[lists.offsets.to_numpy()]) + 1
        inner = np.ones(int(sizes.sum()), bool)
        inner[np.cumsum(sizes) - 1] = False
        places = np.arange(len(inner)) + longest * np.repeat(np.arange(1, len(sizes) + 1), sizes)
        flat = np.full(len(inner) + longest * len(sizes), len(words), np.int32)
        flat[places[inner]] = numbers[inside]
        yield a, sizes, places, flat, np.append(np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words)), END_NAME)


def grams(one: np.ndarray, longest: int) -> list[np.ndarray]:
    """Names of the grams of 1, 2, ... words that end at each place."""
    found = [one]
    for _ in range(longest - 1):
        found.append(longer(np.concatenate([[END_NAME], found[-1][:-1]]), one))
    return found


def lookup(names: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted in ordered names, and whether they are there."""
    if not len(names):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
    return at, names[at] == wanted


def hot_depth(found: list[np.ndarray], places: np.ndarray, hot: list[np.ndarray]) -> np.ndarray:
    """How many words before each place make a hot context."""
    depth = np.zeros(len(places), np.int64)
    for k, names in enumerate(hot):
        if len(names):
            some = np.flatnonzero(depth == k)
            depth[some[lookup(names, found[k][places[some] - 1])[1]]] = k + 1
    return depth


def maybe_twice(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    """False only for names of words seen once at most."""
    at = names >> np.uint64(65 - (64 * len(bits)).bit_length())
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def _seen_twice(table: DataFrame) -> np.ndarray:
    """Bit table of the names of rows with ``n`` of 2 and more; at most 2^(SEEN_BITS - 6) rows are collected."""
    size = min(SEEN_BITS, max(10, (BITS_EACH * table.where("n > 1").count()).bit_length()))
    name = F.shiftrightunsigned("name", 64 - size)
    bit = F.expr("shiftleft(1L, cast(at & 63 AS int))")
    words = table.where("n > 1").select(name.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (size - 6), np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def _joined(left: DataFrame, right: DataFrame, key: str, values: list[str], spread: Column, total: int) -> DataFrame:
    """``left`` with the values of ``right`` (name, m, values), which has a row for each ``key``; a key meets at most ``m`` of ``total`` rows.

    Keys that meet at least one in ``HOT_SHARE`` rows are broadcast; their rows go through
    the other join under ``spread``, which matches nothing.
    """
    hot = F.col("m") * HOT_SHARE >= total
    few = right.where(hot).select(F.col("name").alias(key), *(F.col(v).alias(f"hot_{v}") for v in values))
    rest = right.where(~hot).select(F.col("name").alias("at"), *values)
    marked = left.join(F.broadcast(few), key, "left").withColumn("at", F.when(F.col(f"hot_{values[0]}").isNull(), F.col(key)).otherwise(spread))
    both = marked.join(rest, "at", "left")
    return both.select(*left.columns, *(F.coalesce(f"hot_{v}", v).alias(v) for v in values))


def _counted(rows: DataFrame, hot: list[np.ndarray]) -> DataFrame:
    """(name, n, m) of all words, or (name, context, shorter, n, m) of the grams after the hot contexts of the newest level."""
    level = len(hot)
    ids = ["name", "context", "shorter"] if level else ["name"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
            *own, n, m = (np.concatenate(x) for x in zip(*parts, strict=True))
            _, first, at = np.unique(own[0], return_index=True, return_inverse=True)
            return (*(x[first] for x in own), *(np.bincount(at, x, len(first)).astype(np.int64) for x in (n, m)))

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                columns = [x.view(np.int64) for x in merged(held)]
                held.clear()
                for a in range(0, len(columns[0]), HELD):
                    yield pa.RecordBatch.from_arrays([pa.array(c[a : a + HELD]) for c in columns], [*ids, "n", "m"])

        for batch in batches:
            trains = np.array(batch["trains"].to_pylist(), bool)
            for a, sizes, places, flat, words in passes(batch["text"], level + 1):
                own = np.repeat(trains[a : a + len(sizes)], sizes)
                if level:
                    found = grams(words[flat], level + 1)
                    some = np.flatnonzero(hot_depth(found, places, hot) == level)
                    at = places[some]
                    held.append(merged([(found[level][at], found[level - 1][at - 1], found[level - 1][at], own[some].astype(np.int64), np.ones(len(at), np.int64))]))
                else:
                    at = flat[places]
                    held.append((words, *(np.bincount(x, minlength=len(words)) for x in (at[own], at))))
                size += len(held[-1][0])
                if size > POSITIONS:
                    yield from flush()
                    size = 0
        yield from flush()

    counted = rows.mapInArrow(count, ", ".join(f"{c} long" for c in [*ids, "n", "m"]))
    return counted.groupBy("name").agg(*(F.min(c).alias(c) for c in ids[1:]), F.sum("n").alias("n"), F.sum("m").alias("m")).where("m > 0")


def _level(grams_: DataFrame, below: DataFrame, total: int, smoothing: float) -> DataFrame:
    """(name, n, m, q, root), stored, of the entries of hot contexts from their counts and the level below."""
    weight = F.lit(float(smoothing))
    priced = workers.stored(_joined(grams_, below, "shorter", ["q", "root"], F.col("name"), total).drop("shorter"))
    # the sum of n log((n - 1 + s q) / ((c - 1 + s) q)), with c the sum of n
    gain = F.sum(F.when(F.col("n") > 0, F.col("n") * F.log((F.col("n") - 1 + weight * F.col("q")) / F.col("q"))).otherwise(0.0))
    sums = priced.groupBy("context").agg(F.sum("n").alias("c"), gain.alias("gain"))
    kept = workers.stored(sums.where((F.col("c") > 1) & (F.col("gain") > F.col("c") * F.log(F.col("c") - 1 + weight))).select("context", "c"))
    found = priced.join(F.broadcast(kept), "context", "left")  # hot contexts: one in HOT tokens at most
    q = F.when(F.col("c").isNull(), F.col("q")).otherwise((F.col("n") + weight * F.col("q")) / (F.col("c") + weight))
    return workers.stored(found.select("name", "n", "m", q.alias("q"), "root"))


class Shared:
    """What every task has: the most frequent names with their probabilities, words seen twice, hot contexts; of bounded size."""

    def __init__(self, top: pa.Table, bits: np.ndarray, hot: list[np.ndarray], below: float, smoothing: float, depth: int, groups: int):
        top = top.sort_by([("m", "descending"), ("name", "ascending")])
        #: by frequency
        self.ranked, self.q, self.root = top["name"].to_numpy().view(np.uint64), top["q"].to_numpy(), top["root"].to_numpy()
        #: by name
        self.rank = np.argsort(self.ranked).astype(np.int32)
        self.names = self.ranked[self.rank]
        self.bits, self.hot, self.below, self.smoothing, self.depth, self.groups = bits, hot, below, smoothing, depth, groups
        self.positions, self.slice = POSITIONS, SLICE


class Tokens:
    """One pass over documents: what is known of each token, and the group that it goes to."""

    def __init__(self, shared: Shared, sizes: np.ndarray, places: np.ndarray, flat: np.ndarray, words: np.ndarray, trains: np.ndarray):
        at, top = lookup(shared.names, words)
        #: of every word: its rank, or the number of ranks; whether a kept context may have it
        self.ranks = np.full(len(words), len(shared.names), np.int32)
        self.ranks[top] = shared.rank[at[top]]
        self.twice = top.copy()
        self.twice[~top] = maybe_twice(shared.bits, words[~top])
        #: of every token
        self.own = np.repeat(trains, sizes)
        word, before = flat[places], flat[places - 1]
        rank = self.ranks[word]
        # a trained word that was not seen twice was seen once
        self.clear = (rank < len(shared.names)) | (self.own & ~self.twice[word])
        self.depth = np.zeros(len(places), np.int64)
        self.name, context = words[word], words[before]
        if shared.hot:
            found = grams(words[flat], len(shared.hot) + 1)
            self.depth = hot_depth(found, places, shared.hot)
            for d in range(1, len(found)):
                deep = np.flatnonzero(self.depth == d)
                self.name[deep] = found[d][places[deep]]
                context[deep] = longer(found[d - 1][places[deep] - 2], words[before[deep]]) if d < shared.depth else self.name[deep]
            deep = np.flatnonzero(self.depth)
            at, hit = lookup(shared.names, self.name[deep])
            self.clear[deep] = hit
            rank[deep[hit]] = shared.rank[at[hit]]
            rank[deep[~hit]] = len(shared.names)
        hit = rank < len(shared.names)
        self.q = np.full(len(places), 2 / shared.below)
        self.root = self.q.copy()
        self.q[hit], self.root[hit] = shared.q[rank[hit]], shared.root[rank[hit]]
        self.group = (workers.mix64(context) % np.uint64(shared.groups)).astype(np.int32)
        self.sent = ~self.clear | (self.twice[before] & (self.depth < shared.depth))


def _needs(rows: DataFrame, sent: Broadcast) -> DataFrame:
    """(group, name) of grams whose probability a group has to be told."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = sent.value
        for batch in batches:
            trains = np.array(batch["trains"].to_pylist(), bool)
            held = []
            for a, sizes, *places in passes(batch["text"], shared.depth + 1):
                tokens = Tokens(shared, sizes, *places, trains[a : a + len(sizes)])
                held.append((tokens.name[~tokens.clear], tokens.group[~tokens.clear]))
            if held:
                name, group = (np.concatenate(x) for x in zip(*held, strict=True))
                _, first = np.unique(longer(name, group.astype(np.uint64)), return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(group[first]), pa.array(name[first].view(np.int64))], ["group", "name"])

    return rows.select("trains", "text").mapInArrow(find, "group int, name long")


#: Documents, numbered, in chunks of a task's documents; tokens packed for a group; sums packed for a chunk.
DOCS = {"chunk": pa.int64(), "row": pa.int64(), "key": None, "held_out": pa.bool_(), "n_tokens": pa.int64(), "known": pa.int64(), "base": pa.float64(), "score": pa.float64()}
SENT = {"group": pa.int32(), **DOCS, "tokens": pa.binary(), "words": pa.binary(), "size": pa.int64()}
JUDGED = {**DOCS, "sums": pa.binary()}
SUMS = np.dtype([("doc", "<i4"), ("known", "<i4"), ("base", "<f8"), ("score", "<f8")])
DDL = {pa.int32(): "int", pa.int64(): "long", pa.bool_(): "boolean", pa.float64(): "double", pa.binary(): "binary"}


def _ddl(types: dict[str, pa.DataType | None], kind: str) -> str:
    return ", ".join(f"{c} {DDL.get(t, kind)}" for c, t in types.items())


def _filled(types: dict[str, pa.DataType | None], key: pa.DataType, columns: dict) -> pa.RecordBatch:
    """Rows of these types, null in the columns that are not given."""
    size = len(columns["chunk"])
    arrays = [columns.get(c) if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], t) if c in columns else pa.nulls(size, t or key) for c, t in types.items()]
    return pa.RecordBatch.from_arrays(arrays, list(types))


def packed(columns: np.ndarray) -> bytes:
    """32-bit columns, compressed byte by byte."""
    return pa.compress(np.ascontiguousarray(columns).view(np.uint8).reshape(*columns.shape, 4).transpose(0, 2, 1).tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, width: int, size: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(data, width * size * 4, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, 4, size).transpose(0, 2, 1)).view(np.int32)[..., 0]


def _tokens(rows: DataFrame, sent: Broadcast, kind: str) -> DataFrame:
    """Documents with the sums of what needs no group, and tokens packed for their groups.

    A packed token has its word and the words before it, its document, and marks.  Words are
    ranks among the most frequent names, their number for all words of no kept context, or
    beyond that places among the pack's own words.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, row = sent.value, TaskContext.get().partitionId() << 33
        top, width = len(shared.names), shared.depth + 1
        held, size, start, others = [], 0, row, 0

        def flush(key: pa.DataType) -> Iterator[pa.RecordBatch]:
            columns, group, other = (np.concatenate([h[i] for h in held], axis=-1) for i in range(3))
            held.clear()
            order = np.argsort(group, kind="stable")
            group = group[order]
            cuts = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group))
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                part = columns[:, order[s:e]]
                part[width] = np.diff(part[width], prepend=0)
                words = part[:width]
                ids, at = np.unique(words[words > top], return_inverse=True)
                words[words > top] = top + 1 + at
                own = other[ids - top - 1].tobytes()
                yield _filled(SENT, key, {"group": group[s : s + 1], "chunk": [start], "tokens": [packed(part)], "words": [own], "size": [e - s]})

        for batch in batches:
            key, trains = batch["key"].type, np.array(batch["trains"].to_pylist(), bool)
            for a, sizes, places, flat, words in passes(batch["text"], width):
                own = trains[a : a + len(sizes)]
                tokens = Tokens(shared, sizes, places, flat, words, own)
                starts = np.zeros(len(sizes) + 1, np.int64)
                np.cumsum(sizes, out=starts[1:])
                numbers = row + np.arange(len(sizes))
                yield _filled(SENT, key, {
                    "group": (numbers % shared.groups).astype(np.int32),
                    "chunk": np.full(len(sizes), start),
                    "row": numbers,
                    "key": batch["key"].slice(a, len(sizes)),
                    "held_out": ~own,
                    "n_tokens": sizes,
                    "known": workers.sums((tokens.clear & (tokens.root > 1.5 / shared.below)).astype(np.int64), starts),
                    "base": workers.sums(np.where(tokens.clear, np.log10(tokens.root), 0.0), starts),
                    "score": workers.sums(np.where(tokens.sent, 0.0, np.log10(tokens.q)), starts),
                })
                some = np.flatnonzero(tokens.sent)
                code = np.where(tokens.ranks < top, tokens.ranks, top + 1 + others + np.arange(len(words), dtype=np.int32)).astype(np.int32)
                before = np.where(tokens.twice, code, np.int32(top))[flat]
                doc = (row - start + np.repeat(np.arange(len(sizes)), sizes)[some]).astype(np.int32)
                marks = (tokens.depth[some] * 4 + tokens.clear[some] * 2 + tokens.own[some]).astype(np.int32)
                held.append((np.stack([code[flat[places[some]]], *(before[places[some] - k] for k in range(1, width)), doc, marks]), tokens.group[some], words))
                others += len(words)
                size += len(some)
                row += len(sizes)
                if size > shared.positions:
                    yield from flush(key)
                    size, start, others = 0, row, 0
        if held:
            yield from flush(key)

    return rows.mapInArrow(send, _ddl(SENT, kind))


class Group:
    """A group's tokens: words and the words before them, marks, and their probabilities in the tree so far.

    All tokens of a context are there, unless it is hot or was seen once.
    """

    def __init__(self, shared: Shared, table: np.ndarray, words: np.ndarray, marks: np.ndarray, told: tuple[np.ndarray, np.ndarray, np.ndarray]):
        self.shared, self.table, self.words, self.marks = shared, table, words, marks
        self.start = marks >> 2
        self.unclear = np.flatnonzero((marks & 2) == 0).astype(np.int32)
        once = 2 / shared.below
        self.q = np.append(shared.q, once)[np.minimum(words[0], len(shared.names))]
        for d in range(1, shared.depth + 1):
            own = np.flatnonzero((self.start == d) & ((marks & 2) > 0))
            at, hit = lookup(shared.names, self.names(own, d, True))
            self.q[own] = shared.q[shared.rank[at[hit]]]
        #: of the unclear ones
        self.root = np.full(len(self.unclear), once)
        for d in range(shared.depth + 1):
            own = np.flatnonzero(self.start[self.unclear] == d)
            at, hit = lookup(told[0], self.names(self.unclear[own], d, True))
            self.q[self.unclear[own]], self.root[own] = told[1][at[hit]], told[2][at[hit]]

    def names(self, some: np.ndarray, size: int, whole: bool = False) -> np.ndarray:
        """Names of the grams of the last words before tokens, with the tokens' own words if whole."""
        out = np.empty(len(some), np.uint64)
        for a in range(0, len(some), self.shared.slice):
            own = some[a : a + self.shared.slice]
            words = [self.table[self.words[k][own]] for k in range(size, 0 if not whole else -1, -1)]
            name = words[0]
            for word in words[1:]:
                name = longer(name, word)
            out[a : a + len(own)] = name
        return out

    def judge(self, some: np.ndarray, k: int = 1, again: np.ndarray | None = None) -> None:
        """Contexts of ``k`` words and more of some tokens, all that have these contexts; ``again`` says whose gram of ``k`` words may be found a second time."""
        shared = self.shared
        again = np.ones(len(some), bool) if again is None else again
        good = self.words[k][some] != len(shared.names)
        some, again = some[good], again[good]
        if not len(some):
            return
        if len(some) > shared.slice:
            number = -(-len(some) // shared.slice)
            parts = (self.names(some, k) % np.uint64(number)).astype(np.uint16)
            for i in range(number):
                own = parts == i
                self._judge(some[own], k, again[own])
        else:
            self._judge(some, k, again)

    def _judge(self, some: np.ndarray, k: int, again: np.ndarray) -> None:
        shared, smoothing = self.shared, self.shared.smoothing
        later = self.start[some] >= k
        if later.any():
            if k < shared.depth:
                self.judge(some[later], k + 1, again[later])
            some, again = some[~later], again[~later]
        if not len(some):
            return
        names = self.names(some, k)
        context = np.searchsorted(np.unique(names), names).astype(np.int32) if len(some) > shared.slice else np.unique(names, return_inverse=True)[1]
        train = (self.marks[some] & 1) > 0
        c = np.bincount(context, train)
        # what was seen once proves nothing, nor does a longer context of it
        twice = c[context] > 1
        some, context, again, train = (x[twice] for x in (some, context, again, train))
        if not len(some):
            return
        # a gram whose shorter gram is found once is found once
        n, maybe = train.astype(np.int32), np.flatnonzero(again).astype(np.int32)
        names = self.names(some[maybe], k, True)
        gain = np.zeros(len(c))
        number = -(-len(maybe) // shared.slice)
        parts = (names % np.uint64(max(1, number))).astype(np.uint16)
        for i in range(number):
            own = np.flatnonzero(parts == i) if number > 1 else slice(None)
            at = maybe[own]
            _, gram = np.unique(names[own], return_inverse=True)
            first = np.zeros(gram.max() + 1 if len(gram) else 0, np.int32)
            first[gram] = at
            seen, m = np.bincount(gram, train[at], len(first)), np.bincount(gram, minlength=len(first))
            n[at], again[at] = seen[gram], m[gram] > 1
            several = (seen > 0) & (m > 1)
            first, seen = first[several], seen[several]
            below = self.q[some[first]]
            gain += np.bincount(context[first], seen * np.log((seen - 1 + smoothing * below) / below), len(c))
        gain += np.bincount(context, train & ~again, len(c)) * np.log(smoothing)
        del names, parts, maybe
        kept = np.flatnonzero((gain > c * np.log(np.maximum(c, 1) - 1 + smoothing))[context])
        self.q[some[kept]] = (n[kept] + smoothing * self.q[some[kept]]) / (c[context[kept]] + smoothing)
        del context, train, twice, n, kept  # the next level works on slices of its own
        if k < shared.depth:
            self.judge(some, k + 1, again)


def _judged(sent: Broadcast):
    """A group's tokens to sums of each chunk's documents."""

    def judge(rows: pa.Table, told: pa.Table) -> pa.Table:
        shared = sent.value
        top, width = len(shared.names), shared.depth + 1
        pa.default_memory_pool().release_unused()
        packs = rows.filter(pc.is_valid(rows["tokens"])).select(["tokens", "words", "size"])
        docs = rows.filter(pc.is_null(rows["tokens"])).select(list(DOCS))
        docs = docs.append_column("sums", pa.nulls(docs.num_rows, pa.binary()))
        if not packs.num_rows:
            return docs
        chunks = rows.filter(pc.is_valid(rows["tokens"]))["chunk"].to_numpy()
        names, first = np.unique(told["name"].to_numpy().view(np.uint64), return_index=True)
        told = names, told["q"].to_numpy()[first], told["root"].to_numpy()[first]
        sizes = packs["size"].to_numpy()
        words, marks, change = np.empty((width, sizes.sum()), np.int32), np.empty(sizes.sum(), np.int8), np.empty(sizes.sum(), bool)
        table, ids, own, a, cuts = [shared.ranked, np.zeros(1, np.uint64)], [], 0, 0, [0]
        for tokens, others, size in zip(*(packs[c] for c in packs.column_names), strict=True):
            b = a + size.as_py()
            part = unpacked(tokens.as_py(), width + 2, b - a)
            words[:, a:b], marks[a:b] = part[:width], part[-1]
            words[:, a:b][part[:width] > top] += own
            # documents of a pack are in order
            change[a:b] = part[width] > 0
            change[a] = True
            ids.append(np.cumsum(part[width][change[a:b]]))
            cuts.append(cuts[-1] + len(ids[-1]))
            table.append(np.frombuffer(others.as_py(), np.uint64))
            own, a = own + len(table[-1]), b
        del packs, part, tokens
        group = Group(shared, np.concatenate(table), words, marks, told)
        group.judge(np.arange(len(marks), dtype=np.int32))
        some, root, q = group.unclear, group.root, group.q
        del group, words
        row = np.cumsum(change, dtype=np.int32) - 1
        sums = np.empty(cuts[-1], SUMS)
        sums["doc"] = np.concatenate(ids)
        sums["known"] = np.bincount(row[some], root > 1.5 / shared.below, len(sums))
        sums["base"] = np.bincount(row[some], np.log10(root), len(sums))
        sums["score"] = np.bincount(row, np.log10(q), len(sums))
        found = {"chunk": chunks, "sums": [sums[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]}
        return pa.concat_tables([docs, pa.Table.from_batches([_filled(JUDGED, docs["key"].type, found)])])

    return judge


def _added(rows: pa.Table) -> pa.Table:
    """A chunk's documents with the sums of all groups."""
    docs = rows.filter(pc.is_null(rows["sums"])).sort_by("row").select(list(DOCS))
    found = [np.frombuffer(x, SUMS) for x in rows["sums"].drop_null().to_pylist()]
    found = np.concatenate([np.zeros(0, SUMS), *found])
    for c in ("known", "base", "score"):
        whole = docs[c].to_numpy() + np.bincount(found["doc"], found[c], docs.num_rows)
        docs = docs.set_column(docs.column_names.index(c), c, pa.array(whole).cast(DOCS[c]))
    return docs


def score(docs: DataFrame, trains: Column, key: str = "doc_id", text: str = "text", depth: int = DEPTH, smoothing: float = SMOOTHING) -> DataFrame:
    """One row per input row: key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null and empty texts are one end.  Repeated rows train and score each for itself, a
    null key stays null, other columns are not read.  Without training rows every token
    has probability 1 at the root.  An empty table gives no rows.
    """
    workers.importable(docs.sparkSession)
    rows = docs.select(docs[key].alias("key"), trains.alias("trains"), docs[text].cast("string").alias("text"))
    kind = dict(rows.dtypes)["key"]
    read = rows.select("trains", "text")
    words = workers.stored(_counted(read, []))
    tokens, distinct, total = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("m"), F.lit(0))
    ).first()
    below = float(tokens + distinct + 1)
    chance = (F.col("n") + 1) / F.lit(below)
    levels, hot = [words.select("name", "n", "m", chance.alias("q"), chance.alias("root"))], []
    end = END_NAME
    while len(hot) < depth:
        names = levels[-1].where(F.col("m") > HOT).select("name").toArrow()["name"].to_numpy().view(np.uint64)  # at most one in HOT tokens
        if hot and end in hot[-1]:
            # contexts of ends only are counted after documents, not before them
            end = longer(np.array([end]), np.array([END_NAME]))[0]
            names = np.append(names, end)
        if not len(names):
            break
        hot.append(np.unique(names))
        levels.append(_level(_counted(read, hot), levels[-1], total, smoothing))
    table = levels[0]
    for level in levels[1:]:
        table = table.unionByName(level)
    # the most frequent names, TOP at most
    often = F.floor(8 * F.log2("m"))
    least, room = 0, TOP
    for r in sorted(table.groupBy(often.alias("often")).count().collect(), reverse=True):
        room -= r["count"]
        if room < 0:
            least = r["often"] + 1
            break
    top = table.where(often >= least).select("name", "m", "q", "root").toArrow()
    groups = max(1, -(-total // GROUP))
    sent = docs.sparkSession.sparkContext.broadcast(Shared(top, _seen_twice(words), hot, below, smoothing, depth, groups))
    told = _needs(read, sent).join(table.where(often < least).select("name", "q", "root"), "name").select("group", "name", "q", "root")
    found = _tokens(rows, sent, kind).groupBy("group").cogroup(told.groupBy("group")).applyInArrow(_judged(sent), _ddl(JUDGED, kind))
    return found.groupBy("chunk").applyInArrow(_added, _ddl(DOCS, kind)).select(
        "key", "held_out", "n_tokens", F.col("known").alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score"
    )
