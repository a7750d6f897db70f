"""Language-model scores from a probabilistic suffix tree over words.

Tokens are lower-cased words and one end per document.  The root of the tree predicts by
add-one counts.  Longer contexts (the last one, two, three tokens) are grown level by
level: a context is tried if it makes up at least ``SHARE`` of the training tokens, and
stays if its next tokens diverge from what its longest kept suffix predicts: if each is
likelier given the context's other tokens, in total, than by the suffix alone.  A kept context's distribution is smoothed with its
suffix's, and a token is scored in the longest kept suffix of what comes before it.

What is broadcast has a bound in shares of the corpus: words of at least ``FREQUENT``
of all tokens are symbols of their own (at most 1/FREQUENT of them), all others are one
symbol that the root divides by their counts; contexts are at most 1/SHARE for each level,
their entries at most 1/ENTRY.  The counts behind them, and those of every other word, are
tables that grow with the corpus; rarer words are looked up by a join.  ``suffix_counts``
has the whole tree, without shares.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duologue.llm import workers

DEPTH = 3
FREQUENT = 2.0**-18
SHARE = 2.0**-13
ENTRY = 2.0**-21
#: Weight of the suffix's prediction, in tokens.
SMOOTHING = 16.0
#: The end of a document; no word is a space.
END = b" "
#: Distinct words or codes a task holds before it hands them on.
HELD = 200_000
#: Bytes of text that are split into words at once; a longer document makes a pass of its own.
PASS_BYTES = 2 << 20


def _lower_words(texts: list[bytes]) -> Iterator[list[bytes]]:
    return (t.lower().split() for t in texts)


def vocabulary(rows: DataFrame) -> DataFrame:
    """(token, trained, total) over all documents of ``rows`` (key, trains, text), stored."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (Counter(), Counter())  # other documents, training documents

        def flush() -> Iterator[pa.RecordBatch]:
            for trains, counts in enumerate(held):
                n = pa.array(counts.values(), pa.int64())
                trained = n if trains else pa.array(np.zeros(len(counts), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()).cast(pa.string()), trained, n], ["token", "trained", "total"])
                counts.clear()

        for batch in batches:
            trains = batch["trains"].to_pylist()
            for i, words in enumerate(_lower_words(workers.utf8(batch["text"]))):
                counts = held[trains[i]]
                counts.update(words)
                counts[END] += 1
                if len(held[0]) + len(held[1]) > HELD:
                    yield from flush()
        yield from flush()

    counted = rows.select("trains", "text").mapInArrow(count, "token string, trained long, total long")
    return workers.stored(counted.groupBy("token").agg(F.sum("trained").alias("trained"), F.sum("total").alias("total")))


@dataclass
class Model:
    """The tree and the frequent words; of bounded size."""

    #: word -> row of ``symbol`` and ``base``
    words: dict[bytes, int]
    #: symbol of each frequent word; the last symbol stands for all rarer words
    symbol: np.ndarray
    #: log10 of each frequent word's root probability, and whether it was trained
    base: np.ndarray
    known: np.ndarray
    tokens: int
    distinct: int
    root: np.ndarray
    #: per level, codes (context's suffix, older symbol) in order and the contexts they lead to
    levels: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    #: per context: nearest kept suffix or itself (0 is the root), and that of the kept ones' suffixes
    state: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    parent: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    #: per context, what the suffix's prediction is multiplied by where there is no entry
    back: np.ndarray = field(default_factory=lambda: np.ones(1))
    #: codes (context, symbol) in order and their smoothed probabilities
    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    probs: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @property
    def symbols(self) -> int:
        return len(self.root)

    @property
    def rare(self) -> int:
        return len(self.root) - 1

    def probability(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Probability of symbols in kept contexts (or the root)."""
        out, factor = np.empty(len(state)), np.ones(len(state))
        open_, state = np.arange(len(state)), state.copy()
        while len(open_):
            at_root = state[open_] == 0
            done = open_[at_root]
            out[done] = factor[done] * self.root[symbol[done]]
            open_ = open_[~at_root]
            code = state[open_] * self.symbols + symbol[open_]
            at = np.minimum(np.searchsorted(self.codes, code), max(0, len(self.codes) - 1))
            hit = self.codes[at] == code if len(self.codes) else np.zeros(len(code), bool)
            done = open_[hit]
            out[done] = factor[done] * self.probs[at[hit]]
            open_ = open_[~hit]
            factor[open_] *= self.back[state[open_]]
            state[open_] = self.parent[state[open_]]
        return out

    def contexts(self, flat: np.ndarray, places: np.ndarray) -> list[np.ndarray]:
        """For each level, the context before every place (0: none)."""
        out, now = [], np.zeros(len(places), np.int64)
        for level, (codes, nodes) in enumerate(self.levels):
            code = now * self.symbols + flat[places - 1 - level]
            at = np.minimum(np.searchsorted(codes, code), max(0, len(codes) - 1))
            hit = codes[at] == code if len(codes) else np.zeros(len(code), bool)
            if level:
                hit &= now > 0
            now = np.where(hit, nodes[at] if len(codes) else 0, 0)
            out.append(now)
        return out


def _model(vocab: DataFrame, frequent: float) -> Model:
    tokens, distinct, total = vocab.agg(
        F.coalesce(F.sum("trained"), F.lit(0)), F.count(F.when(F.col("trained") > 0, 1)), F.coalesce(F.sum("total"), F.lit(0))
    ).first()
    # every row takes at least a fixed share of all tokens, so there are at most 1 / share
    rows = vocab.where((F.col("total") >= frequent * total) | (F.col("token") == END.decode())).toArrow()
    rows = rows.sort_by([("trained", "descending"), ("token", "ascending")])
    trained = rows["trained"].to_numpy()
    words = {w: i for i, w in enumerate(rows["token"].cast(pa.binary()).to_pylist())}
    own = int((trained > 0).sum())
    below = tokens + distinct + 1
    base = np.log10((trained + 1.0) / below)
    root = np.append((trained[:own] + 1.0) / below, 0)
    root[-1] = (below - (trained[:own] + 1).sum()) / below
    return Model(words, np.minimum(np.arange(len(trained)), own), base, trained > 0, tokens, distinct, root)


def _flat(model: Model, texts: list[bytes], depth: int) -> Iterator[tuple[int, list[list[bytes]], np.ndarray, np.ndarray, np.ndarray]]:
    """Passes over documents: the first one's number, their words, rows of all tokens (-1: rare), symbols with ends before each document, places of the tokens there."""
    end = model.words.get(END, -1)
    for a, b in workers.groups_of([len(t) for t in texts], PASS_BYTES):
        docs = list(_lower_words(texts[a:b]))
        sizes = np.array([len(d) + 1 for d in docs], np.int64)
        rows = np.empty(int(sizes.sum()), np.int64)
        upto = np.cumsum(sizes)
        inner = np.ones(len(rows), bool)
        inner[upto - 1] = False
        get = model.words.get
        rows[inner] = np.fromiter((get(w, -1) for d in docs for w in d), np.int64, int(inner.sum()))
        rows[~inner] = end
        symbols = np.where(rows >= 0, model.symbol[rows], model.rare)
        places = np.arange(len(rows)) + depth * np.repeat(np.arange(1, len(sizes) + 1), sizes)
        flat = np.full(len(rows) + depth * len(sizes), model.symbol[end] if end >= 0 else model.rare)
        flat[places] = symbols
        yield a, docs, rows, flat, places


def _merge(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.concatenate([c for c, _ in held])
    counts = np.concatenate([n for _, n in held])
    codes, at = np.unique(codes, return_inverse=True)
    return codes, np.bincount(at, counts, len(codes)).astype(np.int64)


def _level_counts(rows: DataFrame, model: Model, depth: int) -> DataFrame:
    """(older, context, symbol, n), stored: how often contexts of the newest level come before each next symbol (older false), or after each older one."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, held, size = sent.value, {True: [], False: []}, 0
        level = len(tree.levels)

        def flush() -> Iterator[pa.RecordBatch]:
            for older, parts in held.items():
                if parts:
                    codes, n = _merge(parts)
                    parts.clear()
                    context, symbol = np.divmod(codes, tree.symbols)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), older)), *map(pa.array, (context, symbol, n))], ["older", "context", "symbol", "n"])

        for batch in batches:
            for _, _, _, flat, places in _flat(tree, workers.utf8(batch["text"]), depth):
                context = tree.contexts(flat, places)[-1]
                some = np.flatnonzero(context)
                for older, other in ((False, flat[places[some]]), (True, flat[places[some] - 1 - level] if level < depth else None)):
                    if other is not None:
                        codes, n = np.unique(context[some] * tree.symbols + other, return_counts=True)
                        held[older].append((codes, n))
                        size += len(codes)
                if size > 10 * HELD:
                    yield from flush()
                    size = 0
        yield from flush()

    counted = rows.where("trains").select("text").mapInArrow(count, "older boolean, context long, symbol long, n long")
    return workers.stored(counted.groupBy("older", "context", "symbol").agg(F.sum("n").alias("n")))


def _diverging(counts: DataFrame, model: Model, suffix: dict[int, int], smoothing: float) -> dict[int, int]:
    """Kept contexts of a level, with their counts.

    The log-likelihood gain of a token is what the context's other tokens and its suffix
    predict for it, against its suffix alone; what was seen once proves nothing.
    """
    sums = {r.context: r.c for r in counts.where("not older").groupBy("context").agg(F.sum("n").alias("c")).collect()}  # at most 1 / SHARE
    sent = counts.sparkSession.sparkContext.broadcast((model, suffix, sums))

    def gains(batch: pa.RecordBatch) -> pa.RecordBatch:
        tree, below, total = sent.value
        context, symbol, n = (batch[c].to_numpy() for c in ("context", "symbol", "n"))
        nodes, at = np.unique(context, return_inverse=True)
        before = tree.state[np.array([below[c] for c in nodes.tolist()], np.int64)][at]
        whole = np.array([total[c] for c in nodes.tolist()], float)[at]
        chance = tree.probability(before, symbol)
        gain = n * np.log((n - 1 + smoothing * chance) / ((whole - 1 + smoothing) * chance))
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.bincount(at, gain, len(nodes)))], ["context", "gain"])

    terms = workers.map_batches(counts.where("not older").select("context", "symbol", "n"), gains, "context long, gain double")
    kept = terms.groupBy("context").agg(F.sum("gain").alias("gain")).where("gain > 0").collect()
    return {r.context: sums[r.context] for r in kept}


def train(
    rows: DataFrame,
    depth: int = DEPTH,
    frequent: float = FREQUENT,
    share: float = SHARE,
    entry: float = ENTRY,
    smoothing: float = SMOOTHING,
) -> tuple[Model, DataFrame]:
    """The model and the stored vocabulary of ``rows`` (trains, text)."""
    vocab = vocabulary(rows)
    model = _model(vocab, frequent)
    # first level: a context for each symbol that is frequent enough
    enough = np.flatnonzero(model.root * (model.tokens + model.distinct + 1) - 1 >= max(1, share * model.tokens))
    codes, suffix = enough, dict.fromkeys(range(1, len(enough) + 1), 0)
    first = 1
    while len(codes) and len(model.levels) < depth:
        nodes = np.arange(first, first + len(codes))
        model.levels.append((codes, nodes))
        model.state = np.append(model.state, model.state[[suffix[c] for c in nodes.tolist()]])
        model.parent = np.append(model.parent, np.zeros(len(nodes), np.int64))
        model.back = np.append(model.back, np.ones(len(nodes)))
        counts = _level_counts(rows, model, depth)
        kept = _diverging(counts, model, suffix, smoothing)
        if kept:
            # entries take a share of the tokens each, so a level has at most 1 / share
            wanted = counts.where("not older").where(F.col("n") >= entry * model.tokens)
            found = wanted.select("context", "symbol", "n").toArrow()
            context, symbol, n = (found[c].to_numpy() for c in ("context", "symbol", "n"))
            total = np.zeros(first + len(codes))
            total[list(kept)] = list(kept.values())
            own = total[context] > 0
            context, symbol, n = context[own], symbol[own], n[own]
            listed = np.bincount(context, n, len(total))
            for c in kept:
                model.parent[c] = model.state[suffix[c]]
                model.back[c] = (total[c] - listed[c] + smoothing) / (total[c] + smoothing)
            before = model.probability(model.parent[context], symbol)
            probs = n / (total[context] + smoothing) + model.back[context] * before
            for c in kept:
                model.state[c] = c
            code = context * model.symbols + symbol
            order = np.argsort(np.append(model.codes, code), kind="stable")
            model.codes, model.probs = np.append(model.codes, code)[order], np.append(model.probs, probs)[order]
        longer = counts.where("older").where(F.col("n") >= max(1, share * model.tokens)).orderBy("context", "symbol").toArrow()
        codes = longer["context"].to_numpy() * model.symbols + longer["symbol"].to_numpy()
        first += len(nodes)
        suffix = dict(zip(range(first, first + len(codes)), longer["context"].to_pylist(), strict=True))
    return model, vocab


PARTS = "row long, key {}, held_out boolean, n_tokens long, n_known long, base double, tree double, rare array<string>, times array<int>"


def score(docs: DataFrame, trains: Column, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per input row: key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null and empty texts are one end.  Repeated rows train and score each for itself, a
    null key stays null, other columns are not read.  Without training rows every token
    has probability 1 at the root.  An empty table gives no rows.
    """
    workers.importable(docs.sparkSession)
    rows = docs.select(docs[key].alias("key"), trains.alias("trains"), docs[text].cast("string").alias("text"))
    kind = dict(rows.dtypes)["key"]
    depth = options.get("depth", DEPTH)
    model, vocab = train(rows, **options)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = sent.value
        state_of, row = tree.state, TaskContext.get().partitionId() << 33
        rare_root = np.log10(tree.root[tree.rare])
        for batch in batches:
            for first, words, found, flat, places in _flat(tree, workers.utf8(batch["text"]), depth):
                state = np.zeros(len(places), np.int64)
                for node in tree.contexts(flat, places):
                    state = np.where(node > 0, state_of[node], state)
                symbol = flat[places]
                points = np.log10(tree.probability(state, symbol))
                base = np.where(found >= 0, tree.base[found], 0.0)
                # a rare word's share of the rare symbol is its share at the root
                points += np.where(symbol == tree.rare, base - rare_root, 0.0)
                starts = np.zeros(len(words) + 1, np.int64)
                np.cumsum([len(d) + 1 for d in words], out=starts[1:])
                rare = [Counter(d[i] for i in np.flatnonzero(found[s : s + len(d)] < 0).tolist()) for d, s in zip(words, starts.tolist(), strict=False)]
                arrays = [
                    pa.array(row + np.arange(len(words))),
                    batch["key"].slice(first, len(words)),
                    pa.array([not t for t in batch["trains"].slice(first, len(words)).to_pylist()]),
                    pa.array(np.diff(starts)),
                    pa.array(workers.sums((found >= 0) & tree.known[found], starts)),
                    pa.array(workers.sums(base, starts)),
                    pa.array(workers.sums(points, starts)),
                    pa.array([list(c) for c in rare], pa.list_(pa.binary())).cast(pa.list_(pa.string())),
                    pa.array([list(c.values()) for c in rare], pa.list_(pa.int32())),
                ]
                row += len(words)
                yield pa.RecordBatch.from_arrays(arrays, ["row", "key", "held_out", "n_tokens", "n_known", "base", "tree", "rare", "times"])

    parts = workers.stored(rows.mapInArrow(part, PARTS.format(kind)))
    below = float(model.tokens + model.distinct + 1)
    seen = vocab.where("trained > 0").select("token", "trained")
    single = parts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("token"), F.col("x.times").alias("times"))
    looked = single.join(seen, "token", "left").groupBy("row").agg(
        F.sum(F.when(F.col("trained") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10((F.coalesce("trained", F.lit(0)) + 1) / F.lit(below))).alias("rare_base"),
    )
    rest = F.coalesce("rare_base", F.lit(0.0))
    return parts.drop("rare", "times").join(looked, "row", "left").select(
        "key",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + rest).alias("base_score"),
        (F.col("tree") + rest).alias("score"),
    )
