"""Quality rules: how much of a document lies in n-grams and lines it has more than once.

Documents of a batch are laid out as one array of word numbers.  A rolling hash gives
each n-gram a 64-bit code (longer ones from shorter ones by one multiplication and
addition), salted by document, so that one sort finds the repeats inside every document
at once; a running count of open windows then gives the characters they cover.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duologue.llm import workers

#: Words in windows of this length, found twice or more, make the base count.
BASE_WINDOW = 8
MIN_WORDS = 20
BASE_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
#: Bytes of text per numpy pass; a longer document makes a pass of its own.
PASS_BYTES = 1 << 20
MULTIPLIER = np.uint64(0x9DDFEA08EB382D69)


@dataclass(frozen=True)
class Rules:
    """Most that a kept document may have.  Fractions count every copy, the first included."""

    #: n-gram length -> fraction of the word characters inside repeated n-grams
    covered: dict[int, float] = field(default_factory=lambda: {5: 0.35, 6: 0.34, 7: 0.33, 8: 0.32, 9: 0.31, 10: 0.30})
    #: fraction of the lines that repeat an earlier one, and the number of lines from which it says something
    repeated_lines: float = 0.30
    min_lines: int = 10
    #: fraction of the characters in lines that repeat an earlier one
    repeated_line_chars: float = 0.30
    #: fraction of the words equal to the word before
    stutter: float = 0.30
    #: symbols for each word
    symbols: float = 0.10


@dataclass
class Counts:
    """Arrays with one number per document."""

    words: np.ndarray
    word_chars: np.ndarray
    symbols: np.ndarray
    lines: np.ndarray
    dup_lines: np.ndarray
    line_chars: np.ndarray
    dup_line_chars: np.ndarray
    repeat_words: np.ndarray
    stutters: np.ndarray
    covered: dict[int, np.ndarray]

    @property
    def base_failed(self) -> np.ndarray:
        return (self.words < MIN_WORDS) | (100 * self.repeat_words > BASE_PERCENT * self.words)

    def kept(self, rules: Rules) -> np.ndarray:
        bad = self.base_failed | (self.symbols > rules.symbols * self.words)
        bad |= (self.lines >= rules.min_lines) & (self.dup_lines > rules.repeated_lines * self.lines)
        bad |= self.stutters > rules.stutter * self.words
        bad |= self.dup_line_chars > rules.repeated_line_chars * self.line_chars
        for n, most in rules.covered.items():
            bad |= self.covered[n] > most * self.word_chars
        return ~bad


def repeated_cover(codes: np.ndarray, n: int, length: int) -> np.ndarray:
    """Which words lie in a window of ``n`` whose code occurs twice; ``codes`` has 0 where no window fits."""
    ordered = np.sort(codes)
    twice = ordered[1:][(ordered[1:] == ordered[:-1]) & (ordered[1:] != 0)]
    edge = np.zeros(length + 1, np.int32)
    if len(twice):
        twice = np.unique(twice)
        at = np.minimum(np.searchsorted(twice, codes), len(twice) - 1)
        begins = np.flatnonzero(twice[at] == codes)
        np.add.at(edge, begins, 1)
        np.add.at(edge, begins + n, -1)
    return np.cumsum(edge[:-1]) > 0


def _lines(text: bytes) -> tuple[int, int, int, int]:
    """Lines with a word, those equal to an earlier one, and the characters of both."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    if len(lines) < 2:
        return len(lines), 0, 0, 0
    once = set(lines)
    if len(once) == len(lines):
        return len(lines), 0, 0, 0
    total = sum(map(len, lines))
    return len(lines), len(lines) - len(once), total, total - sum(map(len, once))


def measure(texts: list[bytes], lengths: tuple[int, ...]) -> Iterator[Counts]:
    """Counts of consecutive groups of documents, in order."""
    for a, b in workers.groups_of([len(t) for t in texts], PASS_BYTES):
        yield _measure(texts[a:b], [t.split() for t in texts[a:b]], lengths)


def _measure(texts: list[bytes], docs: list[list[bytes]], lengths: tuple[int, ...]) -> Counts:
    ids, words, starts = workers.number_words(docs)
    points = np.fromiter((len(w.decode("utf-8", "replace")) for w in words), np.int64, len(words))
    chars = points[ids] if len(words) else np.zeros(0, np.int64)
    sizes = np.diff(starts)
    left = np.repeat(starts[1:], sizes) - np.arange(len(ids))  # words from here to the document's end
    salt = workers.mix64(np.repeat(np.arange(len(docs)), sizes))
    stutter = np.zeros(len(ids), bool)
    stutter[:-1] = (ids[1:] == ids[:-1]) & (left[:-1] > 1)
    mixed = workers.mix64(ids)
    rolling = mixed.copy()
    covered: dict[int, np.ndarray] = {}
    repeat_words = np.zeros(len(docs), np.int64)
    for n in range(2, max((BASE_WINDOW, *lengths)) + 1):
        fit = max(0, len(ids) - n + 1)
        rolling[:fit] = rolling[:fit] * MULTIPLIER + mixed[n - 1 : n - 1 + fit]
        if n != BASE_WINDOW and n not in lengths:
            continue
        codes = np.where(left >= n, (rolling ^ salt) | np.uint64(1), np.uint64(0))
        inside = repeated_cover(codes, n, len(ids))
        if n == BASE_WINDOW:
            repeat_words = workers.sums(inside, starts)
        if n in lengths:
            covered[n] = workers.sums(chars * inside, starts)
    lines = np.array([_lines(t) for t in texts], np.int64).reshape(-1, 4)
    symbols = np.fromiter((len(t) - len(t.translate(None, SYMBOLS)) for t in texts), np.int64, len(texts))
    return Counts(sizes, workers.sums(chars, starts), symbols, *(lines[:, i] for i in range(4)), repeat_words, workers.sums(stutter, starts), covered)


COLUMNS = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "base_failed": "boolean",
    "kept": "boolean",
    "max_cover": "double",
}


def _judge(texts: list[bytes], rules: Rules) -> list[pa.Array]:
    out: dict[str, list] = {c: [] for c in COLUMNS}
    for c in measure(texts, tuple(rules.covered)):
        most = np.max([x / np.maximum(1, c.word_chars) for x in c.covered.values()], axis=0) if c.covered else np.zeros(len(c.words))
        found = (c.words, c.word_chars, c.symbols, c.dup_lines, c.repeat_words, c.base_failed, c.kept(rules), most)
        for values, x in zip(out.values(), found, strict=True):
            values.append(x)
    kinds = {"long": np.int64, "boolean": bool, "double": np.float64}
    return [pa.array(np.concatenate(x) if x else np.zeros(0, kinds[k])) for x, k in zip(out.values(), COLUMNS.values(), strict=True)]


def judge(docs: DataFrame, rules: Rules | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, the counts, ``base_failed``, ``kept`` and the largest cover.

    A null or empty text has no words and is not kept.  Repeated rows are judged each for
    itself, a null key stays null, other columns are not read.  No shuffle; memory is an
    Arrow batch, or the largest document.
    """
    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    rules = rules or Rules()

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch["key"], *_judge(workers.utf8(batch["text"]), rules)], ["key", *COLUMNS])

    schema = ", ".join(f"{c} {k}" for c, k in {"key": dict(rows.dtypes)["key"], **COLUMNS}.items())
    return workers.map_batches(rows, each, schema)


def keep_good(docs: DataFrame, rules: Rules | None = None, text: str = "text") -> DataFrame:
    """The rows whose text passes, with their columns as they are."""
    workers.importable(docs.sparkSession)
    rules = rules or Rules()

    def passes(texts: pa.Array) -> pa.Array:
        return _judge(workers.utf8(texts), rules)[list(COLUMNS).index("kept")]

    return docs.where(F.arrow_udf(passes, "boolean")(docs[text].cast("string")))
