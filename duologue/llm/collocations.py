"""Phrases whose words keep together, by marginalising counts of the longest windows.

Every word starts one window: itself and its successors inside its piece, padded with the
empty word where the piece ends.  Only these padded longest windows are counted.  A ROLLUP
over the window's columns then gives every shorter count as the sum of the windows it is a
prefix of, down to the number of words of a language; no shorter n-gram is ever listed.

Windows are counted inside a task first and shuffled once.  Windows (then leads) below the
least count fold into their prefix before the ROLLUP, which changes no count that a
candidate needs: parts of a candidate are at least as frequent as the candidate.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duologue.llm import workers

MAX_WORDS = 3
MIN_COUNT = 10
#: A phrase goes if a longer one has at least this percentage of its occurrences.
INSIDE_PERCENT = 50
TOP = 2000
SCALE = 1_000_000
UNKNOWN = "und"

#: Words a task collects before it counts their windows.
FLUSH_WORDS = 1 << 22
CHUNK_BYTES = 1 << 20
OUT_ROWS = 1 << 16

#: Windows of one first word go to one task; those of a first word with this share of a sample's
#: windows to ``SALTS`` tasks by the second word, and those of two such words by the last one.
#: The sample steers the layout only; the counts cover all rows.
HOT_SHARE = 500
SALTS = 64
SAMPLE = 0.01

#: Ends of pieces; none can lie in a word, so "." stands for all of them.
BREAKS = b".,;:!?\n\x0b\x0c\r"
_FROM = bytes(range(65, 91)) + BREAKS + b"\t"
_FOLD = bytes.maketrans(_FROM, bytes(range(97, 123)) + b"." * len(BREAKS) + b" ")


def chunks(text: bytes, limit: int) -> Iterator[bytes]:
    """Folded text in parts of about ``limit`` bytes, cut at spaces; a longer word stays whole."""
    folded = text.translate(_FOLD)
    start = 0
    while start < len(folded):
        end = len(folded) if start + limit >= len(folded) else folded.rfind(b" ", start, start + limit) + 1
        if not end:
            end = folded.find(b" ", start + limit) + 1 or len(folded)
        yield folded[start:end].replace(b".", b" . ")
        start = end


class Windows:
    """Counts the padded windows of one task, flush by flush.

    Words are numbered per flush; the numbers of a window fit one 64-bit key.
    """

    def __init__(self, order: int, hot: dict[str, list[tuple[bytes, ...]]]) -> None:
        self.order, self.hot = order, hot
        self.bits = 63 // order
        self.chunk = min(CHUNK_BYTES, 1 << (self.bits - 1))
        self.restart()

    def restart(self) -> None:
        self.numbers = workers.Numbering()
        assert self.numbers[b"."] == 0
        self.ids: dict[str, list[np.ndarray]] = {}
        self.held = 0

    def add(self, lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
        for part in chunks(text, self.chunk):
            if self.held >= FLUSH_WORDS or len(self.numbers) + len(part) // 2 + 1 >= 1 << self.bits:
                yield from self.flush(lang)
            words = part.split()
            self.held += len(words)
            self.ids.setdefault(lang, []).append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        if lang in self.ids:
            self.ids[lang].append(np.zeros(1, np.int32))

    def flush(self, unfinished: str | None = None) -> Iterator[pa.RecordBatch]:
        """Counted windows of all words held; the last words of an unfinished text stay for the next flush."""
        words = list(self.numbers)
        words[0] = b""  # the pad, first in order
        order = sorted(range(len(words)), key=words.__getitem__)
        rank = np.empty(len(words), np.int32)
        rank[order] = np.arange(len(words))
        ordered = [words[i] for i in order]
        texts = pa.array(ordered, pa.binary()).cast(pa.string())
        hashes = np.fromiter(map(crc32, ordered), np.int64, len(ordered))
        held, self.ids = self.ids, {}
        for lang, parts in held.items():
            ids = np.concatenate(parts)
            tail = ids[max(0, len(ids) - self.order + 1) :] if lang == unfinished else ids[:0]
            hot = [[int(rank[self.numbers[w]]) for w in lead] for lead in self.hot.get(lang, []) if all(w in self.numbers for w in lead)]
            yield from self.counted(lang, rank[ids], len(ids) - len(tail), texts, hashes, hot)
            held[lang] = [tail]
        self.restart()
        if unfinished in held and len(held[unfinished][0]):
            kept = [words[i] or b"." for i in held[unfinished][0].tolist()]
            self.ids[unfinished] = [np.array([self.numbers[w] for w in kept], np.int32)]

    def counted(self, lang: str, ids: np.ndarray, starts: int, texts: pa.Array, hashes: np.ndarray, hot: list[list[int]]) -> Iterator[pa.RecordBatch]:
        """Windows that begin at the first ``starts`` words: lead columns, counted."""
        padded = np.concatenate([ids, np.zeros(self.order, np.int32)])
        column = padded[:starts]
        key = column.astype(np.int64)
        for lead in range(1, self.order):
            column = np.where(column > 0, padded[lead : lead + starts], 0)
            key <<= self.bits
            key |= column
        key = key[padded[:starts] > 0]
        del padded, column
        key.sort()
        at = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
        found, counts = key[at], np.diff(at, append=len(key))
        del key, at
        firsts, pairs = [x for x, *y in hot if not y], [x << self.bits | y[0] for x, *y in hot if y]
        mask = (1 << self.bits) - 1
        for at in range(0, len(found), OUT_ROWS):
            some = found[at : at + OUT_ROWS]
            columns = [some >> self.bits * (self.order - 1 - j) & mask for j in range(self.order)]
            salt = np.where(np.isin(columns[0], firsts), 1 + hashes[columns[1]] % SALTS, 0)
            if pairs:
                salt = np.where(np.isin(some >> self.bits * (self.order - 2), pairs), 1 + SALTS + hashes[columns[-1]] % SALTS, salt)
            words = [texts.take(pa.array(c)) for c in columns]
            rest = pc.utf8_rtrim(pc.binary_join_element_wise(*words[1:], " "), " ")
            values = [pa.array([lang] * len(some), pa.string()), words[0], pa.array(salt, pa.int32()), rest, pa.array(counts[at : at + OUT_ROWS])]
            yield pa.RecordBatch.from_arrays(values, ["lang", "first", "salt", "rest", "c"])


def lead_windows(docs: DataFrame, lang: str = "lang", text: str = "text", order: int = MAX_WORDS, hot: list[tuple[str, ...]] = ()) -> DataFrame:
    """Windows as ``lang, first, salt, rest`` (the leads, pads left out) with partial counts ``c``; equal windows may come in several rows.

    ``hot`` lists languages with one or two first words of windows to be spread by the second
    or the last word; ``salt`` is the same wherever a window occurs.
    """
    workers.importable(docs.sparkSession)
    rows = docs.select(F.coalesce(docs[lang].cast("string"), F.lit(UNKNOWN)).alias("lang"), docs[text].cast("string").alias("text"))
    spread: dict[str, list[tuple[bytes, ...]]] = {}
    for name, *lead in hot:
        spread.setdefault(name, []).append(tuple(w.encode() for w in lead))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(order, spread)
        for batch in batches:
            langs, texts = batch["lang"].to_pylist(), batch["text"].cast(pa.binary())
            for i, name in enumerate(langs):
                value = texts[i].as_py()
                if value:
                    yield from windows.add(name, value)
        yield from windows.flush()

    return rows.mapInArrow(each, "lang string, first string, salt int, rest string, c long")


def hot_leads(sample: DataFrame) -> list[tuple[str, ...]]:
    """Languages with first words, and first two words, of ``HOT_SHARE`` or more of a sample's windows; ``HOT_SHARE`` of either at most."""
    lead = ["lang", "first", F.substring_index("rest", " ", 1).alias("second")]
    pairs = workers.stored(sample.groupBy(*lead).agg(F.count("*").alias("n")))
    total = pairs.agg(F.sum("n")).first()[0] or 0
    often = (F.col("n") * HOT_SHARE >= total) & (F.col("n") >= SALTS)
    firsts = pairs.groupBy("lang", "first").agg(F.sum("n").alias("n")).where(often).select("lang", "first")
    return [tuple(r) for r in firsts.collect() + pairs.where(often & (F.col("second") != "")).select("lang", "first", "second").collect()]


def prefix_counts(docs: DataFrame, lang: str = "lang", text: str = "text", order: int = MAX_WORDS, least: int = MIN_COUNT) -> DataFrame:
    """``lang, phrase, words, f``: all phrases of at most ``order`` words that occur ``least`` times, and one row of 0 words with the number of all.

    A null language counts as ``und``, a null text as empty; empty texts and tables give no
    rows; repeated rows count each time; other columns are not read.
    """
    words = [f"w{j + 1}" for j in range(order)]
    group = ["lang", "first", "salt"]
    hot = hot_leads(lead_windows(docs.sample(SAMPLE, seed=11), lang, text, order))
    windows = lead_windows(docs, lang, text, order, hot)
    counted = windows.repartition(*group).groupBy(*group, "rest").agg(F.sum("c").alias("c"))
    # Each window counts for its lead as a whole; one that is frequent has a row of its own, and adds nothing to what folds.
    full = F.length("rest") - F.length(F.translate("rest", " ", "")) == order - 2
    own = (F.col("c") >= least) & full & (F.col("rest") != "")
    lead = F.when(full, F.substring_index("rest", " ", order - 2)).otherwise(F.col("rest"))
    zero = F.lit(0).cast("long")
    itself = F.struct(F.col("rest").alias("rest"), F.col("c").alias("c"), zero.alias("whole"))
    others = F.struct(lead.alias("rest"), F.when(own, zero).otherwise(F.col("c")).alias("c"), F.col("c").alias("whole"))
    folded = counted.select(*group, F.explode(F.when(own, F.array(itself, others)).otherwise(F.array(others))).alias("x"))
    folded = folded.select(*group, "x.*").groupBy(*group, "rest").agg(F.sum("c").alias("c"), F.sum("whole").alias("whole"))
    # A lead below the least count loses its last word; spread ones are not whole here.
    rare = (F.col("whole") > 0) & (F.col("whole") < least) & (F.col("salt") <= SALTS) & (F.col("rest") != "")
    shorter = F.substring_index("rest", " ", order - 3) if order > 3 else F.lit("")
    small = folded.select("lang", "first", F.when(rare, shorter).otherwise(F.col("rest")).alias("rest"), "c")
    small = small.groupBy("lang", "first", "rest").agg(F.sum("c").alias("c"))
    leads = F.split("rest", " ")
    small = small.select("lang", F.col("first").alias(words[0]), *[F.coalesce(F.get(leads, F.lit(j)), F.lit("")).alias(w) for j, w in enumerate(words[1:])], "c")
    rolled = small.rollup("lang", *words).agg(F.grouping_id().alias("gone"), F.sum("c").alias("f"))
    # grouping_id has a bit for every column summed away; a shorter row whose last word is the pad is no phrase
    real = F.col("gone") == (1 << order) - 1
    for n in range(1, order + 1):
        real |= (F.col("gone") == (1 << (order - n)) - 1) & (F.col("f") >= least) & (F.col(words[n - 1]) != "")
    length = F.lit(order) - F.bit_count("gone")
    phrase = F.concat_ws(" ", *[F.when(length > j, F.col(w)) for j, w in enumerate(words)])
    return rolled.where(real).select("lang", phrase.alias("phrase"), length.alias("words"), "f")


def _key(phrase: Column) -> Column:
    """Language and phrase in one text; a phrase has no line end."""
    return F.concat(F.col("lang"), F.lit("\n"), phrase)


def _words(first: int, last: int) -> Column:
    return F.array_join(F.slice("w", first, last - first + 1), " ")


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    order: int = MAX_WORDS,
    least: int = MIN_COUNT,
    inside: int = INSIDE_PERCENT,
    top: int = TOP,
) -> DataFrame:
    """Each language's best phrases of 2 to ``order`` words: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` is the phrase's count, ``l`` and ``r`` those of the two parts of its weakest cut,
    ``n`` the language's words, ``score`` floor(10^6 a^2 / (l r)), exact in decimals.  Ties
    go to the earlier cut, and in the ranking to ``a``, then the phrase's bytes.  Phrases
    inside a longer one that has ``inside`` percent of their occurrences are left out.
    Nulls and empty tables as for ``prefix_counts``.
    """
    counts = workers.stored(prefix_counts(docs, lang, text, order, least))
    total = counts.where("words = 0").agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    parts = counts.where(F.col("words").between(1, order - 1)).select(_key(F.col("phrase")).alias("part"), F.col("f"), F.col("f").alias("n"))
    split = counts.where("words >= 2").select("lang", "words", _key(F.col("phrase")).alias("id"), F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    def side(k: int, name: str, phrase: Column) -> Column:
        return F.when(F.col("words") > k, F.struct(F.lit(k).alias("k"), F.lit(name).alias("side"), _key(phrase).alias("part")))

    cuts = [x for k in range(1, order) for x in (side(k, "l", _words(1, k)), side(k, "r", F.array_join(F.slice("w", k + 1, F.col("words") - k), " ")))]
    long = split.select("id", "a", F.explode(F.filter(F.array(*cuts), lambda x: x.isNotNull())).alias("x")).select("id", "a", "x.*")
    # A part meets at most f / least candidates, so parts below a thousandth of all words meet few.
    met = workers.join_counted(long, parts, "part", max(1, total)).select("id", "a", "k", "side", "f", F.lit(None).cast("long").alias("longer"))
    spans = [(i, j) for j in range(2, order + 1) for i in range(1, j) if j - i < order - 1]
    within = [F.when(F.col("words") >= j, F.when(F.col("words") > j - i + 1, _key(_words(i, j)))) for i, j in spans]
    if within:
        inner = split.select(F.explode(F.array_distinct(F.filter(F.array(*within), lambda x: x.isNotNull()))).alias("id"), F.col("a").alias("longer"))
        blank = [F.lit(None).cast(kind).alias(name) for name, kind in (("a", "long"), ("k", "int"), ("side", "string"), ("f", "long"))]
        met = met.unionByName(inner.select("id", *blank, "longer"))

    def part(k: int, name: str) -> Column:
        return F.max(F.when((F.col("k") == k) & (F.col("side") == name), F.col("f")))

    found = met.groupBy("id").agg(
        F.max("a").alias("a"), F.max("longer").alias("longer"), *[part(k, s).alias(f"{s}{k}") for k in range(1, order) for s in "lr"]
    )
    weakest = F.array_min(F.filter(F.array(*[_cut(k) for k in range(1, order)]), lambda x: x["score"].isNotNull()))
    scored = found.where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside)).select(
        F.regexp_extract("id", r"(?s)^(.*)\n", 1).alias("lang"), F.substring_index("id", "\n", -1).alias("phrase"), "a", weakest.alias("cut")
    )
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    sizes = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )


def _cut(k: int) -> Column:
    """Score of the cut after ``k`` words; smaller is weaker, then the earlier cut."""
    wide = "decimal(38,0)"
    a, both = F.col("a").cast("decimal(16,0)"), F.col(f"l{k}").cast("decimal(19,0)") * F.col(f"r{k}").cast("decimal(19,0)")
    score = F.call_function("div", (a * a * F.lit(SCALE)).cast(wide), both.cast(wide))
    return F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
