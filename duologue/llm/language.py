"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training adds up n-gram counts per language and hash bucket over all labelled texts
(numpy counts per batch, one summing shuffle).  The log-probability matrix, languages by
buckets, is broadcast; scoring looks up all n-grams of a batch and sums by document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duologue.llm import workers

LENGTHS = (1, 2, 3)
BUCKETS = 1 << 16
#: Languages a model may have; beyond it, training stops with an error, so that the
#: broadcast matrix is at most MAX_LANGUAGES * BUCKETS * 4 bytes.
MAX_LANGUAGES = 500
SMOOTHING = 0.5
UNKNOWN = "und"
#: Characters per numpy pass; a longer document makes a pass of its own.
PASS_CHARS = 1 << 19


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    #: one row per bucket, so that an n-gram's scores lie together
    log_prob: np.ndarray


def ngram_buckets(texts: list[str], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: buckets of all n-grams in a row, and each document's first one (one more at the end).

    Texts are lower-cased and have a space before and after.
    """
    padded = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(p) for p in padded], out=starts[1:])
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(points))
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    code = np.zeros(len(points), np.uint64)
    for n in range(1, max(LENGTHS) + 1):
        if len(points) < n:
            return
        code = code[: len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1 :] + np.uint64(1)
        if n not in LENGTHS:
            continue
        fits = left[: len(code)] >= n
        hashed = (((code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64)[fits]
        counts = np.maximum(np.diff(starts) - (n - 1), 0)
        firsts = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(counts, out=firsts[1:])
        yield hashed, firsts


def _batches(texts: list[str]) -> Iterator[tuple[int, int]]:
    return workers.groups_of([len(t) + 2 for t in texts], PASS_CHARS)


def train(docs: DataFrame, lang: Column, text: Column, buckets: int = BUCKETS) -> Model:
    """Fit on every row with a language and a text.

    Only the summed counts, languages times buckets, come to the driver.  Texts that are
    null teach nothing; no rows give a model without languages.
    """
    workers.importable(docs.sparkSession)
    rows = docs.select(lang.cast("string").alias("lang"), text.cast("string").alias("text")).where("lang is not null and text is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch["lang"].to_pylist(), workers.strings(batch["text"])
            by_lang: dict[str, list[str]] = {}
            for name, t in zip(langs, texts, strict=True):
                by_lang.setdefault(name, []).append(t)
            for name, own in by_lang.items():
                total = totals.setdefault(name, np.zeros(buckets + 1, np.int64))
                total[buckets] += len(own)  # documents, behind the buckets
                for a, b in _batches(own):
                    for hashed, _ in ngram_buckets(own[a:b], buckets):
                        total[:buckets] += np.bincount(hashed, minlength=buckets)
            if len(totals) > 2 * MAX_LANGUAGES:  # hand on what there is rather than hold it
                yield from _counted(totals)
                totals = {}
        yield from _counted(totals)

    def _counted(totals: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(total[at])], ["lang", "bucket", "n"])

    counts = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # languages are few and checked: no more than that many rows of one dense array each
    dense = counts.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("by_bucket"))
    found = dense.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    matrix = np.zeros((len(found), buckets + 1))
    for i, row in enumerate(found):
        matrix[i, list(row.by_bucket)] = list(row.by_bucket.values())
    priors, grams = matrix[:, buckets], matrix[:, :buckets] + SMOOTHING
    log_prior = np.log(np.maximum(priors, 1) / max(1, priors.sum()))
    return Model([r.lang for r in found], log_prior, np.log(grams / grams.sum(axis=1, keepdims=True)).T.astype(np.float32).copy())


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict_texts(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Language and its posterior for each text; unknown with 0 where there is no letter."""
    k = len(model.languages)
    names, best = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not k:
        return names, best
    buckets = len(model.log_prob)
    for a, b in _batches(texts):
        total = np.tile(model.log_prior, (b - a, 1))
        for hashed, firsts in ngram_buckets(texts[a:b], buckets):
            rows = np.flatnonzero(np.diff(firsts))
            for i in range(k):
                total[rows, i] += np.add.reduceat(model.log_prob[:, i][hashed], firsts[rows], dtype=np.float64)
        total -= total.max(axis=1, keepdims=True)
        chance = np.exp(total)
        chance /= chance.sum(axis=1, keepdims=True)
        top = chance.argmax(axis=1)
        for j in range(a, b):
            if has_letter(texts[j]):
                names[j] = model.languages[top[j - a]]
                best[j] = chance[j - a, top[j - a]]
    return names, best


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, ``lang_pred`` and ``score`` (the posterior).

    Null texts and texts without a letter are ``und`` with score 0, as is every text if
    nothing was learned.  Ties go to the first language in order.  Repeated rows are
    judged each for itself, a null key stays null, other columns are not read.  No shuffle.
    """
    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, best = predict_texts(sent.value, workers.strings(batch["text"]))
        return pa.RecordBatch.from_arrays([batch["key"], pa.array(names, pa.string()), pa.array(best)], ["key", "lang_pred", "score"])

    return workers.map_batches(rows, each, f"key {dict(rows.dtypes)['key']}, lang_pred string, score double")
