"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Kinds ``email``, ``ip``, ``card`` and ``phone`` are found by fixed patterns, leftmost and
without overlap within a kind, and stay once their check passes.  ``iban`` (mod-97) and
``national_id`` (digit groups that need context) come on top where they overlap none of
these.  Every pattern runs in time linear in the text, also on runs of one character.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duologue.llm import workers

KINDS = ["email", "ip", "card", "phone", "iban", "national_id"]
BASE = KINDS[:4]

# An address is found by its "@": the local part is the run of its characters before it.
AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Digit runs never give digits back, so a match can only begin where a run begins.
NUMBERS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DIGIT = re.compile(r"[0-9]")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PLUS = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
#: Characters of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28,
    "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18,
    "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32,
    "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15,
    "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25,
    "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
GROUPS = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

#: Score before context, after the kind's check.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "national_id": 0.3}
#: Words near a span that speak for its kind.
CONTEXT = {
    "email": ["mail", "email", "e-mail", "contact", "kontakt", "correo", "courriel"],
    "ip": ["ip", "host", "server", "login", "addr", "address"],
    "card": ["card", "visa", "karte", "kreditkarte", "carte", "tarjeta", "credit"],
    "phone": ["phone", "telephone", "telefon", "tel", "call", "fax", "mobil", "mobile", "móvil"],
    "iban": ["iban", "bank", "konto", "compte", "cuenta"],
    "national_id": ["ssn", "social", "security", "identity", "passport", "ausweis"],
}
CONTEXT_BONUS, CONTEXT_WIDTH, THRESHOLD = 0.3, 40, 0.5
#: Whole words: "ship" says nothing about an ip.
WORDS = re.compile(r"\w+")
NEAR_WORDS = {kind: frozenset(words) for kind, words in CONTEXT.items()}

SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def mod97(iban: str) -> bool:
    plain = iban.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _emails(text: str):
    last = 0
    for m in AT.finditer(text):
        start = at = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            yield start, m.end()
            last = m.end()


def _ips(text: str):
    for m in NUMBERS.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
            yield m.span()


def _cards(text: str):
    for m in DIGITS.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str):
    for m in PLUS.finditer(text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()


def _ibans(text: str):
    """Candidates cut to their country's length, so that capitals behind one do not spoil it; other countries' as they are."""
    at = 0
    while m := IBAN.search(text, at):
        at = m.end()
        length = IBAN_LENGTHS.get(m.group()[:2])
        whole = m.group()
        if length:
            ends = [i for i, c in enumerate(whole, 1) if c != " "]
            if len(ends) < length:
                continue
            whole = whole[: ends[length - 1]]
            if text[m.start() + len(whole) : m.start() + len(whole) + 1].isalnum():
                continue
        if mod97(whole):
            yield m.start(), m.start() + len(whole)
            at = m.start() + len(whole)


def _groups(text: str):
    return (m.span() for m in GROUPS.finditer(text) if m.group()[:3] not in ("000", "666") and m.group()[0] != "9")


FINDERS = dict(zip(KINDS, [_emails, _ips, _cards, _phones, _ibans, _groups], strict=True))


def score(kind: str, text: str, start: int, end: int) -> float:
    near = (text[max(0, start - CONTEXT_WIDTH) : start] + " " + text[end : end + CONTEXT_WIDTH]).casefold()
    return min(1.0, PRIOR[kind] + CONTEXT_BONUS * (not NEAR_WORDS[kind].isdisjoint(WORDS.findall(near))))


def find(text: str) -> list[tuple[str, int, int, float]]:
    """Spans (kind, start, end, score) by start, then kind; positions are code points."""
    found = []
    if "@" in text:
        found += [("email", *s) for s in _emails(text)]
    if DIGIT.search(text):
        for kind in KINDS[1:]:
            if kind != "phone" or "+" in text:
                found += [(kind, *s) for s in FINDERS[kind](text)]
    if not found:
        return []
    base = sorted((s, e) for k, s, e in found if k in BASE)
    out = []
    for kind, s, e in found:
        points = score(kind, text, s, e)
        if kind in BASE or points >= THRESHOLD and not any(a < e and s < b for a, b in base):
            out.append((kind, s, e, points))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def merged(spans: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int]]:
    """Overlapping spans as one, under the kind of the first."""
    out: list[tuple[str, int, int]] = []
    for kind, s, e, _ in spans:
        if out and s < out[-1][2]:
            out[-1] = (out[-1][0], out[-1][1], max(e, out[-1][2]))
        else:
            out.append((kind, s, e))
    return out


def mask(text: str) -> str:
    """The text with each span replaced by its kind in angle brackets."""
    parts, last = [], 0
    for kind, s, e in merged(find(text)):
        parts += [text[last:s], f"<{kind.upper()}>"]
        last = e
    return "".join([*parts, text[last:]]) if last else text


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, spans (by start, then kind) and ``digest``, the SHA-256 of the base spans.

    Null and empty texts have no spans.  Repeated rows are judged each for itself, a null
    key stays null, other columns are not read.  No shuffle.
    """
    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    kind = dict(rows.dtypes)["key"]
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def spans_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [find(t) for t in workers.strings(batch["text"])]
        joined = [",".join(f"{k}:{s}:{e}" for k, s, e, _ in x if k in BASE) for x in spans]
        listed = [[{"kind": k, "start": s, "end": e, "score": p} for k, s, e, p in x] for x in spans]
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in joined]
        return pa.RecordBatch.from_arrays(
            [batch["key"], pa.array(listed, pa.list_(item)), pa.array(digests, pa.string())], ["key", "spans", "digest"]
        )

    return workers.map_batches(rows, spans_of, f"key {kind}, spans {SPANS}, digest string")


def masked(text: Column) -> Column:
    """A text column with personal data replaced; null stays null."""

    def replace(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else mask(t) for t in texts.to_pylist()], pa.string())

    return F.arrow_udf(replace, "string")(text)


def mask_documents(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The same rows and columns with masked texts; a length column follows the text."""
    workers.importable(docs.sparkSession)
    out = docs.withColumn(text, masked(docs[text].cast("string")))
    if length in docs.columns:
        known = dict(docs.dtypes)[length]
        out = out.withColumn(length, F.coalesce(F.length(text).cast(known), F.col(length)))
    return out.select(*docs.columns)
