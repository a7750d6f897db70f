"""Cheapest edits that give conversations a legal order of roles, by branch and bound.

A conversation is legal when its roles' initials read ``(s?(ua)+)?``.  Every turn is kept
(0), given the role that is due (1) or deleted (2, a must for blank and repeated turns);
empty turns of the due role may be inserted anywhere (5); a truncated turn that stays
costs 5 more.  Of the cheapest edit strings the least one in ASCII order wins.

The search is depth-first with an explicit stack.  A prefix is given up when its cost plus
the least cost of the turns to come exceeds the incumbents, or when a better prefix (by
cost, then edits) reached the same turn in the same state: of two prefixes of equal cost
there, neither continues the other (insertions cost), so the smaller stays smaller.

Turns are range partitioned by conversation and order and cut into short segments, so that
a conversation of any length is searched by many tasks.  A segment gives its best edits
from each state to each state, and these compose.  Only what must be in order, the fold of
segments and the digest of the repaired text, streams through one task per conversation.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duologue.llm import workers

SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Turns of a segment; results do not depend on it, the work of a search grows with its square.
SEGMENT = 12

#: States: nothing yet, after the system turn, a user turn open, a pair closed.
START, SYSTEM, OPEN, CLOSED = range(4)
DUE = {START: "user", SYSTEM: "user", OPEN: "assistant", CLOSED: "user"}
AFTER_DUE = {START: OPEN, SYSTEM: OPEN, OPEN: CLOSED, CLOSED: OPEN}
#: Insertions a conversation still needs when its turns end in a state.
MISSING = {START: 0, SYSTEM: 2, OPEN: 1, CLOSED: 0}
FINE, GONE, CUT = range(3)


def damaged(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns with planted faults, by CRC-32 of ``key:turn`` modulo 20; ``key, turn, role, text``.

    0 drops a row, 1 empties its text, 2 removes ends of sentences, 3 repeats it, 4 makes
    it the user's.  Nulls become one space (in the checksum too), but a null key or turn
    stays null as a column.
    """
    rows = conversations.select(
        conversations[key].alias("key"),
        conversations[turn].cast("long").alias("turn"),
        F.coalesce(conversations[role].cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(conversations[text].cast("string"), F.lit(" ")).alias("text"),
    )
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("key", "turn")])
    fault = F.crc32(name.cast("binary")) % 20
    body = F.when(fault == 1, "").when(fault == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text"))
    rows = rows.select("key", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"), body.alias("text"), fault.alias("fault"))
    again = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.where("fault <> 0").select("key", "turn", "role", "text", again.alias("copy")).drop("copy")


def edits_of(code: int, state: int) -> list[tuple[str, int, int]]:
    """What may be done with one turn in a state: letter, cost, next state.  A code is the initial's class plus 4 times the fault."""
    kind, fault = code % 4, code // 4
    out = [("D", DELETE, state)]
    if fault != GONE:
        more = TRUNCATED if fault == CUT else 0
        if (kind == 0 and state == START) or (kind == 1 and state != OPEN) or (kind == 2 and state == OPEN):
            out.append(("K", KEEP + more, SYSTEM if kind == 0 else AFTER_DUE[state]))
        out.append(("R", REROLE + more, AFTER_DUE[state]))
    return out


MOVES = [[edits_of(code, state) for state in range(4)] for code in range(12)]
#: The least a turn can cost in any state, and the least two turns in a row can.
LEAST = [min(cost for moves in states for _, cost, _ in moves) for states in MOVES]
LEAST_PAIR = [
    [
        min(a + INSERT * (middle != after) + b for state in range(4) for _, a, middle in MOVES[x][state] for after in {middle, AFTER_DUE[middle]} for _, b, _ in MOVES[y][after])
        for y in range(12)
    ]
    for x in range(12)
]


def search(codes: list[int], entry: int) -> list[tuple[int, str] | None]:
    """Per exit state the cheapest (cost, edits) of a segment entered in ``entry``; None where it can't be reached.

    Insertions before a turn belong to it, those after the last one to whatever follows.
    """
    n = len(codes)
    bound = [0] * (n + 1)
    system_at = -1
    for i in range(n - 1, -1, -1):
        bound[i] = bound[i + 1] + LEAST[codes[i]]
        if i + 1 < n:
            bound[i] = max(bound[i], bound[i + 2] + LEAST_PAIR[codes[i]][codes[i + 1]])
        if system_at < 0 and codes[i] % 4 == 0 and codes[i] // 4 != GONE:
            system_at = i
    incumbents: list[tuple[int, str] | None] = [None] * 4
    best = {(0, entry): (0, "")}
    stack = [(0, "", 0, entry)]
    while stack:
        cost, audit, i, state = stack.pop()
        if best[i, state] != (cost, audit):
            continue  # a better prefix came here since
        if i == n:
            incumbents[state] = (cost, audit)
            continue
        exits = [OPEN, CLOSED]
        if state in (START, SYSTEM):
            exits.append(state)
            if state == START and i <= system_at:
                exits.append(SYSTEM)
        least = cost + bound[i]
        if all(incumbents[x] is not None and least > incumbents[x][0] for x in exits):
            continue
        children = [(cost + c, audit + letter, i + 1, s) for letter, c, s in MOVES[codes[i]][state]]
        children.append((cost + INSERT, audit + "I", i, AFTER_DUE[state]))
        children.sort(key=lambda x: (x[0] + bound[x[2]], -x[2], x[1]), reverse=True)  # the most promising on top
        for child in children:
            known = best.get(child[2:])
            if known is None or child[:2] < known:
                best[child[2:]] = child[:2]
                stack.append(child)
    return incumbents


class Fold:
    """Best edits from the start of a conversation to each state, segment after segment.

    What all candidates agree on is set aside, so that joining costs no more than the edits.
    """

    def __init__(self) -> None:
        self.settled: list[str] = []
        self.at: dict[int, tuple[int, str]] = {START: (0, "")}

    def add(self, costs: list[int], audits: list[str]) -> None:
        """A segment's costs and edits from state e to state f at 4 e + f; -1 where there are none."""
        found: dict[int, tuple[int, str]] = {}
        for e, (cost, audit) in self.at.items():
            for f in range(4):
                more = costs[4 * e + f]
                if more >= 0:
                    new = (cost + more, audit + audits[4 * e + f])
                    if f not in found or new < found[f]:
                        found[f] = new
        shared = os.path.commonprefix([a for _, a in found.values()])
        self.settled.append(shared)
        self.at = {f: (c, a[len(shared) :]) for f, (c, a) in found.items()}

    def end(self) -> tuple[int, str]:
        cost, audit = min((c + INSERT * MISSING[s], a + "I" * MISSING[s]) for s, (c, a) in self.at.items())
        return cost, "".join(self.settled) + audit


SEGMENT_FIELDS = (
    "part long, seq long, first_role string, last_role string, first_turn long, last_turn long, "
    "turns long, blank long, duplicate long, truncated long, illegal long, costs array<long>, audits array<string>"
)
ARROW = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
SEGMENT_KINDS = [tuple(x.split(" ")) for x in SEGMENT_FIELDS.split(", ")]
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def _initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def coded(turns: DataFrame) -> DataFrame:
    """One row per distinct turn: ``key, turn, role, digest, n`` copies, fault, first of its kind in the conversation."""
    bare = F.rtrim("text", F.lit(SPACE))
    digest = F.unhex(F.sha2("text", 256))
    fault = F.when(bare == "", "blank").when(~F.substring(bare, -1, 1).isin(*ENDS), "truncated")
    rows = turns.select("key", "turn", "role", digest.alias("digest"), fault.alias("fault"))
    rows = rows.groupBy("key", "turn", "role", "digest").agg(F.count("*").alias("n"), F.max("fault").alias("fault"))
    # The earliest turn (nulls first) that says it.  The join is by all four columns, so no key is hot.
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    first = rows.groupBy("key", "role", "digest").agg(F.min(order).alias("o"))
    first = first.select(*[F.col(c).alias(f"first_{c.split('.')[-1]}") for c in ("key", "o.turn", "role", "digest")], F.lit(True).alias("first"))
    same = [F.col(c).eqNullSafe(F.col(f"first_{c}")) for c in ("key", "turn", "role", "digest")]
    joined = rows.join(first, same[0] & same[1] & same[2] & same[3], "left")
    return joined.select(*rows.columns, F.coalesce("first", F.lit(False)).alias("first"))


def segments(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Searched segments of all conversations: ``key`` and ``SEGMENT_FIELDS``; part and seq are their order."""
    workers.importable(turns.sparkSession)
    order = ["key", "turn", "role", "digest"]
    rows = coded(turns).repartitionByRange(*order).sortWithinPartitions(*order).select("key", "turn", "role", "n", "fault", "first")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for seq, (key, first, found) in enumerate(_cut(batches, segment)):
            yield _searched(key, part, seq, first, found)

    kind = dict(rows.dtypes)["key"]
    return rows.mapInArrow(_merged(each), f"key {kind}, {SEGMENT_FIELDS}")


def _merged(function, rows: int = 512):
    """Joins the one-row batches of a generator."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in function(batches):
            held.append(batch)
            if len(held) >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held = []
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return each


def _cut(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[tuple[pa.Array, bool, list[tuple]]]:
    """Runs of at most ``segment`` turns of one conversation: its key (an array of one), whether it surely begins one, its turns."""
    held: list[tuple] = []
    key = current = None
    begins, some = False, False
    for batch in batches:
        ids = batch["key"].to_pylist()
        columns = [batch[c].to_pylist() for c in ("turn", "role", "n", "fault", "first")]
        for i, (name, turn, role, n, fault, first) in enumerate(zip(ids, *columns, strict=True)):
            if not some or name != current:
                if held:
                    yield key, begins, held
                # the first one of a partition may go on from the one before
                held, key, current, begins, some = [], batch["key"].slice(i, 1), name, some, True
            kind = {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)
            state = "blank" if fault == "blank" else fault if first else "duplicate"
            for copy in range(n):
                if len(held) == segment:
                    yield key, begins, held
                    held, begins = [], False
                held.append((turn, role[:1], kind, "duplicate" if copy and state != "blank" else state))
    if held:
        yield key, begins, held


def _searched(key: pa.Array, part: int, seq: int, begins: bool, turns: list[tuple]) -> pa.RecordBatch:
    faults = [t[3] for t in turns]
    codes = [t[2] + 4 * (GONE if t[3] in ("blank", "duplicate") else CUT if t[3] else FINE) for t in turns]
    costs, audits = [-1] * 16, [""] * 16
    for entry in [START] if begins else range(4):
        for leave, found in enumerate(search(codes, entry)):
            if found:
                costs[4 * entry + leave], audits[4 * entry + leave] = found
    known = [t[0] for t in turns if t[0] is not None]
    initials = [t[1] for t in turns]
    values = [
        part, seq, initials[0], initials[-1], known[0] if known else None, known[-1] if known else None,
        len(list(groupby(known))), faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        sum(pair not in LEGAL for pair in zip(initials, initials[1:])), costs, audits,
    ]
    arrays = [pa.array([v], ARROW[k]) for v, (_, k) in zip(values, SEGMENT_KINDS, strict=True)]
    return pa.RecordBatch.from_arrays([key, *arrays], ["key", *[c for c, _ in SEGMENT_KINDS]])


class Conversation:
    """One conversation as its segments, then its turns, pass by in order."""

    def __init__(self, key: pa.Array) -> None:
        self.key, self.fold = key, Fold()
        self.low = self.high = self.role = self.audit = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.at, self.state, self.lines = 0, START, 0
        self.digest = hashlib.sha256()

    def segment(self, s: dict) -> None:
        self.fold.add(s["costs"], s["audits"])
        self.turns += s["turns"] - (s["first_turn"] is not None and s["first_turn"] == self.high)
        if s["first_turn"] is not None:
            self.low = s["first_turn"] if self.low is None else self.low
            self.high = s["last_turn"]
        self.blank += s["blank"]
        self.duplicate += s["duplicate"]
        self.truncated += s["truncated"]
        self.illegal += s["illegal"] + (self.role is not None and (self.role, s["first_role"]) not in LEGAL)
        self.role = s["last_role"]

    def settle(self) -> None:
        """All segments were seen: the edits are known."""
        if self.audit is None:
            self.cost, self.audit = self.fold.end()

    def line(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.lines else "").encode() + f"{role}:{text}".encode())
        self.lines += 1

    def inserted(self) -> Iterator[tuple]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role = DUE[self.state]
            self.line(role, "")
            yield self.lines, None, role, "", "I"
            self.state, self.at = AFTER_DUE[self.state], self.at + 1

    def turn(self, turn: int | None, role: str, text: str) -> Iterator[tuple]:
        """The repaired turns that one turn, and insertions before it, give."""
        self.settle()
        yield from self.inserted()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter != "D":
            role = DUE[self.state] if letter == "R" else role
            self.state = SYSTEM if letter == "K" and role[:1] == "s" else AFTER_DUE[self.state]
            self.line(role, text)
            yield self.lines, turn, role, text, letter

    def end(self) -> Iterator[tuple]:
        self.settle()
        yield from self.inserted()

    def summary(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.low is not None else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, self.audit, self.digest.hexdigest()


SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
REPAIRED = "position long, turn long, role string, text string, edit string"


def _streamed(turns: DataFrame, keys: DataFrame, rows: bool, segment: int) -> DataFrame:
    """Every conversation's mark, segments and turns, in order, through ``Conversation``."""
    workers.importable(turns.sparkSession)
    blank = [F.lit(None).cast(k).alias(c) for c, k in SEGMENT_KINDS]
    bare = [F.lit(None).cast(k).alias(c) for c, k in (("turn", "long"), ("role", "string"), ("text", "string"), ("digest", "binary"))]
    marks = keys.distinct().select("key", F.lit(0).alias("kind"), *blank, *bare)
    found = segments(turns, segment).select("key", F.lit(1).alias("kind"), *[c for c, _ in SEGMENT_KINDS], *bare)
    texts = turns.select("key", F.lit(2).alias("kind"), *blank, "turn", "role", "text", F.unhex(F.sha2("text", 256)).alias("digest"))
    order = ["key", "kind", "part", "seq", "turn", "role", "digest"]
    all_rows = marks.unionByName(found).unionByName(texts).repartition("key").sortWithinPartitions(*order)
    all_rows = all_rows.drop("digest")
    fields = [tuple(x.split(" ")) for x in (REPAIRED if rows else SUMMARY).split(", ")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        keys: list[pa.Array] = []
        out: list[tuple] = []

        def keep(found, of: Conversation) -> None:
            for row in found:
                if rows:
                    keys.append(of.key)
                    out.append(row)

        def close(of: Conversation | None) -> None:
            if of:
                keep(of.end(), of)
                if not rows:
                    keys.append(of.key)
                    out.append(of.summary())

        def batch_out() -> pa.RecordBatch:
            columns = [pa.array([r[i] for r in out], ARROW[k]) for i, (_, k) in enumerate(fields)]
            made = pa.RecordBatch.from_arrays([pa.concat_arrays(keys), *columns], ["key", *[c for c, _ in fields]])
            keys.clear()
            out.clear()
            return made

        for batch in batches:
            kinds, turn, role = (batch[c].to_pylist() for c in ("kind", "turn", "role"))
            for i, kind in enumerate(kinds):
                if kind == 0:
                    close(now)
                    now = Conversation(batch["key"].slice(i, 1))
                elif kind == 1:
                    now.segment({c: batch[c][i].as_py() for c, _ in SEGMENT_KINDS})
                else:
                    keep(now.turn(turn[i], role[i], batch["text"][i].as_py()), now)
                if len(out) >= 4096:
                    yield batch_out()
        close(now)
        if out:
            yield batch_out()

    kind = dict(turns.dtypes)["key"]
    return all_rows.mapInArrow(each, f"key {kind}, {REPAIRED if rows else SUMMARY}")


def _named(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    space = F.lit(" ")
    return turns.select(
        turns[key].alias("key"),
        turns[turn].cast("long").alias("turn"),
        F.coalesce(turns[role].cast("string"), space).alias("role"),
        F.coalesce(turns[text].cast("string"), space).alias("text"),
    )


def summaries(
    turns: DataFrame, keys: DataFrame | None = None, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT
) -> DataFrame:
    """One row per conversation: ``key``, counts of faults, cost and letters of its edits, digest of the repaired turns.

    Turns are taken in order of ``turn`` (nulls first), then role, then the text's SHA-256;
    equal rows follow each other.  A null role or text is one space, a null key is a
    conversation like any other.  ``keys`` may name conversations that have no turns: zeros,
    no edits, the digest of the empty text.  Other columns are not read.
    """
    rows = _named(turns, key, turn, role, text)
    return _streamed(rows, rows.select("key") if keys is None else keys.select(keys[key].alias("key")), rows=False, segment=segment)


def repaired(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT) -> DataFrame:
    """The repaired turns: ``key, position`` from 1, ``turn`` (null where inserted), ``role, text, edit``; order and nulls as for ``summaries``."""
    rows = _named(turns, key, turn, role, text)
    return _streamed(rows, rows.select("key"), rows=True, segment=segment)
