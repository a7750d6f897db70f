"""Packing of token streams into windows, best fit first.

Whole windows of long documents come first; then each window takes the longest rest that
fits, again and again, and when none fits the shortest one is cut.  Rests are kept by
tiers (powers of two up to the window) to find the longest that fits; the tiers have no
windows of their own.  Only what a pool has left below one window goes to shorter windows,
which need no padding.  Windows are finally dealt to step groups of equal size so that
groups have near-equal attention work (the sum of squared piece lengths).

Packing happens inside pools of bounded size, in the order of the rows, so nothing is
shuffled and no task holds more than a pool.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from duologue.llm import workers

WINDOW = 1024
END = 0
#: Tokens of a pool; a longer document makes a pool of its own.
POOL_TOKENS = 1 << 20
STEP_WINDOWS = 32
VOCABULARY = "byte_bpe_50k"

#: The vocabulary's one special token; a text that has it is encoded by the tokenizer itself.
SPECIAL = "<|endoftext|>"


class Encoder:
    """Token ids of texts as little-endian bytes."""

    def __init__(self, name: str = VOCABULARY) -> None:
        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        # the same vocabulary and merges, several times as fast
        self.plain = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        if SPECIAL in text:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.plain.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


@cache
def encoder(name: str = VOCABULARY) -> Encoder:
    """One per Python worker."""
    return Encoder(name)


def tier_of(length: int) -> int:
    """The smallest tier that holds a length."""
    return 1 << (length - 1).bit_length()


def pack(lengths: list[int], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Windows of (document, start, length); every token of every document is in exactly one piece."""
    windows: list[list[tuple[int, int, int]]] = []
    tiers: dict[int, list[tuple[int, int, int]]] = {}
    for doc, total in enumerate(lengths):
        whole = total - total % window
        windows += [[(doc, s, window)] for s in range(0, whole, window)]
        if total > whole:
            tiers.setdefault(tier_of(total - whole), []).append((total - whole, doc, whole))
    # longest last: the next to be taken
    stacks = {t: sorted(x, key=lambda p: (p[0], -p[1])) for t, x in tiers.items()}

    def longest(most: int) -> tuple[int, int, int] | None:
        """The longest rest of at most this length; within the tier that straddles it, by bisection."""
        for t in sorted((t for t in stacks if stacks[t] and t // 2 < most), reverse=True):
            stack = stacks[t]
            low, high = 0, len(stack)
            while low < high:
                mid = (low + high) // 2
                low, high = (mid + 1, high) if stack[mid][0] <= most else (low, mid)
            if low:
                return stack.pop(low - 1)
        return None

    def put_back(length: int, doc: int, start: int) -> None:
        stack = stacks.setdefault(tier_of(length), [])
        low, high = 0, len(stack)
        while low < high:
            mid = (low + high) // 2
            low, high = (mid + 1, high) if stack[mid][0] < length else (low, mid)
        stack.insert(low, (length, doc, start))

    left = sum(p[0] for s in stacks.values() for p in s)
    while left:
        room = window if left >= window else 1 << (left.bit_length() - 1)
        left -= room
        pieces = []
        while room:
            found = longest(room)
            if found is None:  # only longer ones are left: cut the shortest of them
                stack = stacks[min(t for t in stacks if stacks[t])]
                length, doc, start = stack.pop(0)
                pieces.append((doc, start, room))
                put_back(length - room, doc, start + room)
                room = 0
            else:
                length, doc, start = found
                pieces.append((doc, start, length))
                room -= length
        windows.append(pieces)
    return windows


def step_groups(windows: list[list[tuple[int, int, int]]], size: int = STEP_WINDOWS) -> list[int]:
    """A group for each window: equal numbers, dealt back and forth by attention work."""
    work = np.array([sum(n * n for _, _, n in w) for w in windows])
    groups = max(1, -(-len(windows) // size))
    out = np.empty(len(windows), np.int64)
    order = np.argsort(-work, kind="stable")
    lap, at = np.divmod(np.arange(len(windows)), groups)
    out[order] = np.where(lap % 2, groups - 1 - at, at)
    return out.tolist()


SCHEMA = {
    "start": pa.int64(),
    "length": pa.int64(),
    "ids_crc32": pa.int64(),
    "doc_tokens": pa.int64(),
    "sequence_id": pa.int64(),
    "offset": pa.int64(),
    "tier": pa.int32(),
    "step_group": pa.int64(),
}


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece: key, place in the document, checksum of its ids, sequence and offset there, tier, step group.

    With ``with_ids`` also the piece's token ids.  A null text counts as empty; every
    document ends with id 0, so each has a piece.  Repeated rows are documents of their
    own, null keys stay null, an empty table gives no pieces, other columns are not read.
    Sequence ids hold the task's partition in their upper bits.
    """
    workers.importable(docs.sparkSession)
    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    names = ["key", *SCHEMA, *["ids"] * with_ids]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder().ids
        end = np.array([END], "<u4").tobytes()
        base = TaskContext.get().partitionId() << 36
        for batch in batches:
            ids = [encode(t) + end for t in workers.strings(batch["text"])]
            for a, b in workers.groups_of([len(x) // 4 for x in ids], POOL_TOKENS):
                pool = [memoryview(x) for x in ids[a:b]]
                windows = pack([len(x) // 4 for x in pool], window)
                groups = step_groups(windows)
                columns: list[list] = [[] for _ in names]
                for n, pieces in enumerate(windows):
                    offset = 0
                    tier = tier_of(sum(p[2] for p in pieces))
                    for doc, start, length in pieces:
                        part = pool[doc][4 * start : 4 * (start + length)]
                        row = (a + doc, start, length, zlib.crc32(part), len(pool[doc]) // 4, base + n, offset, tier, base + groups[n])
                        for column, value in zip(columns, row, strict=False):
                            column.append(value)
                        if with_ids:
                            columns[-1].append(np.frombuffer(part, "<u4").astype(np.int32))
                        offset += length
                base += len(windows)
                arrays = [batch["key"].take(pa.array(columns[0], pa.int64()))]
                arrays += [pa.array(c, k) for c, k in zip(columns[1:], SCHEMA.values(), strict=False)]
                if with_ids:
                    arrays.append(pa.array(columns[-1], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names)

    kinds = {pa.int64(): "long", pa.int32(): "int"}
    schema = ", ".join([f"key {dict(rows.dtypes)['key']}", *(f"{c} {kinds[k]}" for c, k in SCHEMA.items()), *["ids array<int>"] * with_ids])
    return rows.mapInArrow(each, schema)
