import hashlib
import random
import zlib
from functools import cache
from itertools import product

import pytest

from duologue.llm import repair
from tests.llm import rows

SPACE = " \t\n\x0b\x0c\r"


def faults(turns):
    """First fault of each turn of a conversation in order: ``blank``, ``duplicate``, ``truncated`` or none."""
    out, seen = [], set()
    for _, role, text in turns:
        bare = text.strip(SPACE)
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(turns):
    """All edits, by recursion over turns and states; cost, letters and lines."""
    found = faults(turns)

    @cache
    def best(i, state, inserted=0):
        due = "assistant" if state == "u" else "user"
        options = []
        if i == len(turns) and state in ("", "a"):
            options.append((0, "", ()))
        if inserted < 2:
            cost, audit, lines = best(i, due[0], inserted + 1)
            options.append((cost + 5, "I" + audit, (f"{due}:", *lines)))
        if i < len(turns):
            _, role, text = turns[i]
            cost, audit, lines = best(i + 1, state)
            options.append((cost + 2, "D" + audit, lines))
            if found[i] not in ("blank", "duplicate"):
                more = 5 if found[i] else 0
                if role[:1] == due[0] or (role[:1] == "s" and state == ""):
                    cost, audit, lines = best(i + 1, role[:1])
                    options.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
                cost, audit, lines = best(i + 1, due[0])
                options.append((cost + more + 1, "R" + audit, (f"{due}:{text}", *lines)))
        return min(options) if options else (10**9, "", ())

    return best(0, "")


def summary(turns):
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest()))
    known = [t[0] for t in turns if t[0] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    found = faults(turns)
    initials = [t[1][:1] for t in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, lines = cheapest(tuple(turns))
    return (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversation(rng, turns):
    texts = ["Yes.", "No!", "cut off", " \t\n", "", "Why? ", "ok ok.", "So", "ä.", "Ü"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "u2"]
    out = []
    for i in range(turns):
        turn = rng.choice([i, i, i, i + 1, None])
        row = (turn, rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"line {rng.randint(0, 99)}.")
        out += [row] * rng.choice([1, 1, 1, 1, 2])
    return out


@pytest.mark.parametrize("segment", [1, 3, 256])
def test_equals_all_edits(spark, segment):
    rng = random.Random(segment)
    made = {i: conversation(rng, rng.choice([1, 2, 4, 7, 12, 30])) for i in range(60)}
    made[None] = conversation(rng, 9)
    made[99] = [(i, ["user", "assistant"][i % 2], f"turn {i}.") for i in range(150)]
    data = [(k, *t, "x", 1, 0) for k, turns in made.items() for t in turns]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, key string, part int, n int").repartition(4)
    cut = repair.segments(repair._named(df, "conv_id", "turn", "role", "text"), segment)
    if segment < 256:
        assert cut.count() > len(made)
    got = {r[0]: tuple(r)[1:] for r in repair.summaries(df, segment=segment).collect()}
    assert got == {k: summary(t) for k, t in made.items()}


@pytest.mark.parametrize("seed", range(30))
def test_search_and_fold(seed):
    """Every cut into segments gives the least (cost, edits) of the whole."""
    rng = random.Random(seed)
    codes = [rng.choice([0, 1, 2, 3, 1, 2]) + 4 * rng.choice([0, 0, 0, 1, 2]) for _ in range(rng.randint(0, 14))]
    answers = set()
    for size in (1, 2, 5, 100):
        fold = repair.Fold()
        for at in range(0, len(codes), size):
            tables = [repair.search(codes[at : at + size], entry) for entry in range(4)]
            fold.add([x[0] if x else -1 for t in tables for x in t], [x[1] if x else "" for t in tables for x in t])
        answers.add(fold.end())
    assert len(answers) == 1
    cost, audit = answers.pop()
    if len(codes) <= 5:
        assert (cost, audit) == tried(codes)


def tried(codes):
    """Every string of edits, replayed."""
    best = (10**9, "")
    for n in range(len(codes), len(codes) + 3):
        for letters in product("DIKR", repeat=n):
            state, at, cost = 0, 0, 0
            for x in letters:
                if x == "I":
                    cost, state = cost + 5, {0: 2, 1: 2, 2: 3, 3: 2}[state]
                    continue
                if at == len(codes):
                    break
                kind, fault = codes[at] % 4, codes[at] // 4
                at += 1
                if x == "D":
                    cost += 2
                    continue
                if fault == 1 or (x == "K" and not ((kind == 0 and state == 0) or (kind == 1 and state != 2) or (kind == 2 and state == 2))):
                    break
                cost += (x == "R") + 5 * (fault == 2)
                state = 1 if x == "K" and kind == 0 else {0: 2, 1: 2, 2: 3, 3: 2}[state]
            else:
                if at == len(codes) and state in (0, 3):
                    best = min(best, (cost, "".join(letters)))
    return best


def test_long_segments_are_searched_in_few_steps():
    rng = random.Random(1)
    codes = [rng.choice([0, 1, 2, 3]) + 4 * rng.choice([0, 0, 0, 1, 2]) for _ in range(256)]
    for entry in range(4):
        found = repair.search(codes, entry)
        assert found[2] and found[3] and len(found[3][1].replace("I", "")) == 256


def test_damage(spark):
    data = [(c, t, None if c == 3 and t == 1 else "assistant", None if t == 2 else "One. Two! three?", "x") for c in [0, 1, 2, 3, None] for t in [0, 1, 2, 3, 4, 5, None]]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, fault string")
    want = []
    for c, t, role, text, _ in data:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if fault == 4 else role, "" if fault == 1 else "".join(x for x in text if x not in ".!?") if fault == 2 else text)
        want += [row] * {0: 0, 3: 2}.get(fault, 1)
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in repair.damaged(df).collect())


def test_repaired_turns(spark):
    rng = random.Random(8)
    made = {i: conversation(rng, 12) for i in range(10)}
    df = spark.createDataFrame([(k, *t) for k, turns in made.items() for t in turns], "conv_id long, turn long, role string, text string")
    out = {}
    for r in sorted(repair.repaired(df).collect(), key=lambda r: (r.key, r.position)):
        out.setdefault(r.key, []).append(r)
    digests = {r.key: r for r in repair.summaries(df).collect()}
    for k, s in digests.items():
        kept = out.get(k, [])
        assert [r.position for r in kept] == list(range(1, len(kept) + 1))
        assert "".join(r.edit for r in kept) == s.audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in kept).encode()).hexdigest() == s.repaired_sha256
        assert all((r.turn is None and r.text == "") == (r.edit == "I") for r in kept if r.edit == "I")


def test_a_turn_repeated_very_often(spark):
    df = spark.range(20_000).selectExpr("1L AS conv_id", "CAST(if(id < 2, id, 5) AS long) AS turn", "if(id = 0, 'user', 'assistant') AS role", "'Yes.' AS text")
    (row,) = repair.summaries(df).collect()
    assert (row.gaps, row.duplicate, row.cost, row.audit) == (3, 19_998, 39_996, "KK" + "D" * 19_998)


def test_conversations_without_turns_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    empty = spark.createDataFrame([], schema)
    assert repair.summaries(empty).count() == 0 and repair.repaired(empty).count() == 0
    keys = spark.createDataFrame([(1,), (None,), (1,)], "conv_id long")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r.key: tuple(r)[1:] for r in repair.summaries(empty, keys).collect()}
    assert got == {1: nothing, None: nothing}


def test_long_texts(spark):
    text = rows.prose(1, 30_000) + "."
    made = [(0, "user", text), (1, "user", text), (2, "assistant", text[:-1] + "x")]
    df = spark.createDataFrame([(1, *t) for t in made], "conv_id long, turn long, role string, text string")
    assert tuple(repair.summaries(df).first())[1:] == summary(made)
