"""The set-based layout equals a turn-by-turn walk in exact fractions."""

import itertools
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from duologue.functions import fixed_values as fv
from duologue.operators import quality, turns
from duologue.operators.timeline import assemble_timeline

SCHEMA = "conv_id long, pos long, speaker string, turn_type string, ratio double, emotion string, text string"


def draw_turns(seed: int, conversations: int, lengths: list[int]) -> list[tuple]:
    draw = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for pos in range(1, draw.choice(lengths) + 1):
            rows.append(
                (
                    conv,
                    pos,
                    draw.choice(fv.SPEAKERS),
                    draw.choice(["Normal", *fv.TURN_TYPES]),
                    draw.choice([None, 0.0, 0.13, 0.5, 0.77, 1.0]),
                    draw.choice(fv.EMOTIONS),
                    " ".join("x" * draw.randint(1, 9) for _ in range(draw.choice([1, 2, 5, 20]))),
                )
            )
    return rows


def hundredths(x: Fraction) -> Fraction:
    return Fraction(math.floor(x * 100 + Fraction(1, 2)), 100)


def walk(conversation: list[tuple]) -> list[dict]:
    rates = {"Neutral": Fraction(5, 2), "Happy": Fraction(5, 2), "Sad": Fraction(2), "Angry": Fraction(3)}
    done: list[dict] = []
    floor, holder = Fraction(0), None
    for _, pos, speaker, kind, ratio, emotion, text in conversation:
        rate = rates[emotion]
        spoken = max(Fraction(3, 5), (len(text.split()) / rate + len(text) / (rate * Fraction(26, 5))) / 2)
        turn = {"speaker": speaker, "kind": kind, "with": None, "relation": None, "by": None, "free": True}
        host = holder if kind != "Normal" and holder and holder["free"] and holder["speaker"] != speaker else None
        share = None if ratio is None else Fraction(ratio).limit_denominator(100)
        if host is None:
            turn["kind"] = "Normal"
            start = floor + Fraction(3, 10) if floor else Fraction(0)
            end = floor = start + spoken
        else:
            low, high = host["start"], host["end"]
            span = high - low
            host.update(free=False, relation=kind, **{"with": pos})
            turn.update(free=False, relation=kind, **{"with": host["pos"]})
            if kind == "Overlapping":
                least = min(Fraction(3, 20), span / 2)
                wanted = min(Fraction(1, 2), span / 2) if share is None else share * span
                start = low + min(max(wanted, least), max(least, span - Fraction(1, 10)))
                end = start + spoken
                floor = max(high, end)
            elif kind == "Interruption":
                start = max(high - Fraction(2, 5), low + Fraction(1, 20))
                end = start + spoken
                if end <= high:
                    end = high + Fraction(3, 10)
                floor, host["by"] = end, pos
            else:
                short = max(Fraction(1, 10), min(spoken, span * Fraction(4, 5)))
                start = low + ((span - short) / 2 if share is None else share * span)
                start = min(max(start, low + Fraction(1, 10)), high - short)
                end = start + short
        turn.update(start=hundredths(start), end=hundredths(end), pos=pos)
        if turn["kind"] != "Backchanneling":
            holder = turn
        done.append(turn)
    return done


def expected(rows):
    out = {}
    for conv, group in itertools.groupby(rows, key=lambda r: r[0]):
        for t in walk(list(group)):
            out[(conv, t["pos"])] = (
                t["kind"], float(t["start"]), float(t["end"]), t["with"] and f"t{t['with']}", t["relation"], t["by"] and f"t{t['by']}",
            )
    return out


@pytest.mark.parametrize("size", [4096, 1, 5])
def test_layout_equals_walk(spark, size):
    rows = draw_turns(11, 25, [1, 2, 7, 60])
    got = {
        (r.conv_id, r.pos): (r.turn_type, r.planned_start_sec, r.planned_end_sec, r.overlaps_with, r.overlaps_kind, r.interrupted_by)
        for r in assemble_timeline(spark.createDataFrame(rows, SCHEMA), size=size).collect()
    }
    assert got == expected(rows)


def test_one_long_conversation_spreads_over_blocks(spark):
    rows = draw_turns(5, 1, [700])
    laid = assemble_timeline(spark.createDataFrame(rows, SCHEMA), size=32)
    got = {(r.conv_id, r.pos): (r.planned_start_sec, r.planned_end_sec) for r in laid.collect()}
    assert got == {k: v[1:3] for k, v in expected(rows).items()}


def test_layout_breaks_no_rule(spark):
    laid = assemble_timeline(spark.createDataFrame(draw_turns(8, 20, [30, 50]), SCHEMA))
    checked = laid.withColumn("present_keys", F.array(*[F.lit(f) for f in fv.TURN_FIELDS]))
    issues = quality.validate_turns(checked).where("level = 'ERROR' and rule != 'total_duration'")
    assert issues.collect() == []


def test_scaling_stays_in_window(spark):
    laid = assemble_timeline(spark.createDataFrame(draw_turns(8, 6, [30, 50]), SCHEMA))
    targets = laid.select("conv_id").distinct().withColumn("target_sec", (F.col("conv_id") * 150).cast("double"))
    scaled = turns.scale_to_target(laid, targets)
    for r in quality.conversation_stats(scaled).collect():
        if r.conv_id > 0:
            assert 239.98 <= r.duration_sec <= 480.02
