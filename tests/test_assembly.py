import json

import pytest

from duologue.operators import assembly

CLIPS = "conversation_id string, pos long, speaker string, text string, duration double, gap double, overlap double"


def starts(spark, clips, **options):
    rows = [("c", i + 1, f"user{i % 2 + 1}", "x", d, g, o) for i, (d, g, o) in enumerate(clips)]
    out = assembly.schedule(spark.createDataFrame(rows, CLIPS), **options).orderBy("pos").collect()
    return [r.start for r in out]


@pytest.mark.parametrize(
    "clips,options,expected",
    [
        ([(1.0, 0.0, 0.0)], {"lead": 0.1}, [0.1]),
        ([(1.0, 0.0, 0.0), (1.0, 0.0, 0.0)], {}, [0.0, 1.25]),
        ([(1.0, 0.0, 0.0), (1.0, 0.5, 0.0)], {}, [0.0, 1.5]),
        ([(2.0, 0.0, 0.0), (1.0, 0.0, 0.5)], {}, [0.0, 1.5]),
        ([(2.0, 0.0, 0.0), (1.0, 0.0, 5.0)], {}, [0.0, 1.0]),
        ([(1.0, 0.0, 0.0), (1.0, 0.0, 5.0)], {"max_overlap": 10.0}, [0.0, 0.0]),
    ],
)
def test_schedule_cases(spark, clips, options, expected):
    assert starts(spark, clips, **options) == expected


@pytest.mark.parametrize("size", [1, 2, 4096])
def test_schedule_equals_recursion(spark, size):
    import random

    draw = random.Random(2)
    clips = [(draw.choice([0.2, 0.5, 2.0]), draw.choice([0.0, 0.3]), draw.choice([0.0, 0.0, 4.0])) for _ in range(40)]
    end, want = None, []
    for d, g, o in clips:
        start = 0.0 if end is None else max(0.0, end - min(o, 3.0) if o > 0 else end + (g or 0.25))
        want.append(start)
        end = start + d
    assert starts(spark, clips, max_overlap=3.0, size=size) == pytest.approx(want)


def script(**changes):
    doc = {
        "conversation_id": "conv", "language": "gu", "speakers": {"user1": {"voice": "a"}, "user2": {"voice": "b"}},
        "turns": [{"speaker": "user1", "text": "one two"}, {"speaker": "user2", "text": "three", "gap": 0.3}, {"speaker": "user1", "text": "four", "overlap": 0.4}],
    }
    doc.update(changes)
    return json.dumps(doc)


def test_scripts_and_drop_reasons(spark):
    turn = {"speaker": "user1", "text": "x"}
    docs = [
        script(), "{not json", script(speakers={"user1": {}}), script(turns=[{"speaker": "ghost", "text": "x"}]),
        script(turns=[{"speaker": "user1", "text": "   "}]), script(turns=[turn | {"gap": 0.5, "overlap": 0.5}]),
    ]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, value string")
    rows = assembly.load_scripts(df).orderBy("i").collect()
    reasons = [r.drop_reason for r in rows]
    assert reasons[0] is None and "load" in reasons[1] and "two speakers" in reasons[2] and "ghost" in reasons[3] and "empty text" in reasons[4]
    assert [(t.gap, t.overlap) for t in rows[0].turns] == [(0.0, 0.0), (0.3, 0.0), (0.0, 0.4)]
    assert [(t.gap, t.overlap) for t in rows[5].turns] == [(0.0, 0.5)]
    report = assembly.production_report(assembly.load_scripts(df)).first()
    assert (report.num_produced, report.num_dropped) == (2, 4)
    assert {r.conversation_id for r in assembly.script_turns(assembly.load_scripts(df)).collect()} == {"conv"}


def words(spark, text, duration, gap=0.0):
    df = spark.createDataFrame([("c", 1, "user1", text, duration, 0.0, 0.0)], CLIPS)
    return [(r.word, r.start, r.end) for r in assembly.align_words(df, inter_word_gap=gap).orderBy("word_no").collect()]


def test_word_alignment(spark):
    assert [w[0] for w in words(spark, "one two three", 2.0)] == ["one", "two", "three"]
    for gap in (0.0, 0.05):
        timed = words(spark, "alpha beta gamma delta", 3.0, gap)
        assert all(0 <= s < e <= 3.0 for _, s, e in timed)
        assert all(a[2] <= b[1] + 1e-6 for a, b in zip(timed, timed[1:]))
    assert words(spark, "", 1.0) == [] and words(spark, "hello", 0.0) == []
    short, long = words(spark, "a wwwwwwww", 4.0)
    assert long[2] - long[1] > short[2] - short[1]


def spoken(spark, seed):
    """Clips of two conversations: odd blanks, long lines, short clips that later ones overtake, a third and no speaker."""
    import random

    draw, rows = random.Random(seed), []
    for conv in ("a", "b"):
        for pos in range(1, 60):
            n = draw.choice([0, 1, 3, 15, 16, 17, 32, 33, 400])
            text = draw.choice(["", " ", "\n"]) + "".join(draw.choice(["a", "bc", "déf", "x" * 30]) + draw.choice([" ", " ", "  ", "\t", "\u00a0\n"]) for _ in range(n))
            duration = draw.choice([0.0, 0.3, 2.0, len(text) / 13])
            rows.append((conv, pos, draw.choice(["user1", "user2", "user3", None]), None if n == 3 and pos > 50 else text, duration, 0.0, draw.choice([0.0, 0.9])))
    return spark.createDataFrame(rows, CLIPS)


def test_aligned_words_equal_prefix_sums(spark):
    import math

    clips = spoken(spark, 3)
    want = set()
    for c in clips.collect():
        said = (c.text or "").split()
        total, upto = sum(map(len, said)), 0
        speech = max(c.duration - 0.05 * (len(said) - 1), 0.0)
        gap = (c.duration - speech) / max(len(said) - 1, 1)
        at = lambda n, i: math.floor((speech * n / total + gap * i) * 1000.0 + 0.5) / 1000.0
        for i, word in enumerate(said if c.duration > 0 else []):
            want.add((c.conversation_id, c.pos, i + 1, c.speaker, word, at(upto, i), at(upto + len(word), i)))
            upto += len(word)
    assert {tuple(r) for r in assembly.align_words(clips, inter_word_gap=0.05).collect()} == want


@pytest.mark.parametrize("block_sec", [0.5, 10.0, 600.0])
def test_merged_words_equal_merged_alignments(spark, block_sec):
    clips = spoken(spark, 4)
    scheduled = assembly.schedule(clips)
    got = assembly.merged_words(scheduled, block_sec=block_sec)
    want = assembly.merge_alignments(assembly.align_words(clips), scheduled)
    assert sorted(got.collect(), key=repr) == sorted(want.select(*got.columns).collect(), key=repr)
    with pytest.raises(ValueError):
        assembly.merged_words(scheduled, inter_word_gap=-0.1)


def test_merged_transcripts_equal_parts_of_variants(spark):
    scheduled = assembly.schedule(spoken(spark, 5))
    variants = assembly.channel_variants(assembly.merged_words(scheduled), ["user1", "user2"])
    want = assembly.transcript_parts(variants, 100).collect()
    got = assembly.merged_transcripts(scheduled, ["user1", "user2"], part_words=100, block_sec=20.0).collect()
    assert len(want) > 8 and sorted(got, key=repr) == sorted(want, key=repr)


def test_words_are_neither_shuffled_nor_sorted_for_alignment(spark):
    plan = assembly.align_words(spoken(spark, 6))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan


def test_variants_flip_labels_only(spark):
    rows = [("c", "a", 0.0, 0.5, "user1", 1), ("c", "b", 0.5, 1.0, "user1", 2), ("c", "c", 0.7, 1.2, "user2", 3)]
    df = spark.createDataFrame(rows, "conversation_id string, word string, start double, end double, speaker string, seq long")
    out = assembly.channel_variants(df, ["user1", "user2"]).orderBy("variant", "seq").collect()
    one, two = out[:3], out[3:]
    assert [r.variant for r in out] == ["c__user1_agent"] * 3 + ["c__user2_agent"] * 3
    assert [(r.word, r.start, r.end) for r in one] == [(r.word, r.start, r.end) for r in two]
    assert all(a.label != b.label for a, b in zip(one, two))
    assert one[0].label == "SPEAKER_MAIN"
