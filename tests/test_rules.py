"""Cases beyond the fixtures: long conversations, hot texts, typed zeros, differences by wording."""

import json

import pytest
from pyspark.sql import functions as F

from duologue.operators import assembly, quality, requests, timeline, voice
from duologue.operators.ordered import number_rows
from duologue.plans import publish


def test_long_conversation_is_one_document(spark, tmp_path):
    turns = spark.range(1, 2502).select(F.lit(1).alias("conv_id"), F.col("id").alias("pos"), F.concat(F.lit("t"), "id").alias("turn_id"))
    head = spark.createDataFrame(
        [(1, 7, 1, "Hindi", "a", "b", "c", "d", "MF", "title", None, None, 10.0, True, False)],
        "conv_id long, corpus_combination_id long, index long, language string, agent_emotion string, user_emotion string, agent_accent string, "
        "user_accent string, gender_pair string, title string, context string, conversation_type string, duration_sec double, passed boolean, include_numbers boolean",
    )
    found = publish.payloads(head, requests.turn_documents(turns, ["turn_id"]))
    publish.write_conversations(found, str(tmp_path / "out"))
    rows = spark.read.json(str(tmp_path / "out")).collect()
    assert len(rows) == 1 and rows[0].language == "hindi"
    assert [t["turn_id"] for t in json.loads(rows[0].body)["turns"]] == [f"t{i}" for i in range(1, 2502)]


def test_only_numeric_zero_is_unknown(spark):
    text = spark.createDataFrame([("0", 1), ("", 2), (None, 3), ("0.0", 4)], "s string, i long")
    assert [r[0] for r in text.orderBy("i").select(voice.speaker_or_unknown(F.col("s"), F.col("i"))).collect()] == ["0", "unknown_spk_2", "unknown_spk_3", "0.0"]
    for kind in ("int", "double", "decimal(5,2)"):
        numbers = spark.createDataFrame([(0, 1), (3, 2)], "s int, i long").select(F.col("s").cast(kind), "i")
        first, second = (r[0] for r in numbers.orderBy("i").select(voice.speaker_or_unknown(F.col("s"), F.col("i"))).collect())
        assert first == "unknown_spk_1" and second.startswith("3")


def lines(spark, texts, speaker="s"):
    return spark.createDataFrame([(1, i + 1, speaker, t) for i, t in enumerate(texts)], "conv_id long, pos long, speaker string, text string")


@pytest.mark.parametrize("block", [2, 4096])
def test_faithfulness_follows_wording(spark, block):
    def found(a, b):
        return sorted((r.pos, r.problem, r.edit_distance) for r in quality.faithfulness(lines(spark, a), lines(spark, b), block).collect())

    assert found(["alpha", "beta", "gamma"], ["alpha", "gamma"]) == [(2, "dropped", None)]
    assert found(["alpha", "gamma"], ["alpha", "beta", "gamma"]) == [(2, "added", None)]
    assert found(["a", "b", "c", "d"], ["a", "c", "d", "b"]) == [(2, "reordered", None)]
    told = ["alpha", "beta", "gamma", "delta", "eps", "zeta"]
    assert found(["alpha", "delta", "eps", "beta", "gamma", "zeta"], told) == [(2, "reordered", None), (3, "reordered", None)]
    assert found(["a" * 5000 + "b"], ["a" * 4990 + "c"]) == [(1, "reworded", 11)]
    assert found(["a", "b", "c"], ["a", "bx", "c"]) == [(2, "reworded", 1)]
    assert found(["a", "a", "a"], ["a", "a"]) == [(3, "dropped", None)]
    assert found(["Hi there!"], ["hi, there"]) == []


def test_crosstalk_counts_the_wrong_speaker(spark):
    rows = [("v", "u1", "main", "u1", 0.0, 3.0), ("v", "u1", "main", "u2", 2.5, 3.5), ("v", "u1", "user", "u2", 3.0, 5.0)]
    df = spark.createDataFrame(rows, "variant string, main_speaker string, channel string, speaker string, start double, end double")
    r = assembly.crosstalk_purity(df).first()
    assert (r.main_crosstalk, r.user_crosstalk, r["pass"], r.quarantined) == (0.25, 0.0, False, True)


def test_carry_over_goes_through_two_levels(spark, monkeypatch):
    from duologue.operators import ordered

    monkeypatch.setattr(ordered, "BLOCK_ROWS", 3)
    df = spark.range(200).select(F.col("id"), F.floor(F.col("id") / 4).alias("blk"))
    assert {r.id: r.pos for r in number_rows(df, [], ["id"], ["blk"]).collect()} == {i: i + 1 for i in range(200)}


def test_repair(spark):
    turns = spark.createDataFrame(
        [(c, p, f"speaker_{p % 2 + 1}", "Overlapping" if p == 4 else "Normal", 0.5, "Neutral", f"some words here {p}") for c in (1, 2) for p in range(1, 7)],
        "conv_id long, pos long, speaker string, turn_type string, ratio double, emotion string, text string",
    )
    laid = timeline.assemble_timeline(turns)
    edits = spark.createDataFrame(
        [(1, "t2", 1, "delete", None), (1, "t5", 1, "replace", "new text")] + [(2, f"t{p}", 1, "delete", None) for p in range(1, 7)],
        "conv_id long, turn_id string, edit_no int, action string, text string",
    ).withColumns({"emotion": F.lit(None).cast("string"), "turn_type": F.lit(None).cast("string")})
    got = timeline.repair(laid, edits).orderBy("conv_id", "pos").collect()
    assert [r.turn_id for r in got if r.conv_id == 1] == ["t1", "t2", "t3", "t4", "t5"]
    assert [r.text for r in got if r.conv_id == 1][3] == "new text" and not any(r.refused for r in got if r.conv_id == 1)
    same = laid.where("conv_id = 2").orderBy("pos").collect()
    assert [(r.text, r.planned_start_sec, r.planned_end_sec) for r in got if r.conv_id == 2] == [(r.text, r.planned_start_sec, r.planned_end_sec) for r in same]
    assert all(r.refused for r in got if r.conv_id == 2)
