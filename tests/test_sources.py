import json

import pytest

from duologue.operators import planning
from duologue.plans import publish
from duologue.sources import dialogue


def turn(**changes):
    from duologue.functions import fixed_values as fv

    return {f: None for f in fv.TURN_FIELDS} | {"turn_id": "t1", "interrupted": False} | changes


def test_corpus_keys_may_be_missing(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"corpus_combination_id": 1, "language": "Hindi"}\n')
    row = dialogue.read_corpus(spark, str(tmp_path)).first()
    assert (row.corpus_combination_id, row.language, row.duration_sec) == (1, "Hindi", None)
    with pytest.raises(Exception, match="(?i)path"):
        dialogue.read_corpus(spark, str(tmp_path / "none")).count()


def test_turn_lines_skip_blanks_and_name_bad_lines(spark, tmp_path):
    path = tmp_path / "t.jsonl"
    short = turn(turn_id="t2")
    del short["emotion"]
    path.write_text(json.dumps(turn()) + "\n\n" + json.dumps(short) + "\n{broken\n")
    rows = dialogue.read_turn_lines(spark, str(path), strict=False).orderBy("line_no").collect()
    assert [(r.line_no, r.is_bad) for r in rows] == [(1, False), (3, False), (4, True)]
    assert "emotion" in rows[0].present_keys and "emotion" not in rows[1].present_keys
    with pytest.raises(Exception, match="line 4"):
        dialogue.read_turn_lines(spark, str(path)).collect()
    with pytest.raises(Exception, match="line 4"):
        dialogue.read_turn_lines(spark, str(path)).count()
    with pytest.raises(Exception, match="line 4"):
        dialogue.read_turn_lines(spark, str(path)).select("turn_id").collect()


def test_line_numbers_hold_across_splits(spark, tmp_path):
    path = tmp_path / "long.txt"
    path.write_text("".join(f"{i}\n" for i in range(1, 20001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        lines = dialogue.numbered_lines(spark, str(path))
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 1
        assert lines.where("line_no != cast(value as bigint)").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_stored_conversation_keeps_order(spark, tmp_path):
    doc = {"turns": [turn(turn_id="t1", text="a"), turn(turn_id="t2", text="b")]}
    (tmp_path / "c.json").write_text(json.dumps(doc, indent=1))
    rows = dialogue.read_conversations(spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r.pos, r.turn_id, r.text) for r in rows] == [(1, "t1", "a"), (2, "t2", "b")]


def test_voice_reports_get_defaults(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"language": "hindi", "speakers_seen": 4}')
    (tmp_path / "b.json").write_text("{oops")
    rows = publish.voice_reports(spark, str(tmp_path)).collect()
    assert [(r.language, r.speakers_seen, r.speakers_selected, r.gender_breakdown) for r in rows] == [("hindi", 4, 0, {})]


def test_failure_runs_continue_over_batches(spark):
    rows = [(1, i, i // 4, i in (3, 9)) for i in range(16)]
    schema = "corpus_combination_id long, n long, block long, accepted boolean"
    whole = planning.failure_runs(spark.createDataFrame(rows, schema), ["n"])
    want = {r.n: r.consecutive_failures for r in whole.collect()}
    assert want[2] == 3 and want[3] == 0 and want[8] == 5 and want[15] == 6
    first = planning.failure_runs(spark.createDataFrame(rows[:7], schema), ["n"]).orderBy("n").collect()[-1]
    left = spark.createDataFrame([(1, first.consecutive_failures, 7)], "corpus_combination_id long, open_failures long, attempts long")
    rest = planning.failure_runs(spark.createDataFrame(rows[7:], schema), ["n"], open_runs=left)
    assert {r.n: r.consecutive_failures for r in rest.collect()} == {k: v for k, v in want.items() if k >= 7}
