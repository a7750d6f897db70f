from pyspark.sql import functions as F

from duologue.operators import quality, replies, turns, usage


def test_odd_replies(spark):
    rows = [
        (1, '```json\n{"VERDICT":"pass","realism_score":"8.5","corpus_match_score":12,"Corpus_Field_Matches":{"Language":true,"user_emotion":"false","agent_emotion":0},'
            '"issues":[{"severity":"BAD","description":"x","turn_ref":"t3"},{"description":""},5],"strengths":[" a ",""],"feedback":null}\n```'),
        (2, '[{"verdict":"zzz"}]'), (3, "nope"), (4, "[]"), (5, '"text"'), (6, '{"verdict":"FAIL","Verdict":"pass"}'),
    ]
    parsed = replies.extract_json(spark.createDataFrame(rows, "id int, reply string"))
    assert [r.needs_retry for r in parsed.orderBy("id").collect()] == [False, False, True, False, False, False]
    v = {r.id: r for r in replies.content_verdicts(parsed.drop("reply")).collect()}
    first = v[1]
    assert (first.verdict, first.realism_score, first.corpus_match_score, first.feedback) == ("PASS", 8.5, 10.0, "None")
    assert first.field_matches["language"] and first.field_matches["user_emotion"] and not first.field_matches["agent_emotion"]
    assert [(i.severity, i.turn_ref, i.description) for i in first.issues] == [("minor", "t3", "x")]
    assert first.strengths == ["a"]
    assert [v[i].verdict for i in (2, 4, 6)] == ["NEEDS_REVIEW", "NEEDS_REVIEW", "PASS"]
    assert [v[i].is_error for i in (1, 2, 3, 4, 5)] == [False, False, True, False, True]


def test_edit_patches(spark):
    bodies = [
        (1, '{"edits":[{"turn_id":" t1 ","action":"DELETE","text":"q"},{"TURN_ID":"t2","text":"hi"},{"turn_id":""}]}'),
        (2, '[{"turn_id":"t9","action":"zap"}]'), (3, '{"turn_id":"t4","text":"solo"}'), (4, '{"patch":[{"turn_id":5}]}'), (5, '{"edits":[]}'),
    ]
    out = replies.edit_patches(spark.createDataFrame(bodies, "id int, body string")).orderBy("id", "edit_no").collect()
    assert [(r.id, r.turn_id, r.action, r.text) for r in out] == [
        (1, "t1", "delete", None), (1, "t2", "replace", "hi"), (2, "t9", "replace", None), (3, "t4", "replace", "solo"), (4, "5", "replace", None)
    ]


def test_edits_merge_in_order_and_deletes_stick(spark):
    base = spark.createDataFrame([(1, i, f"t{i}", "old", "Happy", "Normal") for i in range(1, 5)], "conv_id int, pos long, turn_id string, text string, emotion string, turn_type string")
    edits = spark.createDataFrame(
        [(1, "t1", 1, "replace", "a", "sad", None), (1, "t1", 2, "replace", " ", "nope", "overlap"), (1, "t2", 1, "delete", None, None, None), (1, "t2", 2, "replace", "b", None, None), (1, "zz", 1, "replace", "c", None, None)],
        "conv_id int, turn_id string, edit_no int, action string, text string, emotion string, turn_type string",
    )
    after = turns.apply_edits(base, edits)
    assert [(r.turn_id, r.text, r.emotion, r.turn_type) for r in after.orderBy("pos").collect()] == [
        ("t1", "a", "Sad", "Overlapping"), ("t3", "old", "Happy", "Normal"), ("t4", "old", "Happy", "Normal")
    ]
    gone = base.where("pos < 0")
    assert turns.emptied_conversations(base, gone).count() == 1


def test_usage_and_limits(spark):
    log = [(1, '{"usage":{"prompt_tokens":3,"completion_tokens":null}}'), (2, '{"usage":{}}'), (3, '{"usage_metadata":{"prompt_token_count":1,"thoughts_token_count":9}}'), (4, "{}")]
    out = usage.normalise_usage(spark.createDataFrame(log, "id int, reply string")).orderBy("id").collect()
    assert [(r.id, r.input_tokens, r.output_tokens, r.thinking_tokens) for r in out] == [(1, 3, 0, 0), (3, 1, 0, 9)]
    errors = [(429, "E", "x"), (500, "E", "HTTP 429"), (None, "RateLimitError", None), (None, "E", "Quota Exceeded now"), (None, "E", "plain")]
    df = spark.createDataFrame(errors, "s int, t string, m string").select(usage.limit_error(F.col("s"), F.col("t"), F.col("m")))
    assert [r[0] for r in df.collect()] == [True, True, True, True, False]


def test_scoring_keeps_keys_and_errors(spark):
    def make():
        def model(prompt):
            if prompt == "bad":
                raise RuntimeError("429 too many requests")
            return prompt.upper()

        return model

    requests = spark.createDataFrame([(1, "ok"), (2, "bad")], "request_id long, prompt string")
    out = {r.request_id: r for r in usage.score_rows(requests, make).collect()}
    assert out[1].reply == "OK" and out[2].reply is None and out[2].error_type == "RuntimeError"


def test_empty_conversation_is_an_error(spark):
    turns_df = spark.createDataFrame([(1, 1)], "conv_id long, pos long")
    issues = spark.createDataFrame([], "conv_id long, level string")
    out = quality.validation_report(spark.createDataFrame([(1,), (2,)], "conv_id long"), turns_df, issues)
    assert sorted((r.conv_id, r.n_errors, r.has_errors) for r in out.collect()) == [(1, 0, False), (2, 1, True)]
