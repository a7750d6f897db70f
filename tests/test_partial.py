"""Refused languages, replies without usable turns, and summaries of conversations with and without extras."""

import pytest
from pyspark.sql import functions as F

from duologue.functions import fixed_values as fv
from duologue.operators import planning, quality, turns
from duologue.plans import publish


def test_unsupported_languages_refuse_the_run(spark):
    corpus = spark.createDataFrame([(1, "English", 0)], "corpus_combination_id long, language string, row_pos long")
    with pytest.raises(ValueError, match="klingon"):
        planning.language_ordered(corpus, ["english", "klingon"])
    assert planning.language_ordered(corpus, ["english"]).count() == 1
    assert planning.language_ordered(corpus, None).count() == 1


def test_no_usable_turn_is_an_error(spark):
    items = spark.createDataFrame([(1, 1, {"Text": " "}), (1, 2, {"speaker": "x"}), (2, 1, {"text": "hi"}), (2, 2, {"text": ""})], "conv_id long, pos long, item map<string,string>")
    got = {r.conv_id: (r.n_usable, r.is_error) for r in turns.usable_conversations(items, turns.normalise_items(items)).collect()}
    assert got == {1: (0, True), 2: (1, False)}


def test_missing_types_count_as_unknown(spark):
    df = spark.createDataFrame([(1, "Normal"), (1, None), (1, ""), (2, "Odd")], "conv_id long, turn_type string")
    assert {(r.conv_id, r.turn_type): r.n for r in quality.turn_type_tally(df).collect()} == {(1, "Normal"): 1, (1, "Unknown"): 2, (2, "Odd"): 1}


def conversation(spark):
    text = ["run_id", "title", "conversation_type", "context", "language", "gender_pair", "agent_emotion", "user_emotion", "agent_accent", "user_accent"]
    base = spark.range(1).select(F.lit(5).alias("corpus_combination_id"), F.lit(1).alias("index"), *[F.lit(t).alias(t) for t in text], F.lit(True).alias("passed"), F.lit(False).alias("include_numbers"))
    return base.select("*", F.lit(120.0).alias("duration_sec"), F.lit(None).cast("double").alias("target_sec"), *[F.lit(2).alias(k) for k in fv.TURN_TYPES], F.lit(2).alias("generation_attempts"), F.lit(None).cast("int").alias("format_attempts"), F.lit("PASS").alias("content_verdict"), F.lit(None).cast("string").alias("format_verdict"))


def test_summary_without_extras(spark):
    lines = publish.sidecar(conversation(spark)).first().metadata.split("\n")
    assert "generation_attempts_used: 2 of None" in lines and "generation_retries: 1" in lines and "content_bypassed: false" in lines
    assert not any(x.startswith(("feedback", "realism", "  ")) for x in lines)


def test_summary_with_extras(spark):
    full = conversation(spark).select(
        "*", F.lit(3).alias("max_generation_attempts"), F.lit(True).alias("format_exhausted"), F.lit(8).alias("realism_score"), F.lit("fine").alias("content_feedback"), F.lit("hidden").alias("format_feedback"),
        F.create_map(F.lit("b"), F.lit(True), F.lit("a"), F.lit(False)).alias("field_matches"),
        F.array(F.struct(F.lit("Unknown").alias("turn_type"), F.lit(1).cast("long").alias("n")), F.struct(F.lit("Normal").alias("turn_type"), F.lit(4).cast("long").alias("n"))).alias("type_counts"),
    )
    text = publish.sidecar(full).first().metadata
    assert "generation_attempts_used: 2 of 3" in text and "format_exhausted: true" in text and "realism_score: 8" in text
    assert "  Normal: 4\n  Unknown: 1\n" in text and "  a: false\n  b: true\nfeedback: fine" in text and "hidden" not in text
