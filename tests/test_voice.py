import pytest
from pyspark.sql import functions as F

from duologue.functions.text import slug
from duologue.operators import voice
from duologue.plans import publish
from duologue.sources import clips as clip_sources

CLIP = "speaker_id string, language string, gender string, duration_seconds double, transcript string, source_dataset string, source_index long"


def clips(spark, *durations, speaker="a"):
    return spark.createDataFrame(
        [(speaker, "english", "male", d, "x", "s", i) for i, d in enumerate(durations)], CLIP
    )


@pytest.mark.parametrize(
    "durations,best,tier",
    [
        ((12.0, 10.5, 15.0), 10.5, "primary_ge_target"),
        ((5.0, 7.5, 6.0), 7.5, "fallback_below_target"),
        ((8.0, 10.0), 10.0, "primary_ge_target"),
    ],
)
def test_selection_rules(spark, durations, best, tier):
    row = voice.best_clip_per_speaker(clips(spark, *durations)).collect()
    assert [(r.duration_seconds, r.selection_tier) for r in row] == [(best, tier)]


def test_too_short_speakers_are_discarded(spark):
    df = clips(spark, 4.9, 2.0)
    won = voice.best_clip_per_speaker(df)
    assert won.count() == 0
    assert [r.speaker_id for r in voice.discarded_speakers(df, won).collect()] == ["a"]


def test_first_of_equal_clips_wins_in_any_row_order(spark):
    df = clips(spark, 11.0, 10.5, 10.5, 12.0)
    for salt in range(3):
        shuffled = df.orderBy(F.xxhash64(F.col("source_index"), F.lit(salt)))
        assert voice.best_clip_per_speaker(shuffled).first().source_index == 1


def test_minimum_above_target_is_refused(spark):
    with pytest.raises(ValueError):
        voice.best_clip_per_speaker(clips(spark, 1.0), target=5.0, minimum=10.0)


def test_cap_follows_first_qualifying_clip(spark):
    df = clips(spark, 3.0, 8.0, 20.0).unionByName(
        spark.createDataFrame([("b", "english", "male", 9.0, "x", "s", 0), ("b", "english", "male", 11.0, "x", "s", 5)], CLIP)
    )
    kept = voice.speaker_cap(voice.best_clip_per_speaker(df), 1).collect()
    assert [(r.speaker_id, r.duration_seconds) for r in kept] == [("b", 11.0)]
    assert voice.speaker_cap(voice.best_clip_per_speaker(df), None).count() == 2


def test_report_and_completeness(spark):
    rows = [(f"s{i}", "english", "male" if i == 0 else "female", d, "x", "s", i) for i, d in enumerate([10.0, 11.2, 7.5, 2.0, 1.0])]
    df = spark.createDataFrame(rows, CLIP)
    won = voice.best_clip_per_speaker(df)
    r = voice.voice_report(df, won).first()
    assert (r.speakers_seen, r.speakers_selected, r.speakers_discarded) == (5, 3, 2)
    assert (r.primary_tier_count, r.fallback_tier_count, r.total_selected_duration_seconds) == (2, 1, 28.7)
    assert r.gender_breakdown == {"male": 1, "female": 2}
    files = [("english", "g", f"s{i}", f) for i in range(3) for f in ("audio.wav", "metadata.json")]
    reports = voice.voice_report(df, won)
    schema = "language string, gender string, speaker string, file string"
    assert voice.export_completeness(spark.createDataFrame(files, schema), reports).first().is_complete
    assert not voice.export_completeness(spark.createDataFrame(files[:-1], schema), reports).first().is_complete
    assert not voice.export_completeness(spark.createDataFrame(files, schema), reports, max_speakers=3).first().is_complete


def test_present_null_and_absent_fields_differ_in_fingerprints(spark):
    fields = voice.fv.FINGERPRINT_FIELDS
    df = spark.createDataFrame([(7, *[None] * len(fields)), (8, *[""] * len(fields))], "i long, " + ", ".join(f"{f} string" for f in fields))
    first, second = [r[0] for r in df.orderBy("i").select(voice.speaker_fingerprint(F.col("i"))).collect()]
    assert first.startswith("spk_") and second == "unknown_spk_8"
    assert df.select(voice.speaker_fingerprint(F.col("i"), absent=fields)).first()[0] == "unknown_spk_7"


def test_gender_and_slug(spark):
    raw = ["M", " male ", "F", "female", None, "", "NaN", "none", "x"]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(raw)], "i int, g string").orderBy("i")
    assert [r[0] for r in df.select(voice.gender(F.col("g"))).collect()] == ["male"] * 2 + ["female"] * 2 + ["unknown"] * 4 + ["other"]
    names = spark.createDataFrame([(" a b/c ",), ("///",)], "n string")
    assert [r[0] for r in names.select(slug(F.col("n"))).collect()] == ["a_bc", "unknown"]


def test_uploads_skip_stored_files_and_come_in_batches(spark):
    local = spark.createDataFrame([("c",), ("a",), ("b",), ("d",)], "path string")
    remote = spark.createDataFrame([("pre/d",), ("pre",), ("prefix/x",), (None,)], "path string")
    listed = publish.relative_listing(remote, "/pre/")
    assert sorted(r.path for r in listed.collect()) == ["d", "pre"]
    batches = publish.upload_batches(publish.upload_plan(local, listed), 2)
    assert sorted((r.path, r.batch_no) for r in batches.collect()) == [("a", 0), ("b", 0), ("c", 1)]


def test_audio_bytes_stay_undecoded(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.wav").write_bytes(b"RIFF123")
    (tmp_path / "b.txt").write_text("no")
    rows = clip_sources.audio_files(spark, str(tmp_path)).collect()
    assert [(r.length, bytes(r.content)) for r in rows] == [(7, b"RIFF123")]
