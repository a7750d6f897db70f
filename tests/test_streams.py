"""Streams in several micro-batches give what the batch operators give."""

import pytest
from pyspark.sql import functions as F

from duologue.operators import planning, voice
from duologue.streaming import streams

EVENTS = "speaker_id string, duration_seconds double, source_index long"
ORDERS = "corpus_combination_id long, n long, block long, accepted boolean, duration_sec double"


def in_files(df, folder, parts):
    for part in range(parts):
        df.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(folder)


def read(spark, schema, folder):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.fixture(scope="module")
def clips(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("clips"))
    df = spark.range(600).select(
        F.concat(F.lit("s"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).cast("string")).alias("speaker_id"),
        (F.col("id") * 7 % 19).cast("double").alias("duration_seconds"), F.col("id").alias("source_index"), F.floor(F.col("id") / 200).alias("part"),
    )
    in_files(df, folder, 3)
    return folder


def test_best_clips(spark, clips, tmp_path):
    streams.best_clips(read(spark, EVENTS, clips), str(tmp_path), availableNow=True).awaitTermination()
    batches = {r.batch for r in spark.read.parquet(f"{tmp_path}/winners").select("batch").distinct().collect()}
    assert len(batches) == 3
    got = {tuple(r) for r in streams.latest_winners(spark, str(tmp_path)).select("speaker_id", "source_index").collect()}
    want = {tuple(r) for r in voice.best_clip_per_speaker(spark.read.parquet(clips)).select("speaker_id", "source_index").collect()}
    assert got == want


def test_heartbeat_grows(spark, clips, tmp_path):
    streams.heartbeat(read(spark, EVENTS, clips), str(tmp_path)).awaitTermination()
    beats = streams.heartbeats(spark, str(tmp_path)).orderBy("batch").collect()
    assert [b.clips_processed for b in beats] == [200, 400, 600]
    whole = streams.speaker_state(spark.read.parquet(clips))
    assert beats[-1].speakers_seen == whole.count()
    assert beats[-1].speakers_qualified == whole.where("first_qualifying_index is not null").count()
    # what a batch emits are the speakers it has clips of
    emitted = {r.batch: r["count"] for r in spark.read.parquet(f"{tmp_path}/changes").groupBy("batch").count().collect()}
    sizes = {r.part: r.n for r in spark.read.parquet(clips).groupBy(F.floor(F.col("source_index") / 200).alias("part")).agg(F.count_distinct("speaker_id").alias("n")).collect()}
    assert emitted == sizes


@pytest.fixture(scope="module")
def outcomes(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("outcomes"))
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 20).alias("corpus_combination_id"), F.col("id").alias("n"), F.floor(F.col("id") / 64).alias("block"),
        (F.hash("id") % 9 == 0).alias("accepted"), (F.col("id") % 50 + 240).cast("double").alias("duration_sec"), F.floor(F.col("id") / 300).alias("part"),
    )
    in_files(df, folder, 3)
    return folder


def test_failure_guard(spark, outcomes, tmp_path):
    streams.failure_guard(read(spark, ORDERS, outcomes), str(tmp_path), ["n"]).awaitTermination()
    got = streams.runs_log(str(tmp_path)).read(spark).where("abandoned_at is not null")
    written = [spark.read.parquet(f"{tmp_path}/runs/level=0/run={n}").count() for n in range(3)]
    assert written == [20, 20, 20]
    runs = planning.failure_runs(spark.read.parquet(outcomes), ["n"])
    want = planning.abandoned_instances(runs)
    assert {(r.corpus_combination_id, r.abandoned_at) for r in got.collect()} == {(r.corpus_combination_id, r.abandoned_at) for r in want.collect()}
    assert want.count() > 0


def test_progress_restarts_where_it_stopped(spark, outcomes, tmp_path):
    for _ in range(2):  # the second run finds nothing new
        streams.progress(read(spark, ORDERS, outcomes).where("accepted"), str(tmp_path)).awaitTermination()
    got = streams.stored_progress(spark, str(tmp_path))
    want = planning.progress_rollup(spark.read.parquet(outcomes).where("accepted"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
