"""Streaming forms, run over the given tables until all input is consumed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.views import Views
from duologue.operators.planning import INSTANCE
from duologue.session import checkpoint_root
from duologue.streaming import streams

c = F.col


def in_batches(v: Views, rows: DataFrame, *by: str) -> DataFrame:
    """All rows as a stream of three micro-batches."""
    place = f"{workspace(v)}/input"
    rows.repartition(6, *by).write.parquet(place)
    return v.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(place)


def in_order(v: Views, rows: DataFrame, *order: str) -> DataFrame:
    """All rows as a stream of at least three micro-batches, earlier rows first."""
    place, cut = (f"{workspace(v)}/{name}" for name in ("input", "cut"))
    # cut once: the range's points are drawn anew whenever they are computed
    rows.repartitionByRange(3, *order).withColumn("part", F.spark_partition_id()).write.partitionBy("part").parquet(cut)
    for part in range(3):  # files are taken by age
        v.spark.read.schema(rows.schema).parquet(f"{cut}/part={part}").coalesce(1).write.mode("append").parquet(place)
    return v.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(place)


def workspace(v: Views) -> str:
    return f"{checkpoint_root(v.spark)}/{uuid.uuid4().hex}"


def best(v: Views) -> DataFrame:
    place = workspace(v)
    streams.best_clips(v.as_clips(in_batches(v, v.table("events"))), place).awaitTermination()
    return streams.latest_winners(v.spark, place).select("speaker_id", "duration_seconds", "source_index", "selection_tier", "first_qualifying_index")


def seen(v: Views) -> DataFrame:
    place = workspace(v)
    streams.heartbeat(v.as_clips(in_batches(v, v.table("events"))), place).awaitTermination()
    return streams.heartbeats(v.spark, place).orderBy(c("batch").desc()).limit(1).select("clips_processed", "speakers_seen", "speakers_qualified")


def progress(v: Views) -> DataFrame:
    place = workspace(v)
    streams.progress(v.as_outcomes(in_batches(v, v.table("orders"))).where("accepted"), place).awaitTermination()
    return streams.stored_progress(v.spark, place)


def guard(v: Views) -> DataFrame:
    place = workspace(v)
    streams.failure_guard(v.as_outcomes(in_order(v, v.table("orders"), "o_orderdate", "o_orderkey")), place, v.ORDER).awaitTermination()
    return streams.runs_log(place).read(v.spark).where("abandoned_at is not null").select(INSTANCE, "abandoned_at")


def validated(v: Views) -> DataFrame:
    """Turns of a conversation come in several micro-batches."""
    place = workspace(v)
    streams.validate(in_batches(v, v.turns_timed, "pos"), place, minimum=12).awaitTermination()
    return streams.latest_issues(v.spark, place).select("conv_id", "pos", "turn_id", "level", "rule", "message")


def register(q) -> None:
    from checks.catalog_turns import ALL_SQL

    q("stream_best_clip", best, "SELECT speaker_id, duration_seconds, source_index, selection_tier, first_qualifying_index FROM winners")
    q(
        "stream_speakers_seen",
        seen,
        "SELECT (SELECT count(*) FROM clips) AS clips_processed, (SELECT count(DISTINCT speaker_id) FROM clips) AS speakers_seen, (SELECT count(*) FROM winners) AS speakers_qualified",
    )
    q("stream_progress", progress, "SELECT corpus_combination_id, generated_sec, conversation_count FROM progress")
    q("stream_failure_guard", guard, "SELECT corpus_combination_id, abandoned_at FROM abandoned")
    q("stream_validate", validated, ALL_SQL)
