"""Structured Streaming forms: the batch operators, fed micro-batch by micro-batch.

Each function takes a streaming DataFrame and a folder on shared storage.  Output
goes to files there, never to the driver; the stream's own checkpoint lies beside
them, so a restarted stream goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from duologue.functions import fixed_values as fv
from duologue.operators import planning, quality, voice
from duologue.operators.planning import INSTANCE
from duologue.plans.registry import DeltaLog

def _start(
    stream: DataFrame, folder: str, on_batch: Callable[[DataFrame, int], None], mode: str = "append", trigger: dict | None = None
) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(on_batch)
        .option("checkpointLocation", f"{folder}/_stream")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def speaker_state(clips: DataFrame, target: float = fv.CLIP_TARGET_SEC, minimum: float = fv.CLIP_MIN_SEC) -> DataFrame:
    """Best clip so far per speaker; state is one row per speaker."""
    voice.check_thresholds(target, minimum)
    seconds = F.col("duration_seconds")
    fit = seconds >= minimum
    payload = F.struct(*[c for c in clips.columns if c != "speaker_id"])
    return clips.groupBy("speaker_id").agg(
        F.min_by(payload, F.when(fit, voice.clip_rank(seconds, F.col("source_index"), target))).alias("_win"),
        F.min(F.when(fit, F.col("source_index"))).alias("first_qualifying_index"),
        F.count("*").alias("clips_seen"),
    )


def best_clips(clips: DataFrame, folder: str, **trigger) -> StreamingQuery:
    """Changed speakers per micro-batch, under ``folder/batch=N``; the newest row of a speaker counts.

    With many speakers the session should name a state store that is off the heap.
    """

    def publish(batch: DataFrame, number: int) -> None:
        batch.where("first_qualifying_index is not null").select(
            "speaker_id",
            "_win.*",
            voice.clip_tier(F.col("_win.duration_seconds")).alias("selection_tier"),
            "first_qualifying_index",
        ).write.mode("overwrite").parquet(f"{folder}/winners/batch={number}")

    return _start(speaker_state(clips), folder, publish, "update", trigger)


def latest_winners(spark: SparkSession, folder: str) -> DataFrame:
    """Newest row per speaker of a ``best_clips`` folder."""
    rows = spark.read.parquet(f"{folder}/winners")
    columns = [c for c in rows.columns if c not in ("speaker_id", "batch")]
    return (
        rows.groupBy("speaker_id")
        .agg(F.max_by(F.struct(*columns), "batch").alias("_w"))
        .select("speaker_id", "_w.*")
    )


SPEAKERS = "speaker_id string, qualified boolean"


def heartbeat(clips: DataFrame, folder: str, minimum: float = fv.CLIP_MIN_SEC, **trigger) -> StreamingQuery:
    """One row per micro-batch: its clips, speakers first seen in it, speakers first qualified in it.

    A batch stores the speakers it changes; ``heartbeats`` sums the rows along the log.
    """
    known = DeltaLog(f"{folder}/speakers", SPEAKERS, ("speaker_id",))

    def publish(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        came = batch.groupBy("speaker_id").agg(
            F.count("*").alias("clips"), F.max(F.coalesce(F.col("duration_seconds") >= minimum, F.lit(False))).alias("_fit")
        )
        before = known.read(spark, number).select(F.col("speaker_id").alias("_speaker"), F.col("qualified").alias("_before"))
        changes = came.join(before, F.col("speaker_id").eqNullSafe(F.col("_speaker")) & F.col("_before").isNotNull(), "left").select(
            "speaker_id",
            "clips",
            F.col("_before").isNull().alias("first_seen"),
            (F.col("_fit") & ~F.coalesce("_before", F.lit(False))).alias("first_qualified"),
            (F.col("_fit") | F.coalesce("_before", F.lit(False))).alias("qualified"),
        )
        changes.write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")
        stored = spark.read.schema(changes.schema).parquet(f"{folder}/changes/batch={number}")
        stored.agg(
            F.coalesce(F.sum("clips"), F.lit(0)).alias("clips"),
            F.count_if("first_seen").alias("seen"),
            F.count_if("first_qualified").alias("qualified"),
        ).write.mode("overwrite").parquet(f"{folder}/heartbeat/batch={number}")
        known.write(stored.where("first_seen or first_qualified"), number)

    return _start(clips, folder, publish, trigger=trigger)


def heartbeats(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after each micro-batch; one small row per batch is summed."""
    beats = spark.read.parquet(f"{folder}/heartbeat")
    upto = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = {"clips_processed": "clips", "speakers_seen": "seen", "speakers_qualified": "qualified"}
    return beats.select("batch", *[F.sum(c).over(upto).alias(name) for name, c in totals.items()])


PROGRESS = f"{INSTANCE} bigint, generated_sec {planning.MONEY}, conversation_count bigint"


def progress_log(folder: str) -> DeltaLog:
    return DeltaLog(f"{folder}/progress", PROGRESS, (INSTANCE,), ("generated_sec", "conversation_count"))


def progress(accepted: DataFrame, folder: str, **trigger) -> StreamingQuery:
    """Store accepted conversations, then what they add to their instances' progress.

    A batch reads no earlier progress; running it again overwrites its rows with equal ones.
    """
    log = progress_log(folder)

    def merge(batch: DataFrame, number: int) -> None:
        data = f"{folder}/conversations/batch={number}"
        batch.write.mode("overwrite").parquet(data)
        log.write(planning.progress_rollup(batch.sparkSession.read.schema(batch.schema).parquet(data)), number)

    return _start(accepted, folder, merge, trigger=trigger)


def stored_progress(spark: SparkSession, folder: str) -> DataFrame:
    """Progress of all batches so far."""
    return progress_log(folder).read(spark).withColumn("generated_sec", F.col("generated_sec").cast("double"))


RUNS = f"{INSTANCE} bigint, open_failures bigint, attempts bigint, abandoned_at bigint"


def runs_log(folder: str) -> DeltaLog:
    return DeltaLog(f"{folder}/runs", RUNS, (INSTANCE,))


def failure_guard(
    outcomes: DataFrame, folder: str, order: list[str], limit: int = fv.MAX_CONSECUTIVE_FAILURES, **trigger
) -> StreamingQuery:
    """Runs of failures across micro-batches; an instance is given up at ``limit``.

    Inside a batch the run lengths come from the batch operator, which splits a very busy
    instance over tasks.  A batch stores a row for each instance it changes.
    """
    log = runs_log(folder)

    def advance(batch: DataFrame, number: int) -> None:
        base = log.read(batch.sparkSession, number).join(batch.select(INSTANCE).distinct(), INSTANCE, "left_semi")
        runs = planning.failure_runs(batch, order, open_runs=base)
        changed = runs.groupBy(INSTANCE).agg(
            F.max_by("consecutive_failures", "attempt_no").alias("open_failures"),
            F.max("attempt_no").alias("attempts"),
            F.min(F.when(F.col("consecutive_failures") == limit, F.col("attempt_no"))).alias("_hit"),
        )
        log.write(
            changed.join(base.select(INSTANCE, "abandoned_at"), INSTANCE, "left").withColumn("abandoned_at", F.coalesce("abandoned_at", "_hit")), number
        )

    return _start(outcomes, folder, advance, trigger=trigger)


#: Buckets that turns of open conversations are kept in.
BUCKETS = 64
VERSIONS = "bucket int, version bigint"


def bucket_log(folder: str) -> DeltaLog:
    """Per bucket the batch that wrote it last."""
    return DeltaLog(f"{folder}/buckets", VERSIONS, ("bucket",))


def open_turns(spark: SparkSession, folder: str, batches: int, schema: str | T.StructType, buckets: list[int] | None = None) -> DataFrame:
    """Turns of conversations that are open after ``batches`` batches, of the given buckets only."""
    found = bucket_log(folder).read(spark, batches)
    places = [f"{folder}/open/v={r.version}/bucket={r.bucket}" for r in found.where("version is not null").collect() if buckets is None or r.bucket in buckets]
    if not places:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*places)


def validate(turns: DataFrame, folder: str, minimum: int = 2, closes: str | None = None, buckets: int = BUCKETS, **trigger) -> StreamingQuery:
    """Check every conversation that a micro-batch adds turns to, with all its turns so far.

    A conversation may come in any number of batches; its newest check counts
    (``latest_issues``).  Turns of open conversations are kept in buckets by ``conv_id``: a
    batch reads and rewrites the buckets of its own conversations.  A turn with a true
    ``closes`` (a column's name) ends its conversation: it is checked once more and never
    read again.  Turns that come after that make a conversation of their own.
    """
    log = bucket_log(folder)
    bucket = F.pmod(F.hash("conv_id"), F.lit(buckets)).alias("bucket")

    def check(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = f"{folder}/turns/batch={number}"
        batch.write.mode("overwrite").parquet(new)
        came = spark.read.schema(batch.schema).parquet(new)
        touched = came.select("conv_id").distinct()
        hit = [r.bucket for r in touched.select(bucket).distinct().collect()]  # at most one number per bucket
        kept = open_turns(spark, folder, number, batch.schema, hit)
        both = kept.unionByName(came)
        touched.write.mode("overwrite").parquet(f"{folder}/checked/batch={number}")
        quality.validate_turns(both.join(touched, "conv_id", "left_semi"), minimum=minimum).write.mode("overwrite").parquet(f"{folder}/issues/batch={number}")
        if closes:
            both = both.join(both.where(F.col(closes)).select("conv_id").distinct(), "conv_id", "left_anti")
        spread = F.pmod(F.hash("conv_id", "pos"), F.lit(4))
        both.select(*batch.columns, bucket).repartition("bucket", spread).write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/open/v={number}")
        # a bucket whose conversations are all closed has no folder of its own
        held = both.select(bucket).distinct().collect()
        versions = [(r.bucket, number) for r in held] + [(b, None) for b in hit if b not in {r.bucket for r in held}]
        log.write(spark.createDataFrame(versions, VERSIONS), number)

    return _start(turns, folder, check, trigger=trigger)


def latest_issues(spark: SparkSession, folder: str) -> DataFrame:
    """Issues of each conversation's newest check."""
    newest = spark.read.parquet(f"{folder}/checked").groupBy("conv_id").agg(F.max("batch").alias("batch"))
    return spark.read.parquet(f"{folder}/issues").join(newest, ["conv_id", "batch"]).drop("batch")
