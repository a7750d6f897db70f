"""Interval joins inside a conversation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duologue.functions.text import round_half_up


#: Bucket widths grow by this factor from level to level; the last one takes all longer spans.
RADIX = 16
LEVELS = 6


def bucket_visits(turns: DataFrame, keys: Sequence[str], bucket_sec: float) -> tuple[DataFrame, Column]:
    """Spans with the level ``at`` and number of every bucket they visit, and the width of such a bucket."""
    length = F.col("e") - F.col("s")
    level = sum(((length > bucket_sec * RADIX**i).cast("int") for i in range(LEVELS - 1)), F.lit(0))
    spans = turns.where("planned_end_sec > planned_start_sec").select(
        *keys, "pos", "turn_id", "speaker", F.col("planned_start_sec").alias("s"), F.col("planned_end_sec").alias("e")
    ).withColumn("level", level)
    present = spans.agg(F.collect_set("level")).scalar()
    width = F.lit(bucket_sec) * F.pow(F.lit(float(RADIX)), F.col("at"))
    bucket = lambda c: F.floor(F.col(c) / width)
    visits = spans.withColumn("_all", present).withColumn("at", F.explode(F.filter("_all", lambda x: x >= F.col("level")))).drop("_all")
    visits = visits.withColumn("bucket", F.explode(F.sequence(bucket("s"), bucket("e"))))
    return visits, width


def simultaneous_speech(
    turns: DataFrame, keys: Sequence[str] = ("conv_id",), *, bucket_sec: float = 10.0
) -> DataFrame:
    """Pairs of turns by different speakers whose spans intersect, with the shared seconds.

    A span belongs to the level whose buckets are as wide as itself or wider, so it touches
    two of them at most, and visits those of the coarser levels that any span belongs to.
    A pair meets at the coarser of its two levels, in the bucket in which its later turn
    starts.  So one very long span neither lies in many buckets nor meets anything twice.
    """
    visits, width = bucket_visits(turns, keys, bucket_sec)
    columns = ("pos", "turn_id", "speaker", "s", "e")
    a = visits.where("at = level").select(*keys, "at", "bucket", *[F.col(c).alias(f"a_{c}") for c in columns])
    b = visits.select(*keys, "at", "bucket", "level", *[F.col(c).alias(f"b_{c}") for c in columns])
    later = F.greatest("a_s", "b_s")
    met = a.join(b, [*keys, "at", "bucket"]).where(
        ((F.col("level") < F.col("at")) | (F.col("a_pos") < F.col("b_pos")))
        & (F.col("a_speaker") != F.col("b_speaker"))
        & (F.col("a_s") < F.col("b_e"))
        & (F.col("b_s") < F.col("a_e"))
        & (F.col("bucket") == F.floor(later / width))
    )
    first = F.col("a_pos") < F.col("b_pos")
    return met.select(
        *keys,
        F.when(first, F.col("a_turn_id")).otherwise(F.col("b_turn_id")).alias("turn_a"),
        F.when(first, F.col("b_turn_id")).otherwise(F.col("a_turn_id")).alias("turn_b"),
        round_half_up(F.least("a_e", "b_e") - later, 2).alias("overlap_sec"),
    )
