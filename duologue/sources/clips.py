"""Adapters from two speech corpora to one clip schema."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duologue.functions.text import blank_to_null
from duologue.operators import voice

CLIP_COLUMNS = [
    "speaker_id", "language", "gender", "duration_seconds", "transcript",
    "audio_path", "source_dataset", "source_index", "extra_metadata",
]

# Descriptive columns each corpus keeps as free metadata.
ACCENTED_METADATA = [
    "age_group", "primary_language", "native_place_state", "native_place_district",
    "highest_qualification", "job_category", "occupation_domain",
]
INDIC_METADATA = [
    "age_group", "job_type", "qualification", "area", "district", "state",
    "occupation", "task_name", "scenario", "snr", "c50", "speaking_rate",
]


def metadata_map(names: list[str], present: list[str]) -> Column:
    """Named columns as a string map; columns the source lacks are null entries."""
    cells: list[Column] = []
    for name in names:
        cells += [F.lit(name), (F.col(name) if name in present else F.lit(None)).cast("string")]
    return F.create_map(*cells)


def accented_english(raw: DataFrame, dataset: str) -> DataFrame:
    """Accented-English corpus; the speaker comes from the path or a fingerprint."""
    index = F.col("source_index")
    absent = [c for c in voice.fv.FINGERPRINT_FIELDS if c not in raw.columns]
    return raw.select(
        F.coalesce(
            voice.speaker_code(F.col("audio_path")), voice.speaker_fingerprint(index, absent=absent)
        ).alias("speaker_id"),
        F.lit("english").alias("language"),
        voice.gender(F.col("gender")).alias("gender"),
        F.coalesce(F.col("duration").cast("double"), F.lit(0.0)).alias("duration_seconds"),
        F.coalesce(F.col("text"), F.lit("")).alias("transcript"),
        "audio_path",
        F.lit(dataset).alias("source_dataset"),
        index.cast("bigint").alias("source_index"),
        metadata_map(ACCENTED_METADATA, raw.columns).alias("extra_metadata"),
    )


def indic(raw: DataFrame, dataset: str) -> DataFrame:
    """Indic corpus; ``source_index`` was counted after the language filter."""
    index = F.col("source_index")
    transcript = F.coalesce(
        F.nullif(F.col("normalized"), F.lit("")),
        F.nullif(F.col("verbatim"), F.lit("")),
        F.col("text"),
        F.lit(""),
    )
    return raw.select(
        voice.speaker_or_unknown(F.col("speaker_id"), index).alias("speaker_id"),
        F.lit("hindi").alias("language"),
        voice.gender(F.col("gender")).alias("gender"),
        F.coalesce(F.col("duration").cast("double"), F.lit(0.0)).alias("duration_seconds"),
        transcript.alias("transcript"),
        "audio_path",
        F.lit(dataset).alias("source_dataset"),
        index.cast("bigint").alias("source_index"),
        metadata_map(INDIC_METADATA, raw.columns).alias("extra_metadata"),
    )


def language_filter(raw: DataFrame, column: str | None, value: str | None) -> DataFrame:
    """Optional equality filter; on a raw column it reaches the Parquet scan."""
    if not column or value is None:
        return raw
    return raw.where(F.col(column) == value)


def named_filter(raw: DataFrame, classes: DataFrame, column: str | None, name: str | None) -> DataFrame:
    """Equality filter on the decoded name of a class column.

    The name turns into the raw values that stand for it before anything is read, so the
    filter is one on the stored numbers and reaches the Parquet scan.
    """
    if not column or name is None:
        return raw
    kind = raw.schema[column].dataType
    codes = voice.codes_of(classes, column, name)
    if not isinstance(kind, T.StringType):
        codes = [int(x) for x in codes if re.fullmatch(r"-?[0-9]{1,18}", x) and str(int(x)) == x]
    return raw.where(F.col(column).isin(codes)) if codes else raw.where(F.lit(False))


def union_sources(by_language: Mapping[str, DataFrame]) -> DataFrame:
    """All corpora in run order (``language_order``) under the common schema."""
    merged: DataFrame | None = None
    for order, (_, clips) in enumerate(by_language.items()):
        tagged = clips.withColumn("language_order", F.lit(order))
        merged = tagged if merged is None else merged.unionByName(tagged, allowMissingColumns=True)
    if merged is None:
        raise ValueError("no source given")
    return merged


def audio_files(spark: SparkSession, folder: str, glob: str = "*.wav") -> DataFrame:
    """Undecoded clips as path, size and bytes; unread columns are never loaded."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length", "content")
    )


#: Chunks of a file's head that are looked at.
HEAD_CHUNKS = 16


def _little(content: Column, at: Column, size: int) -> Column:
    """A little-endian unsigned number of ``size`` bytes from offset ``at``; null beyond the end."""
    cells = [F.hex(F.substr(content, at + F.lit(i + 1), F.lit(1))) for i in reversed(range(size))]
    return F.when(F.octet_length(content) >= at + size, F.conv(F.concat(*cells), 16, 10).cast("bigint"))


def wav_header(content: Column, length: Column | None = None) -> Column:
    """``sample_rate, channels, byte_rate, data_bytes, duration`` of a WAV file, from its chunk heads alone.

    Only the heads are looked at, so ``content`` may stop before the payload.  A size that
    was never filled in (0 or all ones) is what ``length``, the whole file's bytes, leaves;
    null where neither tells, and for what is no WAV file.
    """
    nothing = [F.lit(None).cast("bigint").alias(c) for c in ("sample_rate", "channels", "byte_rate", "data_bytes", "data_at")]
    start = F.struct(F.lit(12).cast("bigint").alias("at"), *nothing)

    def step(state: Column, _: Column) -> Column:
        at = state["at"]
        name, size = F.substr(content, at.cast("int") + 1, F.lit(4)), _little(content, at + 4, 4)
        fmt = name == F.lit(bytearray(b"fmt "))
        data = (name == F.lit(bytearray(b"data"))) & state["data_at"].isNull()
        found = lambda c, value: F.coalesce(state[c], F.when(fmt, value)).alias(c)
        return F.struct(
            # beyond 1 GiB there is no head that was read
            F.when(data | size.isNull(), at).otherwise(F.least(at + 8 + size + size % 2, F.lit(1 << 30))).alias("at"),
            found("sample_rate", _little(content, at + 12, 4)),
            found("channels", _little(content, at + 10, 2)),
            found("byte_rate", _little(content, at + 16, 4)),
            F.coalesce(state["data_bytes"], F.when(data, size)).alias("data_bytes"),
            F.coalesce(state["data_at"], F.when(data, at + 8)).alias("data_at"),
        )

    wav = (F.substr(content, F.lit(1), F.lit(4)) == F.lit(bytearray(b"RIFF"))) & (F.substr(content, F.lit(9), F.lit(4)) == F.lit(bytearray(b"WAVE")))
    head = F.when(wav, F.aggregate(F.sequence(F.lit(1), F.lit(HEAD_CHUNKS)), start, step))
    whole = F.lit(None).cast("bigint") if length is None else length
    size = F.when(head["data_bytes"].isin(0, 0xFFFFFFFF), whole - head["data_at"]).otherwise(head["data_bytes"])
    return F.struct(
        head["sample_rate"].alias("sample_rate"),
        head["channels"].alias("channels"),
        head["byte_rate"].alias("byte_rate"),
        size.alias("data_bytes"),
        (size / F.nullif(head["byte_rate"], F.lit(0))).alias("duration"),
    )


def undecoded(clips: DataFrame) -> DataFrame:
    """Clips held in a table (``path, content``) in the form of ``audio_files``; bytes stay as they are."""
    return clips.select("path", F.octet_length("content").cast("bigint").alias("length"), "content")
