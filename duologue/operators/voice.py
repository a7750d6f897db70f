"""Clip normalisation and one-best-clip-per-speaker selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duologue.functions import fixed_values as fv
from duologue.functions.text import lookup, round_half_up, slug, strip
from duologue.operators.ordered import block_of, number_by_text, number_rows


# ---- expressions -------------------------------------------------------------
def gender(raw: Column) -> Column:
    """male, female, unknown (null or blank-like) or other."""
    text = F.lower(strip(raw.cast("string")))
    return (
        F.when(raw.isNull() | text.isin(fv.GENDER_BLANKS), F.lit("unknown"))
        .otherwise(F.coalesce(lookup(fv.GENDER_ALIASES, text), F.lit("other")))
    )


def speaker_code(path: Column) -> Column:
    """Lower-cased speaker code in a clip path, NULL when there is none."""
    return F.nullif(F.lower(F.regexp_extract(path, fv.SPEAKER_CODE, 1)), F.lit(""))


def speaker_fingerprint(
    source_index: Column, fields: Sequence[str] = fv.FINGERPRINT_FIELDS, absent: Sequence[str] = ()
) -> Column:
    """Digest of descriptive fields; a null field reads ``None``, an absent one is blank."""
    parts = [
        F.lit("") if name in absent else F.coalesce(F.col(name).cast("string"), F.lit("None"))
        for name in fields
    ]
    joined = F.concat_ws("|", *parts)
    blank = F.regexp_replace(joined, r"^\|+|\|+$", "") == ""
    digest = F.concat(F.lit("spk_"), F.substring(F.sha1(joined.cast("binary")), 1, 10))
    return F.when(blank, unknown_speaker(source_index)).otherwise(digest)


def unknown_speaker(source_index: Column) -> Column:
    return F.concat(F.lit("unknown_spk_"), source_index.cast("string"))


def speaker_or_unknown(speaker: Column, source_index: Column) -> Column:
    """The id itself, unless it is null, empty or the number zero; a text ``0`` is an id."""
    text = speaker.cast("string")
    numeric = F.typeof(speaker).rlike("^(tinyint|smallint|int|bigint|float|double|decimal.*)$")
    zero = numeric & F.coalesce(speaker.try_cast("double") == 0, F.lit(False))
    return F.when(text.isNull() | (text == "") | zero, unknown_speaker(source_index)).otherwise(text)


def clip_tier(
    seconds: Column, target: float = fv.CLIP_TARGET_SEC, minimum: float = fv.CLIP_MIN_SEC
) -> Column:
    return F.when(seconds >= target, "primary_ge_target").when(
        seconds >= minimum, "fallback_below_target"
    )


def clip_rank(
    seconds: Column,
    source_index: Column,
    target: float = fv.CLIP_TARGET_SEC,
) -> Column:
    """Ascending preference: target reached first, then distance, then arrival."""
    return F.struct(
        (seconds < target).cast("int").alias("tier"),
        F.abs(seconds - F.lit(target)).alias("distance"),
        source_index.alias("source_index"),
    )


def check_thresholds(target: float, minimum: float) -> None:
    if minimum > target:
        raise ValueError("the minimum clip length cannot exceed the target length")


# ---- operators ---------------------------------------------------------------
def decode_labels(df: DataFrame, classes: DataFrame, column: str) -> DataFrame:
    """Replace a class number by its name; unknown numbers stay as they are.

    ``classes`` holds ``(column_name, code, name)``; the optimizer's byte limit decides
    whether it is broadcast.
    """
    names = classes.where(F.col("column_name") == column).select(
        F.col("code").cast("string").alias("_code"), F.col("name").alias("_name")
    )
    raw = F.col(column).cast("string")
    return (
        df.join(names, raw == F.col("_code"), "left")
        .withColumn(column, F.coalesce("_name", raw))
        .drop("_code", "_name")
    )


#: The columns that corpora store as class numbers.
CLASS_COLUMNS = ["gender", "age_group", "job_type", "qualification", "area", "state", "scenario"]


def decode_classes(df: DataFrame, classes: DataFrame, columns: Sequence[str] = tuple(CLASS_COLUMNS)) -> DataFrame:
    """All class columns by name in one pass; unknown numbers stay as they are, nulls stay null.

    ``classes`` holds ``(column_name, code, name)``.  It comes with the corpus' schema, a
    class per row, so it fits one map that every task gets.
    """
    present = [c for c in columns if c in df.columns]
    cell = F.struct(F.concat_ws(":", "column_name", F.col("code").cast("string")).alias("k"), F.col("name").alias("v"))
    known = classes.where(F.col("column_name").isin(present)).dropDuplicates(["column_name", "code"])
    names = known.agg(F.map_from_entries(F.collect_list(cell)).alias("names"))
    named = df.withColumn("__names", names.scalar())
    decoded = {c: F.coalesce(F.try_element_at("__names", F.concat(F.lit(f"{c}:"), F.col(c).cast("string"))), F.col(c).cast("string")) for c in present}
    return named.withColumns(decoded).drop("__names")


def codes_of(classes: DataFrame, column: str, name: str) -> list[str]:
    """The raw values, as texts, that decode to a name: its numbers, and the name itself where no class has it as number."""
    rows = classes.where(F.col("column_name") == column).select(F.col("code").cast("string").alias("code"), "name").collect()
    return [r.code for r in rows if r.name == name] + [name] * (name not in {r.code for r in rows})


def best_clip_per_speaker(
    clips: DataFrame,
    *,
    keys: Sequence[str] = ("speaker_id",),
    target: float = fv.CLIP_TARGET_SEC,
    minimum: float = fv.CLIP_MIN_SEC,
) -> DataFrame:
    """One clip per speaker: shortest of those reaching the target, else the longest.

    A single ``min_by`` keeps only the best clip per speaker on the map side, so a
    speaker with very many clips never gathers in one task.  Only narrow columns
    travel; audio bytes are fetched for the winners later.
    """
    check_thresholds(target, minimum)
    seconds = F.col("duration_seconds")
    payload = [c for c in clips.columns if c not in keys]
    won = (
        clips.where(seconds >= minimum)
        .groupBy(*keys)
        .agg(
            F.min_by(F.struct(*payload), clip_rank(seconds, F.col("source_index"), target)).alias("_win"),
            F.min("source_index").alias("first_qualifying_index"),
        )
    )
    return won.select(
        *keys,
        *[F.col(f"_win.{c}").alias(c) for c in payload],
        clip_tier(F.col("_win.duration_seconds"), target, minimum).alias("selection_tier"),
        "first_qualifying_index",
    )


def speaker_cap(winners: DataFrame, limit: int | None) -> DataFrame:
    """First ``limit`` speakers by their first qualifying clip; no limit keeps all."""
    if limit is None:
        return winners
    ties = [x for x in ("source_dataset", "language", "speaker_id") if x in winners.columns]
    return winners.orderBy("first_qualifying_index", *ties).limit(limit)


def discarded_speakers(clips: DataFrame, winners: DataFrame) -> DataFrame:
    """Speakers seen but not selected."""
    return clips.select("speaker_id").distinct().join(winners.select("speaker_id"), "speaker_id", "left_anti")


def anonymised_folders(winners: DataFrame) -> DataFrame:
    """Number the winners of each gender in speaker order: ``speaker_1``, ``speaker_2``..."""
    numbered = number_by_text(winners, ["gender"], "speaker_id", "_k")
    return numbered.withColumn("folder", F.concat(F.lit("speaker_"), F.col("_k").cast("string"))).drop("_k")


def voice_report(clips: DataFrame, winners: DataFrame, uploaded: int = 0) -> DataFrame:
    """Counts per language; discarded is taken after any cap."""
    seen = clips.groupBy("language").agg(F.countDistinct("speaker_id").alias("speakers_seen"))
    by_gender = winners.groupBy("language", "gender").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("selection_tier") == "primary_ge_target").alias("n_primary"),
        F.sum(F.col("duration_seconds").cast("decimal(28,6)")).alias("seconds"),
    )
    chosen = by_gender.groupBy("language").agg(
        F.sum("n").alias("speakers_selected"),
        F.sum("n_primary").alias("primary_tier_count"),
        F.sum("seconds").alias("seconds"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("gender", "n")))).alias("gender_breakdown"),
    )
    zero = F.lit(0).cast("bigint")
    return seen.join(chosen, "language", "left").select(
        "language",
        "speakers_seen",
        F.coalesce("speakers_selected", zero).alias("speakers_selected"),
        (F.col("speakers_seen") - F.coalesce("speakers_selected", zero)).alias("speakers_discarded"),
        F.coalesce("primary_tier_count", zero).alias("primary_tier_count"),
        F.coalesce(F.col("speakers_selected") - F.col("primary_tier_count"), zero).alias("fallback_tier_count"),
        round_half_up(F.coalesce(F.col("seconds").cast("double"), F.lit(0.0)), 2).alias(
            "total_selected_duration_seconds"
        ),
        F.coalesce("gender_breakdown", F.create_map().cast("map<string,bigint>")).alias("gender_breakdown"),
        F.lit(uploaded).cast("bigint").alias("uploaded_file_count"),
    )


def winner_bytes(winners: DataFrame, audio: DataFrame, keys: Sequence[str] = ("source_dataset", "source_index")) -> DataFrame:
    """Fetch the payload of winning clips only.

    ``audio`` keeps its bytes behind the join: the winners' keys are the small
    side and Spark broadcasts or shuffles them by their measured size.
    """
    return audio.join(winners.select(*keys, "speaker_id"), list(keys))


def speaker_paths(winners: DataFrame, folder: Column | None = None) -> DataFrame:
    """Two files per winner: the audio and its metadata document."""
    place = F.concat_ws("/", "language", "gender", folder if folder is not None else slug(F.col("speaker_id")))
    return winners.select("*", F.explode(F.array(F.lit("audio.wav"), F.lit("metadata.json"))).alias("file")).select(
        "*", F.concat_ws("/", place, "file").alias("path")
    )


def speaker_metadata(winners: DataFrame, exported_seconds: Column | None = None) -> DataFrame:
    """Metadata document per winner."""
    exported = exported_seconds if exported_seconds is not None else F.col("duration_seconds")
    return winners.select(
        "speaker_id",
        "language",
        "gender",
        "transcript",
        round_half_up(exported, 3).alias("duration_seconds"),
        round_half_up(F.col("duration_seconds"), 3).alias("original_duration_seconds"),
        "selection_tier",
        "source_dataset",
        "source_index",
        F.lit("audio.wav").alias("audio_file"),
        *[F.col(c).alias("metadata") for c in winners.columns if c == "extra_metadata"],
    )


def export_completeness(listing: DataFrame, reports: DataFrame, max_speakers: int | None = None) -> DataFrame:
    """Is every selected speaker of a language on disk with both files?

    ``listing`` holds ``language, gender, speaker, file``.  A capped run never
    counts as complete.
    """
    folders = listing.groupBy("language", "gender", "speaker").agg(
        (F.bool_or(F.col("file") == "audio.wav") & F.bool_or(F.col("file") == "metadata.json")).alias("whole")
    )
    counted = folders.groupBy("language").agg(F.count_if("whole").alias("complete_speakers"))
    found = F.coalesce(F.col("complete_speakers"), F.lit(0).cast("bigint"))
    return reports.select("language", "speakers_selected").join(counted, "language", "left").select(
        "language",
        "speakers_selected",
        found.alias("complete_speakers"),
        (F.lit(max_speakers is None) & (found == F.col("speakers_selected")) & (found > 0)).alias("is_complete"),
    )


def resume_plan(requested: DataFrame, completeness: DataFrame) -> DataFrame:
    """Languages to reuse and languages to recompute."""
    return requested.join(completeness.select("language", "is_complete"), "language", "left").select(
        "language",
        F.when(F.coalesce("is_complete", F.lit(False)), "reuse").otherwise("recompute").alias("action"),
    )


def source_ordinal(df: DataFrame, order: str, name: str = "source_index") -> DataFrame:
    """0-based ordinal over the whole source, in ``order`` (a non-negative number)."""
    blocked = df.withColumn("_block", block_of(F.col(order)))
    numbered = number_rows(blocked, [], [order], ["_block"], "_n")
    return numbered.withColumn(name, F.col("_n") - 1).drop("_block", "_n")
