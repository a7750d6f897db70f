"""Publishing: paths, documents, incremental uploads and registries on disk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duologue.functions import fixed_values as fv
from duologue.functions.text import round_half_up, strip
from duologue.operators.ordered import number_by_text


# ---- paths -------------------------------------------------------------------
def language_folder(language: Column) -> Column:
    return F.coalesce(F.nullif(F.lower(strip(language)), F.lit("")), F.lit("unknown"))


def padded(number: Column, width: int = 4) -> Column:
    """Zero-padded number; longer numbers keep all digits."""
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def conversation_path(language: Column, instance: Column, index: Column) -> Column:
    return F.concat(
        language_folder(language), F.lit("/instance_"), padded(instance), F.lit("/conversation_"), padded(index), F.lit(".json")
    )


def run_id(stamp: Column, instance: Column, index: Column, key: Column) -> Column:
    """UTC stamp, instance, index and a short suffix derived from the key."""
    return F.concat(
        F.date_format(stamp, "yyyyMMdd_HHmmss"),
        F.lit("_corpus"),
        instance.cast("string"),
        F.lit("_conv"),
        padded(index),
        F.lit("_"),
        F.substring(F.sha1(key.cast("string").cast("binary")), 1, 8),
    )


def dev_files(conversations: DataFrame) -> DataFrame:
    """Three files per accepted conversation; no transcript file without a transcript."""
    files = F.array_compact(
        F.array(
            F.lit("conversation.json"),
            F.lit("metadata.txt"),
            F.when(F.coalesce("transcript", F.lit("")) != "", "transcript.txt"),
        )
    )
    return conversations.select(
        "corpus_combination_id", "index", "run_id", language_folder(F.col("language")).alias("language"), F.explode(files).alias("file")
    ).withColumn("path", F.concat_ws("/", "language", "run_id", "file"))


# ---- documents ---------------------------------------------------------------
def payloads(conversations: DataFrame, turn_documents: DataFrame) -> DataFrame:
    """Stored JSON of accepted conversations, one document each at any length.

    ``turn_documents`` holds ``conv_id, turns_json``.  The profile leaves out missing
    attributes.
    """
    profile = F.struct("language", "agent_emotion", "user_emotion", "agent_accent", "user_accent", "gender_pair")
    topic = F.struct("title", "context", "conversation_type")
    head = F.to_json(F.struct("corpus_combination_id", "index", profile.alias("profile"), topic.alias("topic"), "duration_sec", "passed", "include_numbers"))
    joined = conversations.join(turn_documents, "conv_id")
    body = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"turns":'), F.col("turns_json"), F.lit("}"))
    return joined.select("corpus_combination_id", "index", language_folder(F.col("language")).alias("language"), body.alias("body"))


#: Counters of the summary and the columns that hold how many were used and allowed.
ATTEMPTS = [
    ("generation_attempts", "max_generation_attempts"),
    ("format_attempts", "max_format_attempts"),
    ("content_checks", "max_content_checks"),
    ("format_checks", "max_format_checks"),
]
FLAGS = ["content_bypassed", "format_bypassed", "format_exhausted"]


def sidecar(conversations: DataFrame) -> DataFrame:
    """Human-readable summary of each accepted conversation.

    ``type_counts`` (``turn_type, n`` of every type found), ``field_matches`` (a map),
    scores, flags, allowed attempts and the judges' feedback may be absent columns or
    null: counts are then 0, flags false, allowed numbers ``None``, and lists, scores and
    feedback leave no line.
    """
    have = {x.name: x.dataType for x in conversations.schema.fields}
    gone = [n for pair in ATTEMPTS for n in pair] + ["content_feedback", "format_feedback", "realism_score", "corpus_match_score"]
    kinds = {n: "string" for n in gone} | {n: "boolean" for n in FLAGS}
    kinds |= {"type_counts": "array<struct<turn_type:string,n:bigint>>", "field_matches": "map<string,boolean>"}
    conversations = conversations.withColumns({n: F.lit(None).cast(k) for n, k in kinds.items() if n not in have})
    c = F.col
    text = lambda name: F.coalesce(c(name).cast("string"), F.lit(""))
    none = lambda value: F.coalesce(value.cast("string"), F.lit("None"))
    line = lambda label, value: F.concat(F.lit(f"{label}: "), value)
    seconds = lambda name: none(c(name).cast("decimal(18,2)"))
    minutes = lambda name: none(
        F.when(c(name) > 0, round_half_up(c(name) / F.lit(60.0), 2).cast("decimal(18,2)"))
    )
    retries = lambda name: F.greatest(F.lit(0), F.coalesce(c(name), F.lit(0)) - 1).cast("string")
    some = lambda value: F.nullif(value, F.lit(""))
    judged = c("content_verdict").isNotNull()
    matches = F.array_sort(F.map_entries("field_matches"))
    total = sum((c(k) for k in fv.TURN_TYPES[1:]), c(fv.TURN_TYPES[0]))
    body = F.concat_ws(
        "\n",
        line("run_id", c("run_id")),
        line("corpus_combination_id", text("corpus_combination_id")),
        line("conversation_index", text("index")),
        line("passed", text("passed")),
        line("include_numbers", text("include_numbers")),
        F.lit("\n## Topic"),
        *[line(n, text(n)) for n in ("title", "conversation_type", "context")],
        F.lit("\n## Profile"),
        *[line(n, text(n)) for n in ("language", "gender_pair", "agent_emotion", "user_emotion", "agent_accent", "user_accent")],
        F.lit("\n## Duration"),
        line("duration_sec", seconds("duration_sec")),
        line("duration_min", minutes("duration_sec")),
        line("target_duration_sec", seconds("target_sec")),
        line("target_duration_min", minutes("target_sec")),
        F.lit("\n## Turn counts"),
        line("total_turns", total.cast("string")),
        line("backchannel_count", text("Backchanneling")),
        line("overlap_count", text("Overlapping")),
        line("interruption_count", text("Interruption")),
        line("normal_count", text("Normal")),
        some(F.array_join(F.transform(F.array_sort("type_counts"), lambda x: F.concat(F.lit("  "), x["turn_type"], F.lit(": "), x["n"].cast("string"))), "\n")),
        F.lit("\n## Retries"),
        *[line(f"{used}_used", F.concat(F.coalesce(c(used).cast("string"), F.lit("0")), F.lit(" of "), none(c(most)))) for used, most in ATTEMPTS],
        line("generation_retries", retries("generation_attempts")),
        line("format_retries", retries("format_attempts")),
        *[line(flag, F.coalesce(c(flag), F.lit(False)).cast("string")) for flag in FLAGS],
        F.lit("\n## Content validation"),
        line("verdict", F.coalesce(c("content_verdict"), F.lit("none given"))),
        *[F.when(judged, some(F.concat(F.lit(f"{n}: "), c(n).cast("string")))) for n in ("realism_score", "corpus_match_score")],
        F.when(judged, some(F.array_join(F.transform(matches, lambda x: F.concat(F.lit("  "), x["key"], F.lit(": "), F.coalesce(x["value"].cast("string"), F.lit("None")))), "\n"))),
        F.when(judged, some(F.concat(F.lit("feedback: "), F.nullif(c("content_feedback"), F.lit(""))))),
        F.lit("\n## Format validation"),
        line("verdict", F.coalesce(c("format_verdict"), F.lit("none given"))),
        F.when(c("format_verdict").isNotNull(), some(F.concat(F.lit("feedback: "), F.nullif(c("format_feedback"), F.lit(""))))),
    )
    return conversations.select("corpus_combination_id", "index", body.alias("metadata"))


# ---- uploads -----------------------------------------------------------------
def relative_listing(remote: DataFrame, prefix: str, column: str = "path") -> DataFrame:
    """Remote names relative to a prefix; others are left out, no prefix keeps all."""
    place = prefix.strip("/")
    path = F.col(column)
    if not place:
        return remote.where(path.isNotNull() & (path != "")).select(path.alias("path")).distinct()
    name = F.when(path == place, F.substring_index(path, "/", -1)).when(
        F.startswith(path, F.lit(place + "/")), F.substring(path, len(place) + 2, 1 << 30)
    )
    return remote.select(name.alias("path")).where(F.col("path").isNotNull()).distinct()


def upload_plan(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Local files that are not yet remote."""
    return local.join(remote.select("path").distinct(), "path", "left_anti")


def upload_batches(plan: DataFrame, batch: int = fv.UPLOAD_BATCH) -> DataFrame:
    """Number files by path and cut them into batches; no task sees the whole listing."""
    numbered = number_by_text(plan, [], "path", "file_no")
    return numbered.withColumn("batch_no", F.floor((F.col("file_no") - 1) / F.lit(batch)).cast("bigint"))


def copy_plan(source: DataFrame, target: DataFrame, *, same_place: bool = False) -> DataFrame:
    """Files to copy and their number; for the same place only the number counts."""
    if same_place:
        return source.agg(F.count("*").alias("n_files")).withColumn("action", F.lit("count"))
    return upload_plan(source, target).agg(F.count("*").alias("n_files")).withColumn("action", F.lit("copy"))


# ---- writers -----------------------------------------------------------------
def write_conversations(payloads: DataFrame, folder: str, buckets: int = 64) -> None:
    """JSON lines under ``language=`` folders; a language's instances are dealt to at most ``buckets`` files."""
    bucket = F.pmod(F.hash("corpus_combination_id"), F.lit(buckets))
    payloads.repartition("language", bucket).write.mode("append").partitionBy("language").json(folder)


def registry_rows(document: DataFrame, entry_schema: str, column: str = "value") -> DataFrame:
    """A ``{"instances": {id: entry}}`` document as one row per entry."""
    parsed = F.from_json(F.col(column), f"updated_at string, instances map<string, struct<{entry_schema}>>")
    return (
        document.select(parsed.alias("_d"))
        .select(F.explode("_d.instances").alias("key", "_e"))
        .select(F.col("key").cast("bigint").alias("registry_key"), "_e.*")
    )


def voice_reports(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Stored language summaries with typed defaults; unreadable ones are absent."""
    schema = (
        "language string, speakers_seen bigint, speakers_selected bigint, speakers_discarded bigint, "
        "primary_tier_count bigint, fallback_tier_count bigint, total_selected_duration_seconds double, "
        "gender_breakdown map<string,bigint>, uploaded_file_count bigint, _corrupt_record string"
    )
    return default_report(spark.read.schema(schema).option("multiLine", True).json(paths))


def default_report(raw: DataFrame) -> DataFrame:
    """Missing counts are 0, a missing breakdown is empty; rows without language are dropped."""
    usable = raw.where("language is not null")
    if "_corrupt_record" in raw.columns:
        usable = usable.where("_corrupt_record is null").drop("_corrupt_record")
    defaults = []
    for field in usable.schema:
        column = F.col(field.name)
        if field.name.startswith(("speakers_", "primary_", "fallback_", "uploaded_")):
            column = F.coalesce(column, F.lit(0).cast("bigint"))
        elif field.name.startswith("total_"):
            column = F.coalesce(column, F.lit(0.0))
        elif field.name == "gender_breakdown":
            column = F.coalesce(column, F.create_map().cast("map<string,bigint>"))
        defaults.append(column.alias(field.name))
    return usable.select(*defaults)
