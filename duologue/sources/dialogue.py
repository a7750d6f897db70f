"""Readers for corpora, turn files and stored conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duologue.functions.text import strip
from duologue.operators.ordered import number_rows

CORPUS_SCHEMA = (
    "corpus_combination_id bigint, language string, agent_emotion string, user_emotion string, "
    "agent_accent string, user_accent string, gender_pair string, joint_probability double, "
    "duration_sec double, duration_hr double, est_conversations_needed bigint"
)
TURN_SCHEMA = (
    "turn_id string, speaker string, text string, emotion string, planned_start_sec double, "
    "planned_end_sec double, real_start_sec double, real_end_sec double, error_time double, "
    "turn_type string, overlaps_with string, overlaps_kind string, interrupted boolean, interrupted_by string"
)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Corpus instances from JSON lines; a missing path is an error, a missing key NULL."""
    return spark.read.schema(CORPUS_SCHEMA).json(path)


def parse_turn_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Turn lines with their keys; ``is_bad`` marks unreadable ones, blank ones are dropped."""
    text = strip(F.col(column))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = lines.where(text != "").withColumn("_t", F.from_json(text, TURN_SCHEMA + ", _corrupt string", options))
    names = TURN_SCHEMA.split(", ")
    return parsed.select(
        *[c for c in lines.columns if c != column],
        *[F.col(f"_t.{n.split(' ')[0]}") for n in names],
        F.json_object_keys(text).alias("present_keys"),
        (F.col("_t").isNull() | F.col("_t._corrupt").isNotNull()).alias("is_bad"),
        F.when(F.col("_t").isNull() | F.col("_t._corrupt").isNotNull(), text).alias("bad_line"),
    )


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their 1-based number per file.

    A file may span many splits: lines are counted per split and earlier splits are
    carried over, so no file has to fit into one task.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_row"),
        "value",
    )
    return number_rows(lines, ["file"], ["_row"], ["_split"], "line_no").select("file", "line_no", "value")


def read_turn_lines(spark: SparkSession, path: str, *, strict: bool = True) -> DataFrame:
    """Turns from JSON lines; ``strict`` fails at a bad line and names file and line number."""
    turns = parse_turn_lines(numbered_lines(spark, path))
    if not strict:
        return turns
    message = F.concat(
        F.lit("Invalid JSON on line "), F.col("line_no").cast("string"), F.lit(" of "), F.col("file")
    )
    # a filter, because a column that nobody reads would be pruned with its error
    return turns.where(F.coalesce(F.when(F.col("is_bad"), F.raise_error(message).cast("boolean")), F.lit(True)))


def stored_turns(documents: DataFrame, column: str = "value") -> DataFrame:
    """``{"turns": [...]}`` documents to one row per turn, in order."""
    parsed = F.from_json(F.col(column), f"turns array<struct<{TURN_SCHEMA}>>")
    keep = [c for c in documents.columns if c != column]
    return documents.select(*keep, F.posexplode_outer(parsed["turns"]).alias("_p", "_t")).select(
        *keep, (F.col("_p") + 1).cast("bigint").alias("pos"), "_t.*"
    )


def read_conversations(spark: SparkSession, path: str) -> DataFrame:
    whole = spark.read.text(path, wholetext=True)
    return stored_turns(whole.select(F.input_file_name().alias("file"), "value"))

