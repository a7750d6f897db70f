"""Request texts: one prompt per row, from optional sections in a fixed order.

The wording here is our own and short; what matters is which sections appear,
in which order, and which values they carry.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duologue.functions import dialogue as dx
from duologue.operators import planning


def compile_template(template: Column, values: Mapping[str, Column]) -> Column:
    """Fill ``{{ name }}`` marks, with or without inner blanks."""
    text = template
    for name, value in values.items():
        literal = F.replace(F.replace(value.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
        text = F.regexp_replace(text, F.lit(r"\{\{\s*" + name + r"\s*\}\}"), literal)
    return text


def given(label: str, value: Column) -> Column:
    """``label: value``, nothing when the value is missing or empty."""
    return F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{label}: "), value))


def block(title: str, body: Column) -> Column:
    return F.when(F.coalesce(body, F.lit("")) != "", F.concat(F.lit(f"\n## {title}\n"), body))


def profile_lines() -> list[Column]:
    return [
        given("speaker_1 emotion", F.col("agent_emotion")),
        given("speaker_2 emotion", F.col("user_emotion")),
        given("speaker_1 accent", F.col("agent_accent")),
        given("speaker_2 accent", F.col("user_accent")),
        given("genders", F.col("gender_pair")),
    ]


def optional(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def topic_prompt(df: DataFrame) -> Column:
    numbers = F.when(F.col("include_numbers"), "Concrete numbers should come up.").otherwise("Keep it qualitative.")
    return F.concat_ws(
        "\n",
        F.lit("Propose one conversation topic."),
        given("language", F.col("language")),
        given("area", optional(df, "domain")),
        numbers,
        *profile_lines(),
        block("Used topics", optional(df, "history")),
        F.lit('Reply with one JSON object: "title", "context".'),
    )


def accent_block() -> Column:
    line = lambda who, accent: F.when(
        planning.accent_marker(F.col(accent), F.col("language")).isNotNull(),
        F.concat(F.lit(f"- {who} ("), F.col(accent), F.lit("): "), planning.accent_marker(F.col(accent), F.col("language"))),
    )
    return F.concat_ws("\n", line("speaker_1", "agent_accent"), line("speaker_2", "user_accent"))


def generator_prompt(df: DataFrame) -> Column:
    words, turns = planning.pacing(F.col("target_sec"))
    pace = F.when(
        F.col("target_sec").isNotNull(),
        F.concat_ws(" ", F.floor(F.col("target_sec") + 0.5).cast("string"), F.lit("seconds,"), turns.cast("string"), F.lit("turns,"), words.cast("string"), F.lit("words")),
    )
    previous, feedback = optional(df, "previous"), optional(df, "feedback")
    both = (F.coalesce(previous, F.lit("")) != "") & (F.coalesce(feedback, F.lit("")) != "")
    return F.concat_ws(
        "\n",
        F.lit("Write a two-speaker conversation in the tagged line format."),
        given("title", F.col("title")),
        given("context", F.col("context")),
        given("language", F.col("language")),
        block("Language", planning.language_directive(F.col("language"))),
        given("type", optional(df, "conversation_type")),
        *profile_lines(),
        block("Accents", accent_block()),
        block("Target length", pace),
        F.when(F.col("include_numbers"), "Use concrete numbers.").otherwise("Keep it qualitative."),
        block("Feedback to fix", F.when(both, feedback)),
        block("Previous transcript", F.when(both, previous)),
        F.lit("Reply with transcript lines only."),
    )


def content_judge_prompt(df: DataFrame) -> Column:
    return F.concat_ws(
        "\n",
        F.lit("Judge the transcript against the required attributes."),
        given("language", F.col("language")),
        given("type", optional(df, "conversation_type")),
        *profile_lines(),
        given("title", F.col("title")),
        given("context", F.col("context")),
        block("Transcript", F.col("transcript")),
        F.lit("Reply with one JSON object."),
    )


def format_judge_prompt(df: DataFrame) -> Column:
    return F.concat_ws(
        "\n",
        F.lit("Check that the turns are a faithful conversion of the transcript."),
        block("Transcript", F.col("transcript")),
        block("Turns", F.col("turns_json")),
        F.lit("Reply with one JSON object."),
    )


def editor_prompt(df: DataFrame) -> Column:
    genders = dx.speaker_genders(F.col("gender_pair"))
    return F.concat_ws(
        "\n",
        F.lit("Fix the listed issues by editing only the affected turns."),
        given("language", F.col("language")),
        given("speaker_1 gender", genders["speaker_1"]),
        given("speaker_2 gender", genders["speaker_2"]),
        *profile_lines()[:4],
        block("Transcript", optional(df, "transcript")),
        block("Issues", F.col("issues_text")),
        block("Feedback", optional(df, "feedback")),
        block("Turns", F.col("turns_json")),
        F.lit("Reply with one JSON edit patch."),
    )


PROMPTS = {
    "topic": topic_prompt,
    "generator": generator_prompt,
    "content_judge": content_judge_prompt,
    "format_judge": format_judge_prompt,
    "editor": editor_prompt,
}


def prompt_table(df: DataFrame, kind: str, key: str) -> DataFrame:
    """One request text per row of ``df``."""
    return df.select(F.col(key), F.lit(kind).alias("kind"), PROMPTS[kind](df).alias("prompt"))


# What a judge must not see, and what an editor sees.
JUDGE_HIDDEN = [
    "planned_start_sec", "planned_end_sec", "real_start_sec", "real_end_sec", "error_time",
    "overlaps_with", "overlaps_kind", "interrupted", "interrupted_by", "join_ratio",
]
EDITOR_FIELDS = ["turn_id", "speaker", "turn_type", "emotion", "text", "overlaps_with"]


def judge_view(turns: DataFrame) -> DataFrame:
    """Turns without timing and relation fields."""
    return turns.drop(*JUDGE_HIDDEN)


def editor_view(turns: DataFrame, keys: tuple[str, ...] = ("conv_id", "pos")) -> DataFrame:
    """Only the fields an edit may touch."""
    return turns.select(*keys, *EDITOR_FIELDS)


def turn_documents(turns: DataFrame, fields: list[str]) -> DataFrame:
    """The turns of each conversation as one JSON array; a conversation must fit into a row."""
    turn = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return (
        turns.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("pos", turn.alias("turn")))).alias("_t"))
        .select(
            "conv_id",
            F.concat(F.lit("["), F.array_join(F.transform("_t", lambda t: t["turn"]), ","), F.lit("]")).alias("turns_json"),
        )
    )
