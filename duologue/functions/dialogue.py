"""Expressions over transcript lines and turns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from duologue.functions import fixed_values as fv
from duologue.functions.text import blank_to_null, capitalize, lookup, strip, word_count

# Fixed value: one tagged line, "S<n>: [<tag>] -> S<ref>@<ratio> <text> (<Emotion>)".
TAGGED_LINE = (
    r"^[sS] ?([12]) ?: ?(?:\[([A-Za-z-]+)\])? ?(?:-> ?[sS]([12])(?:@([0-9.]+))?)? ?"
    r"(.*?) ?(?:\((Neutral|Happy|Sad|Angry)\))?$"
)
# Fixed value: the head of a line that carries a turn.
SPEAKER_HEAD = r"^(s1:|s2:)"

# Times are laid out in whole ticks, so that sums do not depend on their order:
# 7800 ticks are 0.01 s, and every duration of the speech-rate model is exact.
TICKS_PER_CS = 7800
TICKS_PER_SEC = TICKS_PER_CS * 100


def keeps_line(line: Column) -> Column:
    """Is this (stripped) line a turn, and not a fence, a blank or stray prose?"""
    head = F.lower(F.translate(F.substring(line, 1, 4), " ", ""))
    return (line != "") & ~F.startswith(line, F.lit("```")) & head.rlike(SPEAKER_HEAD)


def clean_transcript(text: Column) -> Column:
    """Turn lines only, NULL when none is left."""
    lines = F.transform(F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]", -1), strip)
    return F.nullif(F.array_join(F.filter(lines, keeps_line), "\n"), F.lit(""))


def parse_line(line: Column) -> Column:
    """A tagged line as ``speaker, turn_type, ref_speaker, ratio, emotion, text``."""
    part = lambda group: F.nullif(F.regexp_extract(line, TAGGED_LINE, group), F.lit(""))
    text = F.coalesce(part(5), F.lit(""))
    tagged = lookup(fv.TURN_TYPE_ALIASES, F.lower(part(2)))
    sound = F.lower(F.regexp_replace(text, r"[^\p{L} ]", "")).isin(fv.LISTENER_SOUNDS)
    dashed = F.startswith(text, F.lit("—")) & F.coalesce(tagged == "Normal", F.lit(True))
    return F.struct(
        F.concat(F.lit("speaker_"), part(1)).alias("speaker"),
        F.when(dashed, "Interruption")
        .when(part(2).isNull() & sound, "Backchanneling")
        .otherwise(F.coalesce(tagged, F.lit("Normal")))
        .alias("turn_type"),
        F.concat(F.lit("speaker_"), part(3)).alias("ref_speaker"),
        clamp_ratio(part(4)).alias("ratio"),
        F.coalesce(part(6), F.lit("Neutral")).alias("emotion"),
        text.alias("text"),
    )


def clamp_ratio(value: Column) -> Column:
    """A number within 0..1; anything unreadable is NULL."""
    number = strip(value.cast("string")).try_cast("double")
    return F.when(number.isNotNull(), F.least(F.greatest(number, F.lit(0.0)), F.lit(1.0)))


def item_text(item: Column, key: str) -> Column:
    """Text of a reply field: absent -> '', present but null -> 'None'."""
    return strip(
        F.when(F.map_contains_key(item, key), F.coalesce(F.try_element_at(item, F.lit(key)), F.lit("None")))
        .otherwise(F.lit(""))
    )


def speaker_name(value: Column) -> Column:
    """speaker_1 / speaker_2 from loose forms such as ``S1`` or ``2``; else NULL."""
    name = F.lower(strip(value))
    digits = F.regexp_replace(name, "[^0-9]", "")
    return F.when(name.isin(fv.SPEAKERS), name).when(
        digits.isin("1", "2"), F.concat(F.lit("speaker_"), digits)
    )


def turn_type_name(value: Column) -> Column:
    """Schema turn type of a loose name, NULL when it is not known."""
    return lookup(fv.TURN_TYPE_ALIASES, F.lower(strip(value)))


def emotion_name(value: Column) -> Column:
    """Schema emotion of a loose name, NULL when it is not one."""
    name = capitalize(strip(value))
    return F.when(name.isin(fv.EMOTIONS), name)


def emotion_or_default(emotion: Column, speaker: Column, agent: Column, user: Column) -> Column:
    """The turn's emotion, else the speaker's default, else Neutral."""
    default = F.when(speaker == "speaker_1", emotion_name(agent)).when(speaker == "speaker_2", emotion_name(user))
    return F.coalesce(emotion, default, F.lit("Neutral"))


def speech_ticks(text: Column, emotion: Column) -> Column:
    """Spoken length in ticks: mean of the word-rate and character-rate estimates."""
    by_word, by_char = {}, {}
    for name in fv.EMOTIONS:
        by_word[name] = round(TICKS_PER_SEC / (2 * fv.WORDS_PER_SEC[name]))
        by_char[name] = round(TICKS_PER_SEC / (2 * fv.CHARS_PER_SEC[name]))
    known = F.when(emotion.isin(fv.EMOTIONS), emotion).otherwise("Neutral")
    words = F.greatest(word_count(text), F.lit(1)).cast("bigint")
    chars = F.greatest(F.length(text), F.lit(1)).cast("bigint")
    return F.greatest(
        words * lookup(by_word, known, "bigint") + chars * lookup(by_char, known, "bigint"),
        F.lit(round(fv.MIN_TURN_SEC * TICKS_PER_SEC)).cast("bigint"),
    )


def ticks_to_cs(ticks: Column) -> Column:
    """Nearest hundredth of a second, halves up."""
    return F.floor((ticks + F.lit(TICKS_PER_CS // 2)) / F.lit(TICKS_PER_CS)).cast("bigint")


def speaker_genders(pair: Column) -> Column:
    """``F-M`` or ``FM`` as the gender words of speaker_1 and speaker_2."""
    letters = F.regexp_extract_all(F.lower(pair), F.lit("([mf])"), F.lit(1))
    word = lambda n: lookup({"m": "Male", "f": "Female"}, F.try_element_at(letters, F.lit(n)))
    return F.struct(word(1).alias("speaker_1"), word(2).alias("speaker_2"))


def timing_error(planned_start: Column, planned_end: Column, real_start: Column, real_end: Column) -> Column:
    """Planned minus real duration, NULL until the turn is aligned."""
    return (planned_end - planned_start) - (real_end - real_start)


__all__ = [name for name in globals() if not name.startswith("_")] + ["blank_to_null"]
