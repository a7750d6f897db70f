"""Turn tables: parsing, normalisation, edits and relation look-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duologue.functions import dialogue as dx
from duologue.functions import fixed_values as fv
from duologue.functions.text import last_wins, round_half_up, strip
from duologue.operators.ordered import BLOCK_ROWS, block_of, number_rows


def parse_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """Tagged lines to turn fields."""
    return lines.withColumn("_turn", dx.parse_line(F.col(column))).select(
        *[c for c in lines.columns if c != column], "_turn.*"
    )


def reference_speakers(items: DataFrame, keys: Sequence[str] = ("conv_id",)) -> DataFrame:
    """``turn_id -> speaker`` of well-named speakers; the last item of an id counts."""
    named = items.select(
        *keys,
        "pos",
        F.try_element_at("item", F.lit("turn_id")).alias("turn_id"),
        F.lower(dx.item_text(F.col("item"), "speaker")).alias("speaker"),
    ).where(F.col("turn_id").isNotNull() & F.col("speaker").isin(fv.SPEAKERS))
    return named.groupBy(*keys, "turn_id").agg(F.max_by("speaker", "pos").alias("speaker"))


def lower_keys(items: DataFrame) -> DataFrame:
    """Case-insensitive reply fields: the last of two spellings wins."""
    lowered = F.transform(
        F.map_entries("item"), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))
    )
    return items.withColumn("item", last_wins(lowered))


def normalise_items(items: DataFrame, keys: Sequence[str] = ("conv_id",)) -> DataFrame:
    """Reply items ``(keys, pos, item map)`` to the fields a layout trusts.

    Items without text are dropped.  ``ref_speaker`` is the named one or the
    speaker of the turn that ``overlaps_with`` points at.
    """
    low = lower_keys(items)
    refs = reference_speakers(low, keys).select(
        *keys, F.col("turn_id").alias("_ref_id"), F.col("speaker").alias("_ref_speaker")
    )
    item = F.col("item")
    wide = low.select(
        *keys,
        "pos",
        dx.item_text(item, "text").alias("text"),
        F.coalesce(dx.speaker_name(dx.item_text(item, "speaker")), F.lit("speaker_1")).alias("speaker"),
        F.coalesce(dx.turn_type_name(dx.item_text(item, "turn_type")), F.lit("Normal")).alias("turn_type"),
        dx.emotion_name(dx.item_text(item, "emotion")).alias("emotion"),
        dx.clamp_ratio(
            F.when(F.map_contains_key("item", "join_ratio"), F.try_element_at(item, F.lit("join_ratio")))
            .otherwise(F.try_element_at(item, F.lit("ratio")))
        ).alias("ratio"),
        F.try_element_at(item, F.lit("ref_speaker")).alias("_named"),
        F.try_element_at(item, F.lit("overlaps_with")).alias("_ref_id"),
    ).where(F.col("text") != "")
    return wide.join(refs, [*keys, "_ref_id"], "left").select(
        *keys,
        "pos",
        "speaker",
        "turn_type",
        dx.speaker_name(F.coalesce("_named", "_ref_speaker")).alias("ref_speaker"),
        "ratio",
        "emotion",
        "text",
    )


def usable_conversations(items: DataFrame, turns: DataFrame, keys: Sequence[str] = ("conv_id",)) -> DataFrame:
    """Usable turns per conversation; zero is an error of the reply."""
    kept = turns.groupBy(*keys).agg(F.count("*").alias("n_usable"))
    n = F.coalesce("n_usable", F.lit(0).cast("bigint"))
    return items.select(*keys).distinct().join(kept, list(keys), "left").select(
        *keys, n.alias("n_usable"), (n == 0).alias("is_error")
    )


def with_default_emotion(turns: DataFrame, profiles: DataFrame, keys: Sequence[str] = ("conv_id",)) -> DataFrame:
    """Fill missing emotions from the speaker's profile."""
    joined = turns.join(profiles.select(*keys, "agent_emotion", "user_emotion"), list(keys), "left")
    return joined.withColumn(
        "emotion",
        dx.emotion_or_default(F.col("emotion"), F.col("speaker"), F.col("agent_emotion"), F.col("user_emotion")),
    ).drop("agent_emotion", "user_emotion")


def renumber(
    turns: DataFrame, keys: Sequence[str] = ("conv_id",), order: str = "pos", size: int = BLOCK_ROWS
) -> DataFrame:
    """Dense positions and ids ``t1..tN`` in the order of ``order`` (non-negative)."""
    blocked = turns.withColumnRenamed(order, "_order").withColumn("_blk", block_of(F.col("_order"), size))
    dense = number_rows(blocked, keys, ["_order"], ["_blk"], "pos")
    return dense.withColumn("turn_id", F.concat(F.lit("t"), F.col("pos").cast("string"))).drop("_order", "_blk")


def last_of_each_id(turns: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("conv_id",)) -> DataFrame:
    """One row per turn id; a repeated id means its last turn."""
    picked = turns.groupBy(*keys, "turn_id").agg(F.max_by(F.struct("pos", *columns), "pos").alias("_last"))
    return picked.select(*keys, "turn_id", F.col("_last.pos").alias("pos"), *[F.col(f"_last.{c}").alias(c) for c in columns])


def relation_pairs(turns: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("conv_id",)) -> DataFrame:
    """Each declared relation once: the first turn to name it, next to its partner.

    The partner's columns are prefixed ``ref_``; they are NULL when the named
    turn does not exist (``ref_found`` is false).
    """
    pointing = turns.where(F.col("overlaps_with").isNotNull() & (F.col("overlaps_with") != ""))
    tid, ref = F.coalesce("turn_id", F.lit("")), F.col("overlaps_with")
    kept = [c for c in columns if c not in ("turn_id", "overlaps_with")]
    first = (
        pointing.groupBy(*keys, F.least(tid, ref).alias("_a"), F.greatest(tid, ref).alias("_b"))
        .agg(F.min_by(F.struct("pos", "turn_id", "overlaps_with", *kept), "pos").alias("_first"))
        .select(*keys, "_first.*")
    )
    partner_columns = [c for c in columns if c != "turn_id"]
    partners = last_of_each_id(turns.where(F.col("turn_id").isNotNull()), partner_columns, keys).select(
        *keys,
        F.col("turn_id").alias("ref_id"),
        F.col("pos").alias("ref_pos"),
        *[F.col(c).alias(f"ref_{c}") for c in partner_columns],
    )
    on = [first[k] == partners[k] for k in keys] + [first["overlaps_with"] == partners["ref_id"]]
    joined = first.join(partners, on, "left")
    return joined.select(
        *[first[c] for c in first.columns],
        *[partners[c] for c in partners.columns if c not in [*keys, "ref_id"]],
        partners["ref_id"].isNotNull().alias("ref_found"),
    )


def recover_ratio(turns: DataFrame, keys: Sequence[str] = ("conv_id",)) -> DataFrame:
    """Where inside its partner a laid-out turn began, as a share of the partner's span."""
    partners = last_of_each_id(turns, ["speaker", "planned_start_sec", "planned_end_sec"], keys).select(
        *keys,
        F.col("turn_id").alias("overlaps_with"),
        F.col("speaker").alias("_speaker"),
        F.col("planned_start_sec").alias("_s"),
        F.col("planned_end_sec").alias("_e"),
    )
    share = (F.col("planned_start_sec") - F.col("_s")) / F.nullif(F.col("_e") - F.col("_s"), F.lit(0.0))
    usable = F.col("turn_type").isin("Overlapping", "Backchanneling") & (F.col("_e") > F.col("_s"))
    return (
        turns.join(partners, [*keys, "overlaps_with"], "left")
        .withColumn("ratio", F.when(usable, F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))))
        .withColumn("ref_speaker", F.when(F.col("turn_type").isin(fv.RELATION_KINDS), F.col("_speaker")))
        .drop("_speaker", "_s", "_e")
    )


def apply_edits(turns: DataFrame, edits: DataFrame, keys: Sequence[str] = ("conv_id",)) -> DataFrame:
    """Merge ordered edits into turns; the last usable value of each field wins.

    A delete is final, unknown ids are ignored, blank texts and unknown emotions
    or types leave the field as it was.  Rows come back without the deleted turns.
    """
    text = F.nullif(strip(F.col("text").cast("string")), F.lit(""))
    deleting = F.lower(strip(F.coalesce("action", F.lit("replace")))) == "delete"
    field = lambda value: F.when(~deleting, value)
    last = lambda value: F.max_by(value, F.when(value.isNotNull(), F.col("edit_no")))
    merged = edits.groupBy(*keys, F.trim(F.col("turn_id")).alias("turn_id")).agg(
        F.bool_or(deleting).alias("_deleted"),
        last(field(text)).alias("_text"),
        last(field(dx.emotion_name(F.col("emotion")))).alias("_emotion"),
        last(field(dx.turn_type_name(F.col("turn_type")))).alias("_type"),
    )
    joined = turns.join(merged, [*keys, "turn_id"], "left").where(~F.coalesce("_deleted", F.lit(False)))
    return joined.select(
        *[
            F.coalesce({"text": "_text", "emotion": "_emotion", "turn_type": "_type"}[c], c).alias(c)
            if c in ("text", "emotion", "turn_type")
            else F.col(c)
            for c in turns.columns
        ]
    )


def emptied_conversations(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("conv_id",)) -> DataFrame:
    """Conversations whose edits would remove every turn; such a patch is refused."""
    return before.select(*keys).distinct().join(after.select(*keys), list(keys), "left_anti")


def scale_to_target(turns: DataFrame, targets: DataFrame, keys: Sequence[str] = ("conv_id",)) -> DataFrame:
    """Stretch or shrink planned times so that the conversation lasts its target.

    The target is held within 240..480 s.  Bounds come from one aggregation per
    conversation that is joined back, so no conversation gathers in one task.
    """
    bounds = turns.groupBy(*keys).agg(
        F.min("planned_start_sec").alias("_t0"), F.max("planned_end_sec").alias("_t1")
    )
    target = F.least(F.greatest(F.col("target_sec"), F.lit(fv.MIN_DURATION_SEC)), F.lit(fv.MAX_DURATION_SEC))
    usable = (F.col("target_sec") > 0) & (F.col("_t1") > F.col("_t0"))
    plan = bounds.join(targets.select(*keys, "target_sec"), list(keys), "left").select(
        *keys, "_t0", F.when(usable, target / F.nullif(F.col("_t1") - F.col("_t0"), F.lit(0.0))).alias("_scale")
    )
    moved = lambda c: F.when(
        F.col("_scale").isNotNull(), round_half_up((F.col(c) - F.col("_t0")) * F.col("_scale") + F.col("_t0"), 2)
    ).otherwise(F.col(c))
    return (
        turns.join(plan, list(keys), "left")
        .withColumn("planned_start_sec", moved("planned_start_sec"))
        .withColumn("planned_end_sec", moved("planned_end_sec"))
        .drop("_t0", "_scale")
    )
