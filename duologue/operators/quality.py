"""Deterministic quality rules over turn tables.

A rule is data: the columns it reads, a level, a target and a message.  Row rules
run in one pass over the turns, pair rules over one relation join, conversation
rules over one aggregation.  Every rule yields ``conv_id, turn_id, level,
message``; ``validate_turns`` is their union.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duologue.functions import fixed_values as fv
from duologue.functions.text import round_half_up
from duologue.operators.ordered import number_rows, running
from duologue.operators.sequences import edit_distance, moved_rows
from duologue.operators.turns import relation_pairs
from duologue.session import cut_lineage

ISSUE_COLUMNS = ["conv_id", "pos", "turn_id", "level", "rule", "message"]
CONVERSATION = "<conversation>"


def say(template: str, *values: Column) -> Column:
    """Message text; a missing value reads ``None``."""
    pieces = template.split("{}")
    cells: list[Column] = [F.lit(pieces[0])]
    for value, piece in zip(values, pieces[1:], strict=True):
        cells += [F.coalesce(value.cast("string"), F.lit("None")), F.lit(piece)]
    return F.concat(*cells)


def sec(value: Column, digits: int = 2) -> Column:
    """Seconds with a fixed number of decimals, the same text in every engine."""
    return round_half_up(value, digits).cast(f"decimal(18,{digits})").cast("string")


def _issue(level: str, rule: str, bad: Column, message: Column, target: Column | None = None) -> Column:
    return F.when(
        bad,
        F.struct(
            (target if target is not None else F.col("turn_id")).alias("turn_id"),
            F.lit(level).alias("level"),
            F.lit(rule).alias("rule"),
            message.alias("message"),
        ),
    )


def _explode(df: DataFrame, issues: list[Column]) -> DataFrame:
    return df.select("conv_id", "pos", F.explode(F.array_compact(F.array(*issues))).alias("_i")).select(
        "conv_id", "pos", "_i.*"
    )


# ---- row rules ---------------------------------------------------------------
def missing_fields(present: Column) -> Column:
    return F.array_sort(F.array_except(F.array(*[F.lit(f) for f in fv.TURN_FIELDS]), present))


def row_rules() -> Mapping[str, list[Column]]:
    """Rules that read one turn, by rule name."""
    c = F.col
    start, end = c("planned_start_sec"), c("planned_end_sec")
    by = F.coalesce(c("interrupted_by"), F.lit("")) != ""
    cut = F.coalesce(c("interrupted"), F.lit(False))
    outside = lambda name, allowed: ~F.coalesce(c(name).isin(allowed), F.lit(False))
    return {
        "enum_values": [
            _issue("ERROR", "enum_values", outside("speaker", fv.SPEAKERS), say("Invalid speaker '{}'.", c("speaker"))),
            _issue("ERROR", "enum_values", outside("emotion", fv.EMOTIONS), say("Invalid emotion '{}'.", c("emotion"))),
            _issue("ERROR", "enum_values", outside("turn_type", fv.TURN_TYPES), say("Invalid turn_type '{}'.", c("turn_type"))),
            _issue(
                "ERROR",
                "enum_values",
                c("overlaps_kind").isNotNull() & outside("overlaps_kind", fv.RELATION_KINDS),
                say("Invalid overlaps_kind '{}'.", c("overlaps_kind")),
            ),
        ],
        "planned_times": [
            _issue("ERROR", "planned_times", start.isNull() | end.isNull(), F.lit("Planned times must not be null.")),
            _issue("ERROR", "planned_times", end <= start, say("Planned end {} must be after start {}.", sec(end), sec(start))),
        ],
        "overlap_both_or_none": [
            _issue(
                "ERROR",
                "overlap_both_or_none",
                c("overlaps_with").isNull() != c("overlaps_kind").isNull(),
                F.lit("overlaps_with and overlaps_kind must be set together."),
            )
        ],
        "interrupted_consistency": [
            _issue("ERROR", "interrupted_consistency", cut & ~by, F.lit("Interrupted, but no interrupter is named.")),
            _issue("ERROR", "interrupted_consistency", ~cut & by, F.lit("An interrupter is named, but interrupted is false.")),
        ],
    }


def _required() -> Column:
    missing = missing_fields(F.col("present_keys"))
    return _issue(
        "ERROR",
        "required_fields",
        F.size(missing) > 0,
        say("Missing fields: {}", F.array_join(missing, ", ")),
        F.coalesce(F.col("turn_id"), F.lit("<missing>")),
    )


def qa_required_fields(turns: DataFrame) -> DataFrame:
    """Absent keys; a key that is present with null is fine."""
    return _explode(turns, [_required()])


def well_formed(turns: DataFrame) -> DataFrame:
    """Turns with every key; the other row rules only read these."""
    return turns.where(F.size(missing_fields(F.col("present_keys"))) == 0)


def qa_duplicate_id(turns: DataFrame) -> DataFrame:
    """Every repeat of an id after its first turn.

    The first position per id is an aggregate with map-side combine, joined back on
    ``(conv_id, turn_id)``.
    """
    whole = well_formed(turns)
    tid = F.coalesce("turn_id", F.lit(""))
    first = whole.groupBy("conv_id", tid.alias("_tid")).agg(F.min("pos").alias("_first"), F.count("*").alias("_n"))
    repeats = first.where("_n > 1")
    joined = whole.withColumn("_tid", tid).join(repeats, ["conv_id", "_tid"])
    return _explode(
        joined, [_issue("ERROR", "duplicate_id", F.col("pos") > F.col("_first"), F.lit("Repeated turn_id."))]
    )


def qa_rows(turns: DataFrame, rules: list[str] | None = None, *, required: bool = False) -> DataFrame:
    """All (or some) one-turn rules in a single scan; ``required`` adds the absent keys.

    A turn that lacks keys only reports that.
    """
    table = row_rules()
    whole = F.size(missing_fields(F.col("present_keys"))) == 0
    picked = [F.when(whole, issue) for name in (rules or list(table)) for issue in table[name]]
    return _explode(turns, [_required(), *picked] if required else picked)


# ---- pair rules --------------------------------------------------------------
PAIR_COLUMNS = [
    "turn_id", "overlaps_with", "overlaps_kind", "interrupted", "interrupted_by",
    "planned_start_sec", "planned_end_sec", "real_start_sec", "real_end_sec",
]


def timed_pairs(turns: DataFrame, time_field: str = "planned") -> DataFrame:
    """Declared relations with the chosen time pair on both sides.

    ``a_*`` is the partner, ``b_*`` the turn that declared; ``first_*`` starts
    earlier (on a tie: the partner).
    """
    c = F.col
    pairs = relation_pairs(turns, PAIR_COLUMNS).select(
        "*",
        c(f"ref_{time_field}_start_sec").alias("a_s"),
        c(f"ref_{time_field}_end_sec").alias("a_e"),
        c(f"{time_field}_start_sec").alias("b_s"),
        c(f"{time_field}_end_sec").alias("b_e"),
    )
    early = c("a_s") <= c("b_s")
    pick = lambda yes, no: F.when(early, c(yes)).otherwise(c(no))
    cut = lambda p: F.coalesce(c(f"{p}interrupted"), F.lit(False))
    mine = cut("") & F.coalesce(c("interrupted_by") == c("overlaps_with"), F.lit(False))
    theirs = cut("ref_") & F.coalesce(c("ref_interrupted_by") == c("turn_id"), F.lit(False))
    timed = c("ref_found") & c("a_s").isNotNull() & c("a_e").isNotNull() & c("b_s").isNotNull() & c("b_e").isNotNull()
    return pairs.select(
        "*",
        timed.alias("timed"),
        pick("overlaps_with", "turn_id").alias("first_id"),
        pick("a_s", "b_s").alias("first_s"),
        pick("a_e", "b_e").alias("first_e"),
        pick("turn_id", "overlaps_with").alias("second_id"),
        pick("b_s", "a_s").alias("second_s"),
        pick("b_e", "a_e").alias("second_e"),
        F.when(early, cut("ref_")).otherwise(cut("")).alias("first_cut"),
        (cut("") | cut("ref_")).alias("either_cut"),
        F.when(mine, "b").when(theirs, "a").alias("victim"),
    )


def pair_rules(tolerance: float = fv.TOLERANCE_SEC) -> Mapping[str, list[Column]]:
    """Rules that read a relation and its partner, by rule name."""
    c, tol = F.col, F.lit(tolerance)
    found, timed = c("ref_found"), c("timed")
    kind = lambda k: timed & F.coalesce(c("overlaps_kind") == k, F.lit(False))
    spans = [c("second_id"), sec(c("second_s")), sec(c("second_e")), c("first_id"), sec(c("first_s")), sec(c("first_e"))]
    side = lambda field: F.when(c("victim") == "b", c(f"b_{field}")).otherwise(c(f"a_{field}"))
    other = lambda field: F.when(c("victim") == "b", c(f"a_{field}")).otherwise(c(f"b_{field}"))
    victim_id = F.when(c("victim") == "b", c("turn_id")).otherwise(c("overlaps_with"))
    cutter_id = F.when(c("victim") == "b", c("overlaps_with")).otherwise(c("turn_id"))
    cutter_cut = F.coalesce(F.when(c("victim") == "b", c("ref_interrupted")).otherwise(c("interrupted")), F.lit(False))
    marked = kind("Interruption") & c("victim").isNotNull()
    gap = c("second_s") - c("first_s")
    return {
        "unknown_reference": [
            _issue("ERROR", "unknown_reference", ~found, say("Relation points at unknown turn '{}'.", c("overlaps_with")))
        ],
        "asymmetric_overlap": [
            _issue(
                "ERROR",
                "asymmetric_overlap",
                found & ~c("ref_overlaps_with").eqNullSafe(c("turn_id")),
                say("'{}' points at '{}', which points at '{}'.", c("turn_id"), c("overlaps_with"), c("ref_overlaps_with")),
            )
        ],
        "kind_mismatch": [
            _issue(
                "ERROR",
                "kind_mismatch",
                found & ~c("ref_overlaps_kind").eqNullSafe(c("overlaps_kind")),
                say("Kinds differ from '{}': '{}' and '{}'.", c("overlaps_with"), c("overlaps_kind"), c("ref_overlaps_kind")),
            )
        ],
        "times_missing": [
            _issue(
                "WARNING",
                "times_missing",
                found & ~timed,
                say("Timing against '{}' cannot be checked: times are missing.", c("overlaps_with")),
            )
        ],
        "backchannel_nested": [
            _issue(
                "ERROR",
                "backchannel_nested",
                kind("Backchanneling")
                & ~((c("first_s") - tol <= c("second_s")) & (c("second_e") <= c("first_e") + tol)),
                say("Backchannel '{}' [{}, {}] is not inside host '{}' [{}, {}].", *spans),
            )
        ],
        "backchannel_host_interrupted": [
            _issue(
                "ERROR",
                "backchannel_host_interrupted",
                kind("Backchanneling") & c("first_cut"),
                F.lit("The host of a backchannel is marked interrupted."),
                c("first_id"),
            )
        ],
        "interruption_marking": [
            _issue(
                "ERROR",
                "interruption_marking",
                kind("Interruption") & c("victim").isNull(),
                F.lit("Neither side of the interruption is marked as interrupted by the other."),
            )
        ],
        "interruption_start": [
            _issue(
                "ERROR",
                "interruption_start",
                marked & ~((side("s") < other("s")) & (other("s") < side("e") + tol)),
                say("Start {} lies outside victim '{}' [{}, {}].", sec(other("s")), victim_id, sec(side("s")), sec(side("e"))),
                cutter_id,
            )
        ],
        "interruption_end": [
            _issue(
                "WARNING",
                "interruption_end",
                marked & ~(other("e") > side("e") - tol),
                say("End {} does not pass the victim's end {}.", sec(other("e")), sec(side("e"))),
                cutter_id,
            )
        ],
        "interrupter_interrupted": [
            _issue("ERROR", "interrupter_interrupted", marked & cutter_cut, F.lit("The interrupter is itself marked interrupted."), cutter_id)
        ],
        "collision_intersects": [
            _issue(
                "ERROR",
                "collision_intersects",
                kind("Overlapping") & ~((c("first_s") < c("second_s")) & (c("second_s") < c("first_e") + tol)),
                say("Overlap '{}' [{}, {}] does not meet '{}' [{}, {}].", *spans),
            )
        ],
        "collision_gap": [
            _issue(
                "WARNING",
                "collision_gap",
                kind("Overlapping") & (gap > F.lit(fv.COLLISION_GAP_SEC)),
                say("Overlap starts {} s apart.", sec(gap)),
            )
        ],
        "collision_interrupted": [
            _issue("WARNING", "collision_interrupted", kind("Overlapping") & c("either_cut"), F.lit("An overlapping turn is marked interrupted."))
        ],
    }


def qa_pairs(
    turns: DataFrame,
    rules: list[str] | None = None,
    *,
    time_field: str = "planned",
    tolerance: float = fv.TOLERANCE_SEC,
) -> DataFrame:
    """All (or some) relation rules over one join."""
    table = pair_rules(tolerance)
    picked = [issue for name in (rules or list(table)) for issue in table[name]]
    return _explode(timed_pairs(turns, time_field), picked)


# ---- conversation rules ------------------------------------------------------
def conversation_stats(turns: DataFrame, time_field: str = "planned") -> DataFrame:
    """Duration and turn-type counts in one aggregation with map-side combine."""
    counts = [F.count_if(F.col("turn_type") == kind).alias(kind) for kind in fv.TURN_TYPES]
    return turns.groupBy("conv_id").agg(
        (F.max(f"{time_field}_end_sec") - F.min(f"{time_field}_start_sec")).alias("duration_sec"),
        F.count("*").alias("n_turns"),
        *counts,
    )


def conversation_rules(
    low: float = fv.MIN_DURATION_SEC, high: float = fv.MAX_DURATION_SEC, minimum: int = fv.MIN_RELATION_COUNT
) -> Mapping[str, list[Column]]:
    duration = F.col("duration_sec")
    place = F.lit(CONVERSATION)
    counts = []
    for kind in fv.RELATION_KINDS:
        n = F.col(kind)
        counts.append(
            _issue("WARNING", "min_overlap_counts", n == 0, say(f"No {kind} turn; the minimum is {minimum}."), place)
        )
        counts.append(
            _issue(
                "WARNING",
                "min_overlap_counts",
                (n > 0) & (n < minimum),
                say(f"Only {{}} {kind} turn(s); the minimum is {minimum}.", n),
                place,
            )
        )
    return {
        "total_duration": [
            _issue(
                "ERROR",
                "total_duration",
                ~duration.between(F.lit(low), F.lit(high)),
                say(f"Duration {{}} s is outside {low:.0f}-{high:.0f} s.", sec(duration, 1)),
                place,
            )
        ],
        "min_overlap_counts": counts,
    }


def qa_conversations(
    turns: DataFrame,
    rules: list[str] | None = None,
    *,
    time_field: str = "planned",
    low: float = fv.MIN_DURATION_SEC,
    high: float = fv.MAX_DURATION_SEC,
    minimum: int = fv.MIN_RELATION_COUNT,
) -> DataFrame:
    table = conversation_rules(low, high, minimum)
    picked = [issue for name in (rules or list(table)) for issue in table[name]]
    stats = conversation_stats(turns, time_field).withColumn("pos", F.lit(0).cast("bigint"))
    return _explode(stats, picked)


# ---- unions and reports ------------------------------------------------------
def validate_turns(
    turns: DataFrame,
    *,
    time_field: str = "planned",
    tolerance: float = fv.TOLERANCE_SEC,
    low: float = fv.MIN_DURATION_SEC,
    high: float = fv.MAX_DURATION_SEC,
    minimum: int = fv.MIN_RELATION_COUNT,
) -> DataFrame:
    """Every rule over every turn, as one long issue table."""
    parts: list[DataFrame] = [
        qa_rows(turns, required=True),
        qa_duplicate_id(turns),
        qa_pairs(turns, time_field=time_field, tolerance=tolerance),
        qa_conversations(turns, time_field=time_field, low=low, high=high, minimum=minimum),
    ]
    issues = parts[0]
    for part in parts[1:]:
        issues = issues.unionByName(part)
    return issues.select(*ISSUE_COLUMNS)


def validation_report(conversations: DataFrame, turns: DataFrame, issues: DataFrame) -> DataFrame:
    """Counts per conversation; one without turns carries a single error."""
    counted = issues.groupBy("conv_id").agg(
        F.count_if(F.col("level") == "ERROR").alias("_errors"),
        F.count_if(F.col("level") == "WARNING").alias("_warnings"),
    )
    sized = turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"))
    zero = F.lit(0).cast("bigint")
    joined = conversations.select("conv_id").distinct().join(sized, "conv_id", "left").join(counted, "conv_id", "left")
    empty = F.coalesce("n_turns", zero) == 0
    errors = F.when(empty, F.lit(1).cast("bigint")).otherwise(F.coalesce("_errors", zero))
    return joined.select(
        "conv_id",
        F.coalesce("n_turns", zero).alias("n_turns"),
        errors.alias("n_errors"),
        F.coalesce("_warnings", zero).alias("n_warnings"),
        (errors > 0).alias("has_errors"),
    )


def ordered_issues(issues: DataFrame) -> DataFrame:
    """Errors before warnings, then by position; the rank is per conversation.

    A conversation with very many issues is split by level and position.
    """
    ranked = issues.withColumn("level_rank", F.when(F.col("level") == "ERROR", 0).otherwise(1))
    return number_rows(ranked, ["conv_id"], ["level_rank", "pos", "turn_id", "rule", "message"], name="issue_no")


def turn_type_counts(turns: DataFrame) -> DataFrame:
    """Per conversation: each known type (zeros included) and its share in percent."""
    stats = conversation_stats(turns)
    total = sum((F.col(k) for k in fv.TURN_TYPES[1:]), F.col(fv.TURN_TYPES[0]))
    cells = F.array(*[F.struct(F.lit(k).alias("turn_type"), F.col(k).alias("n")) for k in fv.TURN_TYPES])
    return stats.select("conv_id", total.alias("_total"), F.explode(cells).alias("_c")).select(
        "conv_id",
        "_c.turn_type",
        "_c.n",
        round_half_up(F.col("_c.n") * F.lit(100.0) / F.greatest("_total", F.lit(1)), 1).alias("share_pct"),
    )


def turn_type_tally(turns: DataFrame) -> DataFrame:
    """Counts by type as found; a missing type counts as ``Unknown``."""
    kind = F.coalesce(F.nullif(F.col("turn_type"), F.lit("")), F.lit("Unknown"))
    return turns.groupBy("conv_id", kind.alias("turn_type")).agg(F.count("*").alias("n"))


def conversation_duration(turns: DataFrame, time_field: str = "planned") -> DataFrame:
    return conversation_stats(turns, time_field).select("conv_id", "duration_sec")


# ---- transcript rules --------------------------------------------------------
def transcript_minimums(
    lines: DataFrame, *, interrupts: int = 2, overlaps: int = 2, backchannels: int = 8, repeats: int = 2
) -> DataFrame:
    """Turn-taking minimums on parsed transcript lines ``(conv_id, pos, turn_type, text, ...)``.

    A relation refers to the previous line that is not a backchannel; an overlap
    needs that line to be Normal and no line may carry two relations.
    """
    c = F.col
    base = lines.groupBy("conv_id").agg(
        *[F.count_if(c("turn_type") == k).alias(k) for k in fv.RELATION_KINDS]
    )
    low = lambda kind, n: F.when(
        c(kind) < n, F.struct(F.lit(f"min_{kind}").alias("rule"), c(kind).alias("n"))
    )
    minimums = base.select(
        "conv_id",
        F.explode(
            F.array_compact(
                F.array(low("Interruption", interrupts), low("Overlapping", overlaps), low("Backchanneling", backchannels))
            )
        ).alias("_r"),
    ).select("conv_id", "_r.rule", F.lit("").alias("subject"), "_r.n")
    repeated = (
        lines.where(c("turn_type") == "Backchanneling")
        .groupBy("conv_id", F.lower("text").alias("subject"))
        .agg(F.count("*").alias("n"))
        .where(c("n") > repeats)
        .select("conv_id", F.lit("repeated_backchannel").alias("rule"), "subject", "n")
    )
    hosted = with_host(lines)
    relational = hosted.where(c("turn_type").isin(fv.RELATION_KINDS) & c("host_pos").isNotNull())
    one = F.lit(1).cast("bigint")
    chained = relational.where((c("turn_type") == "Overlapping") & (c("host_type") != "Normal")).select(
        "conv_id", F.lit("overlap_target").alias("rule"), c("pos").cast("string").alias("subject"), one.alias("n")
    )
    ends = relational.select("conv_id", F.explode(F.array("pos", "host_pos")).alias("_end"))
    shared = ends.groupBy("conv_id", "_end").agg(F.count("*").alias("n")).where("n > 1").select(
        "conv_id", F.lit("several_relations").alias("rule"), c("_end").cast("string").alias("subject"), "n"
    )
    return minimums.unionByName(repeated).unionByName(chained).unionByName(shared)


def with_host(lines: DataFrame, block_rows: int = 4096) -> DataFrame:
    """The nearest earlier line that holds the floor: its position and type."""
    holder = F.when(F.col("turn_type") != "Backchanneling", F.struct("pos", F.col("turn_type").alias("type")))
    blocked = lines.withColumn("_blk", F.floor(F.col("pos") / block_rows))
    found = running(blocked, ["conv_id"], ["pos"], ["_blk"], {"_host": ("max", holder)}, inclusive=False)
    return found.select(
        *lines.columns, F.col("_host.pos").alias("host_pos"), F.col("_host.type").alias("host_type")
    )


# ---- faithfulness ------------------------------------------------------------
def comparable(text: Column) -> Column:
    """Letters and digits only, lower case: wording without marks and blanks."""
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}\p{M}]+", ""))


def faithfulness(lines: DataFrame, turns: DataFrame, block_rows: int = 4096) -> DataFrame:
    """Differences between transcript lines and turns ``(conv_id, pos, speaker, text)``.

    The n-th line of a wording belongs to the n-th turn of that wording, wherever it is:
    ``speaker_swapped`` if the other speaker says it, ``reordered`` if it is off the longest
    run of lines whose turns ascend (``sequences.moved_rows`` tells which, of several).  What
    is left between the same two kept lines is paired in order: ``reworded``, with the exact
    edit distance; without a partner a line is ``dropped``, a turn ``added``.
    """
    c = F.col
    block = lambda name: F.floor(c(name) / block_rows).alias("_blk")

    def counted(rows: DataFrame, side: str) -> DataFrame:
        plain = rows.select("conv_id", c("pos").alias(side), c("speaker").alias(f"{side}_speaker"), comparable(c("text")).alias("words"))
        return number_rows(plain.select("*", block(side)), ["conv_id", "words"], [side], ["_blk"], "_nth").drop("_blk")

    left, right = counted(lines, "line"), counted(turns, "turn")
    # stored, as all that follows reads it several times
    both = cut_lineage(left.join(right, ["conv_id", "words", "_nth"], "full_outer"))
    pairs = both.where("line is not null and turn is not null")

    moved = moved_rows(pairs.select("conv_id", "line", "turn"), "conv_id", "line", "turn").withColumn("moved", F.lit(True))
    placed = cut_lineage(pairs.select("conv_id", "line", "turn").join(moved, ["conv_id", "line"], "left").withColumn("moved", F.coalesce("moved", F.lit(False))))
    speakers = pairs.select("conv_id", "line", (c("line_speaker") != c("turn_speaker")).alias("swapped"))
    problem = F.when(c("moved"), "reordered").when(c("swapped"), "speaker_swapped")
    matched = placed.join(speakers, ["conv_id", "line"]).select("conv_id", c("line").alias("pos"), problem.alias("problem"), F.lit(None).cast("int").alias("edit_distance"))

    # Leftovers, numbered since the last line or turn that kept its place.
    kept = placed.where("not moved").select("conv_id", c("line").alias("_line"), c("turn").alias("_turn"))

    def leftovers(side: str) -> DataFrame:
        other = "turn" if side == "line" else "line"
        alone = both.where(c(side).isNotNull() & c(other).isNull()).select("conv_id", c(side).alias("pos"), "words", F.lit(None).cast("bigint").alias("mark"))
        marks = kept.select("conv_id", c(f"_{side}").alias("pos"), F.lit(None).cast("string").alias("words"), c("_turn").alias("mark"))
        mixed = alone.unionByName(marks).select("*", block("pos"))
        since = running(mixed, ["conv_id"], ["pos"], ["_blk"], {"gap": ("max", c("mark"))}, inclusive=False)
        rest = since.where("mark is null").select("conv_id", "pos", "words", F.coalesce("gap", F.lit(-1)).alias("gap"), "_blk")
        return number_rows(rest, ["conv_id", "gap"], ["pos"], ["_blk"], "nth").drop("_blk")

    lost, new = leftovers("line"), leftovers("turn").withColumnsRenamed({"pos": "turn_pos", "words": "turn_words"})
    rest = lost.join(new, ["conv_id", "gap", "nth"], "full_outer")
    kind = F.when(c("turn_pos").isNull(), "dropped").when(c("pos").isNull(), "added").otherwise("reworded")
    unmatched = rest.select(
        "conv_id",
        F.coalesce("pos", "turn_pos").alias("pos"),
        kind.alias("problem"),
        F.when(c("words").isNotNull() & c("turn_words").isNotNull(), edit_distance(c("words"), c("turn_words"))).alias("edit_distance"),
    )
    return matched.where("problem is not null").unionByName(unmatched)
