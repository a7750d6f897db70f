"""Timeline layout of a conversation, without walking it turn by turn.

A relational turn (overlap, interruption, backchannel) binds to the turn that
holds the floor, if that is the other speaker's and still free; otherwise it
becomes Normal.  Two facts make this a set of prefix operations:

* A turn links exactly when it names a relation, the previous turn is by the other
  speaker, and the previous turn did not link.  Inside a run of such candidates,
  every second one links: the parity of the distance to the last non-candidate.
* An unlinked turn and the turn linked to it form a group.  After an overlap or
  an interruption the floor lies at a fixed distance from the *rounded* start of
  the group's first turn, except for one bit: whether rounding made the first
  turn's span one hundredth longer.  Each such group therefore maps one bit to
  one bit and a whole number of hundredths, and such maps compose.

All sums are whole ticks (see ``functions.dialogue``), so no result depends on
how the rows were cut.  Every step windows over ``(conversation, block)`` and
passes one row per block onwards, so a conversation of any length spreads over
the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duologue.functions import fixed_values as fv
from duologue.functions.dialogue import TICKS_PER_CS, speech_ticks, ticks_to_cs
from duologue.operators.ordered import BLOCK_ROWS, block_window, carry_over, with_halo
from duologue.operators.turns import apply_edits, emptied_conversations, recover_ratio, renumber
from duologue.session import cut_lineage


def _ticks(seconds: float) -> Column:
    return F.lit(round(seconds * 100) * TICKS_PER_CS).cast("bigint")


def _cs(seconds: float) -> Column:
    return F.lit(round(seconds * 100)).cast("bigint")


def _join_ticks(ratio: Column, span_cs: Column) -> Column:
    """``ratio`` of the partner's span, in whole ticks."""
    return F.floor(ratio * span_cs * F.lit(float(TICKS_PER_CS)) + F.lit(0.5)).cast("bigint")


def _half(ticks: Column) -> Column:
    return F.shiftright(ticks, 1)


def _linked_span(span: Column, kind: Column, ticks: Column, ratio: Column) -> tuple[Column, Column]:
    """Start and end ticks of a linked turn, from its partner's start; ``span`` in hundredths."""
    whole = span * F.lit(TICKS_PER_CS)
    half = _half(whole)
    low = F.least(_ticks(0.15), half)
    wanted = F.coalesce(_join_ticks(ratio, span), F.least(_ticks(fv.OVERLAP_OFFSET_SEC), half))
    overlap = F.least(F.greatest(wanted, low), F.greatest(low, whole - _ticks(0.1)))
    cut_in = F.greatest(whole - _ticks(fv.INTERRUPT_LEAD_SEC), _ticks(0.05))
    longest = F.floor(whole * F.lit(8) / F.lit(10)).cast("bigint")
    short = F.greatest(_ticks(0.1), F.least(ticks, longest))
    placed = F.coalesce(_join_ticks(ratio, span), _half(whole - short))
    inside = F.least(F.greatest(placed, _ticks(0.1)), whole - short)
    start = F.when(kind == "Overlapping", overlap).when(kind == "Interruption", cut_in).otherwise(inside)
    cut_end = F.when(cut_in + ticks <= whole, whole + _ticks(fv.INTERRUPT_EXTEND_SEC)).otherwise(cut_in + ticks)
    end = F.when(kind == "Overlapping", overlap + ticks).when(kind == "Interruption", cut_end).otherwise(inside + short)
    return start, end


def _floor_after(span: Column, kind: Column, ticks: Column, ratio: Column) -> Column:
    """Floor end after an overlap or interruption, in ticks from the partner's start."""
    _, end = _linked_span(span, kind, ticks, ratio)
    return F.when(kind == "Overlapping", F.greatest(span * F.lit(TICKS_PER_CS), end)).otherwise(end)


def link_turns(
    turns: DataFrame, keys: Sequence[str] = ("conv_id",), size: int = BLOCK_ROWS, *, blocked: bool = True
) -> DataFrame:
    """Mark linked turns; result rows are blocks with one row of overlap on both sides.

    ``turns`` needs a dense 1-based ``pos``, ``speaker`` and ``turn_type``.  Without
    ``blocked`` each conversation is one block.
    """
    if blocked:
        blocks = with_halo(turns, "pos", size)
    else:
        blocks = turns.select("*", F.lit(0).cast("bigint").alias("_block"), F.lit(True).alias("_own"))
    in_order = block_window(keys, ["_block"], ["pos"])
    previous = F.lag("speaker").over(in_order)
    candidate = (F.col("turn_type") != "Normal") & (previous != F.col("speaker"))
    known = blocks.withColumn("_candidate", F.coalesce(candidate, F.lit(False)))
    anchor_pos = F.when(~F.col("_candidate"), F.col("pos"))
    # The leading halo row lacks its own predecessor, so only later rows may reset the run.
    leading = (~F.col("_own")) & ((F.col("pos") - 1) < F.col("_block") * size)
    local = F.max(F.when(~leading, anchor_pos)).over(
        in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = known.select("*", local.alias("_local"))
    if blocked:
        state = carry_over(known.where("_own"), keys, ["_block"], {"_before": ("max", anchor_pos)})
        joined = joined.join(state, [*keys, "_block"], "left")
    else:
        joined = joined.withColumn("_before", F.lit(None).cast("bigint"))
    reset = F.coalesce(F.greatest("_local", "_before"), F.lit(0))
    linked = F.col("_candidate") & ((F.col("pos") - reset) % 2 == 1)
    return joined.withColumn("_linked", linked & ~leading).drop("_local", "_before", "_candidate")


def lay_out(
    turns: DataFrame, keys: Sequence[str] = ("conv_id",), size: int = BLOCK_ROWS, *, blocked: bool = True
) -> DataFrame:
    """Times and relations of narrow turns ``(keys, pos, speaker, turn_type, ratio, ticks)``.

    ``blocked`` cuts conversations into blocks of ``size`` turns and carries state from
    block to block.  Where no conversation is longer than a block, the plan without it
    is a chain of windows after a single shuffle, with equal results.
    """
    linked = link_turns(turns, keys, size, blocked=blocked)
    in_order = block_window(keys, ["_block"], ["pos"])
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    follower = F.lead(F.struct("pos", "_linked", "turn_type", "ticks", "ratio")).over(in_order)

    # Groups: an unlinked turn and, at most, the turn linked to it.
    groups = (
        linked.select(*keys, "_block", "_own", "pos", "_linked", "ticks", follower.alias("_next"))
        .where("_own and not _linked")
        .select(
            *keys,
            "_block",
            "pos",
            "ticks",
            (F.col("ticks") + _ticks(fv.GAP_SEC)).alias("step"),
            *[
                F.when(F.col("_next._linked"), F.col(f"_next.{c}")).alias(a)
                for c, a in [("turn_type", "kind"), ("ticks", "ticks2"), ("ratio", "ratio2")]
            ],
        )
        .withColumn("resets", F.coalesce(F.col("kind").isin("Overlapping", "Interruption"), F.lit(False)))
    )
    if blocked:
        groups = cut_lineage(groups)

    # Elapsed speech before each group, and the last resetting group before it.
    whole = F.floor(F.col("ticks") / F.lit(TICKS_PER_CS)).cast("bigint")
    after = lambda bit: _floor_after(F.col("span") + bit, F.col("kind"), F.col("ticks2"), F.col("ratio2"))
    groups = groups.withColumn("span", whole)
    memo = F.when(
        F.col("resets"),
        F.struct("pos", F.col("elapsed").alias("elapsed"), after(0).alias("floor0"), after(1).alias("floor1")),
    )
    timed = groups.withColumn("_upto", F.sum("step").over(upto))
    if blocked:
        summed = carry_over(groups, keys, ["_block"], {"_base": ("sum", F.col("step"))})
        timed = timed.join(summed, [*keys, "_block"], "left")
        timed = timed.withColumn("elapsed", F.coalesce("_base", F.lit(0)) + F.col("_upto"))
    else:
        timed = timed.withColumn("elapsed", F.col("_upto"))
    timed = timed.withColumn("_memo", memo)
    nearest = F.max("_memo").over(before)
    if blocked:
        reset_before = carry_over(
            timed.select(*keys, "_block", "_memo"), keys, ["_block"], {"_earlier": ("max", F.col("_memo"))}
        )
        timed = (
            timed.withColumn("_near", nearest)
            .join(reset_before, [*keys, "_block"], "left")
            .withColumn("_last", F.coalesce("_near", "_earlier"))
        )
    else:
        timed = timed.withColumn("_last", nearest)
    timed = timed.select(
        *keys, "_block", "pos", "ticks", "kind", "ticks2", "ratio2", "resets", "span", "elapsed", "step", "_last"
    )
    opening = F.col("_last").isNull()
    offset = F.col("elapsed") - F.col("step")  # start of the group if nothing reset before
    since = offset - F.col("_last.elapsed") + _ticks(fv.GAP_SEC)  # from the last reset's floor

    def start_given(bit: int) -> Column:
        return F.when(opening, offset).otherwise(F.col(f"_last.floor{bit}") + since)

    # Each resetting group maps the incoming bit to (outgoing bit, shift of the base).
    timed = timed.select(
        "*",
        *[start_given(b).alias(f"start{b}") for b in (0, 1)],
    ).select(
        "*",
        *[
            F.when(
                F.col("resets"),
                (ticks_to_cs(F.col(f"start{b}") + F.col("ticks")) - ticks_to_cs(F.col(f"start{b}")) - F.col("span")),
            ).alias(f"bit{b}")
            for b in (0, 1)
        ],
        *[F.when(F.col("resets"), ticks_to_cs(F.col(f"start{b}"))).alias(f"shift{b}") for b in (0, 1)],
    )
    timed = timed.drop("_last", "elapsed", "step")
    if blocked:
        timed = cut_lineage(timed)

    constant = F.col("resets") & (F.col("bit0") == F.col("bit1"))
    swaps = (F.col("resets") & (F.col("bit0") != F.col("bit1")) & (F.col("bit0") == 1)).cast("bigint")

    def bit_before(given: Column, frame, code_name: str) -> Column:
        """Incoming bit of a row: the last fixed bit, flipped once per swap since."""
        code = F.max(F.col(code_name)).over(frame)
        swapped = F.coalesce(F.sum("_swap").over(frame), F.lit(0))
        fixed = (F.shiftright(code, 1) % 2 + swapped + code % 2) % 2
        return F.coalesce(fixed, (given + swapped) % 2)

    local = timed.withColumn("_swap", swaps)
    local = local.withColumn("_swaps", F.sum("_swap").over(upto))
    # position * 4 + bit * 2 + parity of the swaps so far: the latest position wins a max().
    local = local.withColumn(
        "_code", F.when(constant, F.col("pos") * 4 + F.col("bit0") * 2 + F.col("_swaps") % 2)
    )
    for given in (0, 1):
        local = local.withColumn(f"_in{given}", bit_before(F.lit(given), before, "_code"))
        local = local.withColumn(
            f"_move{given}", F.when(F.col("resets"), F.when(F.col(f"_in{given}") == 1, F.col("shift1")).otherwise(F.col("shift0")))
        )
    if blocked:
        solved = local.join(_block_entries(local, keys), [*keys, "_block"], "left")
    else:
        zero = F.lit(0).cast("bigint")
        solved = local.select("*", zero.alias("_entry"), zero.alias("_base"))
    picked = lambda name: F.when(F.col("_entry") == 1, F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    solved = solved.withColumn("_bit", picked("_in")).withColumn("_move", picked("_move"))
    base_before = F.col("_base") + F.coalesce(F.sum("_move").over(before), F.lit(0))
    solved = solved.withColumn("_origin", base_before)

    # Final times, in hundredths of a second.
    start = F.when(F.col("_bit") == 1, F.col("start1")).otherwise(F.col("start0"))
    first_start = F.col("_origin") + ticks_to_cs(start)
    first_end = F.col("_origin") + ticks_to_cs(start + F.col("ticks"))
    placed = solved.select(*keys, "pos", "kind", "ticks2", "ratio2", first_start.alias("s"), first_end.alias("e"))
    start2, end2 = _linked_span(F.col("e") - F.col("s"), F.col("kind"), F.col("ticks2"), F.col("ratio2"))
    name = lambda p: F.concat(F.lit("t"), p.cast("string"))
    here, there = F.col("pos"), F.col("pos") + 1
    cut = F.coalesce(F.col("kind") == "Interruption", F.lit(False))
    rows = F.array_compact(
        F.array(
            F.struct(
                here.alias("pos"),
                F.lit("Normal").alias("turn_type"),
                F.col("s").alias("start_cs"),
                F.col("e").alias("end_cs"),
                F.when(F.col("kind").isNotNull(), name(there)).alias("overlaps_with"),
                F.col("kind").alias("overlaps_kind"),
                cut.alias("interrupted"),
                F.when(cut, name(there)).alias("interrupted_by"),
            ),
            F.when(
                F.col("kind").isNotNull(),
                F.struct(
                    there.alias("pos"),
                    F.col("kind").alias("turn_type"),
                    (F.col("s") + ticks_to_cs(start2)).alias("start_cs"),
                    (F.col("s") + ticks_to_cs(end2)).alias("end_cs"),
                    name(here).alias("overlaps_with"),
                    F.col("kind").alias("overlaps_kind"),
                    F.lit(False).alias("interrupted"),
                    F.lit(None).cast("string").alias("interrupted_by"),
                ),
            ),
        )
    )
    return placed.select(*keys, F.explode(rows).alias("_row")).select(*keys, "_row.*")


def _block_entries(local: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming bit and base of every block, from one summary row per block."""
    summary = local.groupBy(*keys, "_block").agg(
        F.max("_code").alias("code"),
        F.sum("_swap").alias("swaps"),
        F.coalesce(F.sum("_move0"), F.lit(0)).alias("move0"),
        F.coalesce(F.sum("_move1"), F.lit(0)).alias("move1"),
    )
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A block with a fixed bit ends on it, flipped by the swaps after it.
    fixed = (F.shiftright(F.col("code"), 1) % 2 + F.col("swaps") + F.col("code") % 2) % 2
    summary = summary.withColumn("_run", F.sum("swaps").over(upto)).withColumn(
        "_mark", F.when(F.col("code").isNotNull(), F.col("_block") * 4 + fixed * 2 + F.col("_run") % 2)
    )
    mark = F.max("_mark").over(earlier)
    run = F.coalesce(F.sum("swaps").over(earlier), F.lit(0))
    entry = F.coalesce((F.shiftright(mark, 1) % 2 + run + mark % 2) % 2, F.lit(0))
    summary = summary.withColumn("_entry", entry).withColumn(
        "_moved", F.when(F.col("_entry") == 1, F.col("move1")).otherwise(F.col("move0"))
    )
    return summary.select(
        *keys, "_block", "_entry", F.coalesce(F.sum("_moved").over(earlier), F.lit(0)).alias("_base")
    )


def assemble_timeline(
    turns: DataFrame, keys: Sequence[str] = ("conv_id",), size: int = BLOCK_ROWS
) -> DataFrame:
    """Parsed turns ``(keys, pos, speaker, turn_type, ratio, emotion, text)`` to full turns.

    ``pos`` is dense and 1-based.  Only narrow columns go through the layout; text
    joins its times at the end on ``(keys, pos)``.  The longest conversation is
    measured first: only if it exceeds a block of ``size`` turns is the block-wise
    plan needed.
    """
    longest = turns.agg(F.max("pos")).first()[0] or 0
    narrow = turns.select(
        *keys,
        F.col("pos").cast("bigint").alias("pos"),
        "speaker",
        "turn_type",
        F.col("ratio").cast("double").alias("ratio"),
        speech_ticks(F.col("text"), F.col("emotion")).alias("ticks"),
    )
    times = lay_out(narrow, keys, size, blocked=longest > size)
    absent = F.lit(None).cast("double")
    return turns.drop("turn_type").join(times, [*keys, "pos"]).select(
        *keys,
        "pos",
        F.concat(F.lit("t"), F.col("pos").cast("string")).alias("turn_id"),
        "speaker",
        "text",
        "emotion",
        (F.col("start_cs") / F.lit(100.0)).alias("planned_start_sec"),
        (F.col("end_cs") / F.lit(100.0)).alias("planned_end_sec"),
        absent.alias("real_start_sec"),
        absent.alias("real_end_sec"),
        absent.alias("error_time"),
        "turn_type",
        "overlaps_with",
        "overlaps_kind",
        "interrupted",
        "interrupted_by",
    )


def repair(turns: DataFrame, edits: DataFrame, keys: Sequence[str] = ("conv_id",)) -> DataFrame:
    """Laid-out turns with edits applied and laid out anew.

    Relations keep where they began inside their partner, turns are numbered afresh, and
    the new layout decides which relations still hold.  Edits that would delete every turn
    of a conversation are refused: it comes back as it was, ``refused`` is true.
    """
    after = apply_edits(recover_ratio(turns, keys), edits, keys)
    emptied = emptied_conversations(turns, after, keys)
    # stored, as the layout reads it several times
    dense = renumber(after.select(*keys, "pos", "speaker", "turn_type", "ratio", "emotion", "text"), keys)
    laid = assemble_timeline(cut_lineage(dense).drop("turn_id"), keys)
    unedited = turns.join(emptied, list(keys), "left_semi").select(*laid.columns)
    return laid.withColumn("refused", F.lit(False)).unionByName(unedited.withColumn("refused", F.lit(True)))
