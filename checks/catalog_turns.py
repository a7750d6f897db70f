"""Dialogue side: parsing, layout, quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.views import Views, cat, json_string, text_of
from checks.views_sql import rnd, sec, squeeze, words
from duologue.functions import dialogue as dx
from duologue.functions import fixed_values as fv
from duologue.functions.text import round_half_up
from duologue.operators import overlap, quality, timeline, turns
from duologue.sources import dialogue as sources

c = F.col
ISSUE = ["conv_id", "pos", "turn_id", "level", "rule", "message"]
LINE_SPLIT = "string_split(transcript, chr(10))"


def turn_lines(v: Views):
    """Turns as JSON lines; absent keys stay absent, some lines are blank or broken."""
    t = v.turns_timed
    present = lambda f: F.array_contains("present_keys", f)
    value = {"text": json_string(c("text")), "interrupted": text_of(c("interrupted"))}
    cells = []
    for f in fv.TURN_FIELDS:
        if f in value:
            shown = value[f]
        elif f.endswith("_sec") or f == "error_time":
            shown = F.coalesce(text_of(c(f)), F.lit("null"))
        else:
            shown = F.coalesce(cat('"', c(f), '"'), F.lit("null"))
        cells.append(F.when(present(f), F.concat(F.lit(f'"{f}":'), shown)))
    line = cat("{", F.concat_ws(",", *cells), "}")
    k = (c("conv_id") + c("pos")) % 25
    return t.select("conv_id", "pos", F.when(k == 0, "   ").when(k == 1, F.substring(line, 1, 20)).otherwise(line).alias("value"))


def stored_documents(v: Views):
    """A stored conversation document per conversations row: its lines as turns."""
    lines = F.transform(
        F.split("text", "\n", -1), lambda x, i: F.concat(F.lit('{"turn_id":"t'), (i + 1).cast("string"), F.lit('","text":'), json_string(x), F.lit("}"))
    )
    return v.table("conversations").select(
        "conv_id", "turn", F.when(c("role") == "system", '{"turns":[]}').otherwise(cat('{"index":1,"turns":[', F.array_join(lines, ","), "]}")).alias("value")
    )


def assembled(v: Views):
    return timeline.assemble_timeline(v.turns_full)


FIELDS14 = ["turn_id", "speaker", "text", "emotion", "planned_start_sec", "planned_end_sec", "turn_type", "overlaps_with", "overlaps_kind", "interrupted", "interrupted_by"]

# A sequential walk in whole ticks (7800 per hundredth of a second), one row per turn:
# the state is the floor's end, the floor turn (position, speaker, free or not, span).
def walk_sql(source: str) -> str:
    return f"""
    WITH RECURSIVE input AS (
        SELECT conv_id, pos, speaker, turn_type AS want, ratio,
               greatest(468000, greatest({words('text')}, 1) * CASE emotion WHEN 'Sad' THEN 195000 WHEN 'Angry' THEN 130000 ELSE 156000 END
                              + greatest(length(text), 1) * CASE emotion WHEN 'Sad' THEN 37500 WHEN 'Angry' THEN 25000 ELSE 30000 END) AS dur
        FROM {source}),
    walk AS (
        SELECT conv_id, pos, speaker, 'Normal' AS turn_type, CAST(0 AS BIGINT) AS s, CAST((dur + 3900) // 7800 AS BIGINT) AS e, CAST(NULL AS BIGINT) AS partner,
               CAST(dur AS BIGINT) AS floor_end, CAST(pos AS BIGINT) AS f_pos, speaker AS f_speaker, TRUE AS f_free, CAST(0 AS BIGINT) AS f_s, CAST((dur + 3900) // 7800 AS BIGINT) AS f_e
        FROM input WHERE pos = 1
        UNION ALL
        SELECT conv_id, pos, speaker, turn_type, CAST((st + 3900) // 7800 AS BIGINT), CAST((en + 3900) // 7800 AS BIGINT), CASE WHEN turn_type <> 'Normal' THEN f_pos END,
               CAST(CASE turn_type WHEN 'Backchanneling' THEN floor_end WHEN 'Overlapping' THEN greatest(f_e * 7800, en) ELSE en END AS BIGINT),
               CASE WHEN turn_type = 'Backchanneling' THEN f_pos ELSE CAST(pos AS BIGINT) END, CASE WHEN turn_type = 'Backchanneling' THEN f_speaker ELSE speaker END, turn_type = 'Normal',
               CASE WHEN turn_type = 'Backchanneling' THEN f_s ELSE CAST((st + 3900) // 7800 AS BIGINT) END, CASE WHEN turn_type = 'Backchanneling' THEN f_e ELSE CAST((en + 3900) // 7800 AS BIGINT) END
        FROM (
            SELECT *, CASE turn_type WHEN 'Normal' THEN st + dur WHEN 'Overlapping' THEN st + dur WHEN 'Backchanneling' THEN st + sub
                                     ELSE CASE WHEN st + dur <= f_e * 7800 THEN f_e * 7800 + 234000 ELSE st + dur END END AS en
            FROM (
                SELECT *, CASE turn_type
                    WHEN 'Normal' THEN floor_end + 234000
                    WHEN 'Overlapping' THEN f_s * 7800 + least(greatest(coalesce(CAST(floor(ratio * span * 7800 + 0.5) AS BIGINT), least(390000, span * 3900)), least(117000, span * 3900)),
                                                               greatest(least(117000, span * 3900), span * 7800 - 78000))
                    WHEN 'Interruption' THEN greatest(f_e * 7800 - 312000, f_s * 7800 + 39000)
                    ELSE least(greatest(f_s * 7800 + coalesce(CAST(floor(ratio * span * 7800 + 0.5) AS BIGINT), (span * 7800 - sub) // 2), f_s * 7800 + 78000), f_e * 7800 - sub) END AS st
                FROM (
                    SELECT i.conv_id, i.pos, i.speaker, i.ratio, i.dur, w.floor_end, w.f_pos, w.f_speaker, w.f_s, w.f_e, w.f_e - w.f_s AS span,
                           greatest(78000, least(i.dur, (w.f_e - w.f_s) * 6240)) AS sub,
                           CASE WHEN i.want <> 'Normal' AND w.f_free AND w.f_speaker <> i.speaker THEN i.want ELSE 'Normal' END AS turn_type
                    FROM walk w JOIN input i ON i.conv_id = w.conv_id AND i.pos = w.pos + 1)))),
    laid AS (SELECT w.conv_id, w.pos, w.speaker, w.turn_type, w.s / 100.0::DOUBLE AS planned_start_sec, w.e / 100.0::DOUBLE AS planned_end_sec,
               't' || coalesce(w.partner, n.pos) AS overlaps_with, coalesce(CASE WHEN w.partner IS NOT NULL THEN w.turn_type END, n.turn_type) AS overlaps_kind,
               coalesce(n.turn_type = 'Interruption', FALSE) AS interrupted, CASE WHEN n.turn_type = 'Interruption' THEN 't' || n.pos END AS interrupted_by
        FROM walk w LEFT JOIN walk n ON n.conv_id = w.conv_id AND n.partner = w.pos)"""


ASSEMBLE_SQL = walk_sql("turns_full") + """
    SELECT l.conv_id, l.pos, 't' || l.pos AS turn_id, l.speaker, t.text, t.emotion, planned_start_sec, planned_end_sec, l.turn_type, overlaps_with, overlaps_kind, interrupted, interrupted_by
    FROM laid l JOIN turns_full t USING (conv_id, pos)"""

SCALED_SQL = walk_sql("turns_full") + f"""
    SELECT conv_id, pos, {rnd('(planned_start_sec - t0) * scale + t0')} AS planned_start_sec, {rnd('(planned_end_sec - t0) * scale + t0')} AS planned_end_sec
    FROM laid JOIN (SELECT conv_id, t0, least(greatest(CAST(200 + (conv_id * 97) % 400 AS DOUBLE), 240.0), 480.0) / (t1 - t0) AS scale
                    FROM (SELECT conv_id, min(planned_start_sec) AS t0, max(planned_end_sec) AS t1 FROM laid GROUP BY 1)) USING (conv_id)"""


def repaired(v: Views):
    """The layout after edits that drop, shorten and join turns; some conversations lose all of theirs."""
    k = (c("conv_id") + c("pos")) % 12
    edits = v.turns_full.select(
        "conv_id",
        cat("t", c("pos").cast("string")).alias("turn_id"),
        F.lit(1).alias("edit_no"),
        F.when((k == 3) | (c("conv_id") % 7 == 6), " DELETE ").otherwise("replace").alias("action"),
        F.when(k < 5, cat(" short ", c("pos").cast("string"))).alias("text"),
        F.when(k == 7, "angry").alias("emotion"),
        F.when(k == 5, "overlap").alias("turn_type"),
    )
    return timeline.repair(assembled(v), edits).select("conv_id", "pos", *FIELDS14, "refused")


LAID_SQL = "(" + walk_sql("turns_full") + " SELECT l.*, t.text, t.emotion FROM laid l JOIN turns_full t USING (conv_id, pos))"
REPAIR_INPUT = f"""(
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS pos, speaker, ratio,
           CASE WHEN k < 5 THEN 'short ' || pos ELSE text END AS text, CASE WHEN k = 7 THEN 'Angry' ELSE emotion END AS emotion,
           CASE WHEN k = 5 THEN 'Overlapping' ELSE turn_type END AS turn_type
    FROM (SELECT a.*, (a.conv_id + a.pos) % 12 AS k,
                 CASE WHEN a.turn_type IN ('Overlapping', 'Backchanneling') AND h.planned_end_sec > h.planned_start_sec
                      THEN least(greatest((a.planned_start_sec - h.planned_start_sec) / (h.planned_end_sec - h.planned_start_sec), 0.0), 1.0) END AS ratio
          FROM first_layout a LEFT JOIN first_layout h ON h.conv_id = a.conv_id AND 't' || h.pos = a.overlaps_with)
    WHERE k <> 3 AND conv_id % 7 <> 6)"""
REPAIR_SQL = walk_sql("repair_input").replace("WITH RECURSIVE input AS", f"WITH RECURSIVE first_layout AS MATERIALIZED {LAID_SQL}, repair_input AS MATERIALIZED {REPAIR_INPUT}, input AS") + """
    SELECT l.conv_id, l.pos, 't' || l.pos AS turn_id, l.speaker, t.text, t.emotion, planned_start_sec, planned_end_sec, l.turn_type, overlaps_with, overlaps_kind, interrupted, interrupted_by, FALSE AS refused
    FROM laid l JOIN repair_input t USING (conv_id, pos)
    UNION ALL SELECT conv_id, pos, 't' || pos, speaker, text, emotion, planned_start_sec, planned_end_sec, turn_type, overlaps_with, overlaps_kind, interrupted, interrupted_by, TRUE
    FROM first_layout WHERE conv_id NOT IN (SELECT conv_id FROM repair_input)"""


def edited(v: Views):
    return turns.apply_edits(v.turns_timed.drop("present_keys"), v.edits)


EDITED_SQL = """
    SELECT t.conv_id, t.pos, t.turn_id, coalesce(e.x, t.text) AS text, coalesce(e.em, t.emotion) AS emotion, coalesce(e.ty, t.turn_type) AS turn_type
    FROM turns_timed t LEFT JOIN (
        SELECT conv_id, trim(turn_id) AS turn_id, bool_or(del) AS deleted, arg_max(x, edit_no) FILTER (x IS NOT NULL AND NOT del) AS x,
               arg_max(em, edit_no) FILTER (em IS NOT NULL AND NOT del) AS em, arg_max(ty, edit_no) FILTER (ty IS NOT NULL AND NOT del) AS ty
        FROM (SELECT *, lower(trim(action)) = 'delete' AS del, nullif(trim(text), '') AS x,
                     CASE lower(emotion) WHEN 'sad' THEN 'Sad' WHEN 'angry' THEN 'Angry' END AS em, CASE turn_type WHEN 'overlap' THEN 'Overlapping' END AS ty
              FROM edits_once) GROUP BY 1, 2) e ON e.conv_id = t.conv_id AND e.turn_id = t.turn_id
    WHERE NOT coalesce(e.deleted, FALSE)"""


def edits_once(v: Views):
    """One edit per (turn id, number): a repeated id keeps its last text."""
    return v.edits.groupBy("conv_id", "turn_id", "edit_no").agg(
        F.max("action").alias("action"), F.max("text").alias("text"), F.max("emotion").alias("emotion"), F.max("turn_type").alias("turn_type")
    )


ONCE = "(SELECT conv_id, turn_id, edit_no, max(action) AS action, max(text) AS text, max(emotion) AS emotion, max(turn_type) AS turn_type FROM edits GROUP BY 1, 2, 3)"


# ---- quality rules in SQL ----------------------------------------------------
GOOD = "(SELECT * FROM turns_timed WHERE complete)"


def row_rule(rule: str, cases: list[tuple[str, str]]) -> str:
    parts = [
        f"SELECT conv_id, pos, turn_id, 'ERROR' AS level, '{rule}' AS rule, {message} AS message FROM {GOOD} WHERE {bad}" for bad, message in cases
    ]
    return " UNION ALL ".join(parts)


def not_in(name: str, allowed: list[str]) -> str:
    cells = ", ".join(f"'{a}'" for a in allowed)
    return f"coalesce({name} NOT IN ({cells}), TRUE)"


PAIRS = """
    (SELECT p.*, (a_s <= b_s) AS early,
            CASE WHEN a_s <= b_s THEN ref_id ELSE turn_id END AS first_id, CASE WHEN a_s <= b_s THEN a_s ELSE b_s END AS first_s, CASE WHEN a_s <= b_s THEN a_e ELSE b_e END AS first_e,
            CASE WHEN a_s <= b_s THEN turn_id ELSE ref_id END AS second_id, CASE WHEN a_s <= b_s THEN b_s ELSE a_s END AS second_s, CASE WHEN a_s <= b_s THEN b_e ELSE a_e END AS second_e,
            CASE WHEN a_s <= b_s THEN ref_interrupted ELSE interrupted END AS first_cut,
            CASE WHEN interrupted AND coalesce(interrupted_by = overlaps_with, FALSE) THEN 'b' WHEN ref_interrupted AND coalesce(ref_interrupted_by = turn_id, FALSE) THEN 'a' END AS victim
     FROM (SELECT t.conv_id, t.pos, t.turn_id, t.overlaps_with, t.overlaps_kind, t.interrupted, t.interrupted_by, t.planned_start_sec AS b_s, t.planned_end_sec AS b_e,
                  r.turn_id AS ref_id, r.overlaps_with AS ref_overlaps_with, r.overlaps_kind AS ref_kind, r.interrupted AS ref_interrupted, r.interrupted_by AS ref_interrupted_by,
                  r.planned_start_sec AS a_s, r.planned_end_sec AS a_e, r.turn_id IS NOT NULL AS found
           FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, least(turn_id, overlaps_with), greatest(turn_id, overlaps_with) ORDER BY pos) AS rn
                 FROM turns_timed WHERE overlaps_with IS NOT NULL) t
           LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY conv_id, turn_id ORDER BY pos DESC) AS rn FROM turns_timed) r
             ON r.conv_id = t.conv_id AND r.turn_id = t.overlaps_with AND r.rn = 1
           WHERE t.rn = 1) p)"""
TIMED = "found AND a_s IS NOT NULL AND a_e IS NOT NULL AND b_s IS NOT NULL AND b_e IS NOT NULL"
V_S, V_E = "CASE WHEN victim = 'b' THEN b_s ELSE a_s END", "CASE WHEN victim = 'b' THEN b_e ELSE a_e END"
I_S, I_E = "CASE WHEN victim = 'b' THEN a_s ELSE b_s END", "CASE WHEN victim = 'b' THEN a_e ELSE b_e END"
VICTIM, CUTTER = "CASE WHEN victim = 'b' THEN turn_id ELSE overlaps_with END", "CASE WHEN victim = 'b' THEN overlaps_with ELSE turn_id END"


def pair_rule(rule: str, level: str, bad: str, message: str, target: str = "turn_id") -> str:
    return f"SELECT conv_id, pos, {target} AS turn_id, '{level}' AS level, '{rule}' AS rule, {message} AS message FROM {PAIRS} WHERE {bad}"


def kind_is(kind: str) -> str:
    return f"({TIMED}) AND coalesce(overlaps_kind = '{kind}', FALSE)"


SPANS = f"second_id || ''' [' || {sec('second_s')} || ', ' || {sec('second_e')} || ']"
FIRST = f"first_id || ''' [' || {sec('first_s')} || ', ' || {sec('first_e')} || ']"

PAIR_SQL = {
    "unknown_reference": pair_rule("unknown_reference", "ERROR", "NOT found", "'Relation points at unknown turn ''' || overlaps_with || '''.'"),
    "asymmetric_overlap": pair_rule(
        "asymmetric_overlap", "ERROR", "found AND ref_overlaps_with IS DISTINCT FROM turn_id",
        "'''' || turn_id || ''' points at ''' || overlaps_with || ''', which points at ''' || coalesce(ref_overlaps_with, 'None') || '''.'",
    ),
    "kind_mismatch": pair_rule(
        "kind_mismatch", "ERROR", "found AND ref_kind IS DISTINCT FROM overlaps_kind",
        "'Kinds differ from ''' || overlaps_with || ''': ''' || coalesce(overlaps_kind, 'None') || ''' and ''' || coalesce(ref_kind, 'None') || '''.'",
    ),
    "times_missing": pair_rule("times_missing", "WARNING", f"found AND NOT ({TIMED})", "'Timing against ''' || overlaps_with || ''' cannot be checked: times are missing.'"),
    "backchannel_nested": pair_rule(
        "backchannel_nested", "ERROR",
        f"{kind_is('Backchanneling')} AND NOT (first_s - 0.05::DOUBLE <= second_s AND second_e <= first_e + 0.05::DOUBLE)",
        f"'Backchannel ''' || {SPANS} is not inside host ''' || {FIRST}.'",
    ),
    "backchannel_host_interrupted": pair_rule(
        "backchannel_host_interrupted", "ERROR", f"{kind_is('Backchanneling')} AND first_cut", "'The host of a backchannel is marked interrupted.'", "first_id"
    ),
    "interruption_marking": pair_rule(
        "interruption_marking", "ERROR", f"{kind_is('Interruption')} AND victim IS NULL", "'Neither side of the interruption is marked as interrupted by the other.'"
    ),
    "interruption_start": pair_rule(
        "interruption_start", "ERROR", f"{kind_is('Interruption')} AND victim IS NOT NULL AND NOT ({V_S} < {I_S} AND {I_S} < {V_E} + 0.05::DOUBLE)",
        f"'Start ' || {sec(I_S)} || ' lies outside victim ''' || {VICTIM} || ''' [' || {sec(V_S)} || ', ' || {sec(V_E)} || '].'", CUTTER,
    ),
    "interruption_end": pair_rule(
        "interruption_end", "WARNING", f"{kind_is('Interruption')} AND victim IS NOT NULL AND NOT ({I_E} > {V_E} - 0.05::DOUBLE)",
        f"'End ' || {sec(I_E)} || ' does not pass the victim''s end ' || {sec(V_E)} || '.'", CUTTER,
    ),
    "interrupter_interrupted": pair_rule(
        "interrupter_interrupted", "ERROR", f"{kind_is('Interruption')} AND victim IS NOT NULL AND CASE WHEN victim = 'b' THEN ref_interrupted ELSE interrupted END",
        "'The interrupter is itself marked interrupted.'", CUTTER,
    ),
    "collision_intersects": pair_rule(
        "collision_intersects", "ERROR", f"{kind_is('Overlapping')} AND NOT (first_s < second_s AND second_s < first_e + 0.05::DOUBLE)",
        f"'Overlap ''' || {SPANS} does not meet ''' || {FIRST}.'",
    ),
    "collision_gap": pair_rule(
        "collision_gap", "WARNING", f"{kind_is('Overlapping')} AND second_s - first_s > 3.0::DOUBLE", f"'Overlap starts ' || {sec('second_s - first_s')} || ' s apart.'"
    ),
    "collision_interrupted": pair_rule(
        "collision_interrupted", "WARNING", f"{kind_is('Overlapping')} AND (interrupted OR ref_interrupted)", "'An overlapping turn is marked interrupted.'"
    ),
}

ROW_SQL = {
    "required_fields": """SELECT conv_id, pos, turn_id, 'ERROR' AS level, 'required_fields' AS rule, 'Missing fields: emotion, real_end_sec' AS message FROM turns_timed WHERE NOT complete""",
    "duplicate_id": f"""SELECT conv_id, pos, turn_id, 'ERROR' AS level, 'duplicate_id' AS rule, 'Repeated turn_id.' AS message
        FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn_id ORDER BY pos) AS rn FROM {GOOD}) WHERE rn > 1""",
    "enum_values": row_rule("enum_values", [
        (not_in("speaker", fv.SPEAKERS), "'Invalid speaker ''' || coalesce(speaker, 'None') || '''.'"),
        (not_in("emotion", fv.EMOTIONS), "'Invalid emotion ''' || coalesce(emotion, 'None') || '''.'"),
        (not_in("turn_type", fv.TURN_TYPES), "'Invalid turn_type ''' || coalesce(turn_type, 'None') || '''.'"),
        ("overlaps_kind IS NOT NULL AND " + not_in("overlaps_kind", fv.RELATION_KINDS), "'Invalid overlaps_kind ''' || overlaps_kind || '''.'"),
    ]),
    "planned_times": row_rule("planned_times", [
        ("planned_start_sec IS NULL OR planned_end_sec IS NULL", "'Planned times must not be null.'"),
        ("planned_end_sec <= planned_start_sec", f"'Planned end ' || {sec('planned_end_sec')} || ' must be after start ' || {sec('planned_start_sec')} || '.'"),
    ]),
    "overlap_both_or_none": row_rule("overlap_both_or_none", [
        ("(overlaps_with IS NULL) <> (overlaps_kind IS NULL)", "'overlaps_with and overlaps_kind must be set together.'")
    ]),
    "interrupted_consistency": row_rule("interrupted_consistency", [
        ("interrupted AND coalesce(interrupted_by, '') = ''", "'Interrupted, but no interrupter is named.'"),
        ("NOT interrupted AND coalesce(interrupted_by, '') <> ''", "'An interrupter is named, but interrupted is false.'"),
    ]),
}

STATS = """(SELECT conv_id, max(planned_end_sec) - min(planned_start_sec) AS duration_sec, count(*) AS n_turns,
    count(*) FILTER (turn_type = 'Normal') AS "Normal", count(*) FILTER (turn_type = 'Overlapping') AS "Overlapping",
    count(*) FILTER (turn_type = 'Interruption') AS "Interruption", count(*) FILTER (turn_type = 'Backchanneling') AS "Backchanneling" FROM turns_timed GROUP BY 1)"""
CONV_SQL = {
    "total_duration": f"""SELECT conv_id, CAST(0 AS BIGINT) AS pos, '<conversation>' AS turn_id, 'ERROR' AS level, 'total_duration' AS rule,
        'Duration ' || {sec('duration_sec', 1)} || ' s is outside 240-480 s.' AS message FROM {STATS} WHERE NOT duration_sec BETWEEN 240 AND 480""",
    "min_overlap_counts": " UNION ALL ".join(
        f"""SELECT conv_id, CAST(0 AS BIGINT) AS pos, '<conversation>' AS turn_id, 'WARNING' AS level, 'min_overlap_counts' AS rule,
            CASE WHEN "{k}" = 0 THEN 'No {k} turn; the minimum is 12.' ELSE 'Only ' || "{k}" || ' {k} turn(s); the minimum is 12.' END AS message FROM {STATS} WHERE "{k}" < 12"""
        for k in fv.RELATION_KINDS
    ),
}
# The fixed minimum of 2 never fails on these turns, so the checks also ask for 12.
ALL_SQL = " UNION ALL ".join([*ROW_SQL.values(), *PAIR_SQL.values(), *CONV_SQL.values()])


def all_issues(v: Views):
    return quality.validate_turns(v.turns_timed, minimum=12)


FAITHFUL_SQL = """,
    l AS (SELECT *, row_number() OVER (PARTITION BY conv_id, w ORDER BY pos) AS nth FROM lw),
    t AS (SELECT *, row_number() OVER (PARTITION BY conv_id, w ORDER BY pos) AS nth FROM tw),
    pairs AS (SELECT l.conv_id, l.pos AS line, t.pos AS turn, l.speaker <> t.speaker AS swapped FROM l JOIN t USING (conv_id, w, nth)),
    chains AS (SELECT conv_id, line, turn, 1 AS n FROM pairs
        UNION SELECT b.conv_id, b.line, b.turn, a.n + 1 FROM chains a JOIN pairs b ON b.conv_id = a.conv_id AND b.line > a.line AND b.turn > a.turn),
    longest AS (SELECT conv_id, line, turn, max(n) AS n FROM chains GROUP BY ALL),
    kept AS (SELECT * FROM (SELECT conv_id, line, turn, n FROM longest QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, line DESC) = 1)
        UNION ALL SELECT conv_id, line, turn, n FROM (SELECT b.* FROM kept a JOIN longest b ON b.conv_id = a.conv_id AND b.n = a.n - 1 AND b.line < a.line AND b.turn < a.turn) AS earlier
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY line DESC) = 1),
    placed AS (SELECT p.*, k.line IS NULL AS moved FROM pairs p LEFT JOIN kept k USING (conv_id, line)),
    lost AS (SELECT conv_id, pos, w, gap FROM (SELECT *, coalesce(max(mark) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS gap FROM (
        SELECT conv_id, pos, w, CAST(NULL AS BIGINT) AS mark FROM l ANTI JOIN t USING (conv_id, w, nth) UNION ALL SELECT conv_id, line, NULL, turn FROM placed WHERE NOT moved)) WHERE mark IS NULL),
    new AS (SELECT conv_id, pos, w, gap FROM (SELECT *, coalesce(max(mark) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS gap FROM (
        SELECT conv_id, pos, w, CAST(NULL AS BIGINT) AS mark FROM t ANTI JOIN l USING (conv_id, w, nth) UNION ALL SELECT conv_id, turn, NULL, turn FROM placed WHERE NOT moved)) WHERE mark IS NULL),
    lost_n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, gap ORDER BY pos) AS i FROM lost),
    new_n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, gap ORDER BY pos) AS i FROM new)
    SELECT conv_id, line AS pos, CASE WHEN moved THEN 'reordered' ELSE 'speaker_swapped' END AS problem, CAST(NULL AS INTEGER) AS edit_distance FROM placed WHERE moved OR swapped
    UNION ALL SELECT coalesce(a.conv_id, b.conv_id), coalesce(a.pos, b.pos), CASE WHEN b.pos IS NULL THEN 'dropped' WHEN a.pos IS NULL THEN 'added' ELSE 'reworded' END,
           CAST(levenshtein(a.w, b.w) AS INTEGER)
    FROM lost_n a FULL OUTER JOIN new_n b ON a.conv_id = b.conv_id AND a.gap = b.gap AND a.i = b.i"""
WORDS = r"lower(regexp_replace(text, '[^\p{L}\p{N}\p{M}]+', '', 'g'))"


def faithful_turns(v: Views):
    """Turns that drop, swap, reword or move some lines of the transcript, alone and in blocks of two."""
    k = (c("conv_id") * 3 + c("pos")) % 17
    return v.turns_raw.where(k != 5).select(
        "conv_id",
        F.when(k == 6, c("pos") + 5000).when(k.isin(10, 11), c("pos") + 3000).otherwise(c("pos")).alias("pos"),
        F.when(k == 7, F.when(c("speaker") == "speaker_1", "speaker_2").otherwise("speaker_1")).otherwise(c("speaker")).alias("speaker"),
        F.when(k == 8, cat(c("text"), " indeed")).otherwise(F.replace("text", F.lit(" "), F.lit(" , "))).alias("text"),
    )


def parsed(v: Views):
    return turns.parse_lines(v.tagged)


MINIMUM_SQL = """
    WITH hosts AS (SELECT a.conv_id, a.pos, a.turn_type, max(h.pos) AS host_pos FROM parsed a LEFT JOIN parsed h ON h.conv_id = a.conv_id AND h.pos < a.pos AND h.turn_type <> 'Backchanneling' GROUP BY 1, 2, 3),
    related AS (SELECT h.conv_id, h.pos, h.turn_type, h.host_pos, p.turn_type AS host_type FROM hosts h JOIN parsed p ON p.conv_id = h.conv_id AND p.pos = h.host_pos WHERE h.turn_type <> 'Normal')
    SELECT conv_id, 'min_' || kind AS rule, '' AS subject, n FROM (
        SELECT c.conv_id, k.kind, count(*) FILTER (c.turn_type = k.kind) AS n, any_value(k.low) AS low FROM parsed c, (VALUES ('Interruption', 2), ('Overlapping', 2), ('Backchanneling', 8)) k(kind, low) GROUP BY 1, 2) WHERE n < low
    UNION ALL SELECT conv_id, 'repeated_backchannel', lower(text), count(*) FROM parsed WHERE turn_type = 'Backchanneling' GROUP BY 1, 3 HAVING count(*) > 2
    UNION ALL SELECT conv_id, 'overlap_target', CAST(pos AS VARCHAR), 1 FROM related WHERE turn_type = 'Overlapping' AND host_type <> 'Normal'
    UNION ALL SELECT conv_id, 'several_relations', CAST(p AS VARCHAR), count(*) FROM (SELECT conv_id, pos AS p FROM related UNION ALL SELECT conv_id, host_pos FROM related) GROUP BY 1, 3 HAVING count(*) > 1"""


def emptied_items(v: Views):
    """Reply items of which every third conversation has no text left."""
    blank = F.transform_values("item", lambda k, x: F.when((F.lower(k) == "text") & (c("conv_id") % 3 == 0), "  ").otherwise(x))
    return v.items.withColumn("item", blank)


def normalised(v: Views):
    return turns.normalise_items(v.items)


NORMALISED_SQL = f"""
    SELECT conv_id, pos, speaker, CASE WHEN pos % 23 = 0 THEN 'Normal' ELSE turn_type END AS turn_type,
           CASE WHEN turn_type <> 'Normal' THEN (SELECT CASE WHEN p.pos % 4 = 0 THEN NULL ELSE p.speaker END FROM turns_raw p WHERE p.conv_id = t.conv_id AND p.pos = t.pos - 1) END AS ref_speaker,
           CASE pos % 7 WHEN 0 THEN NULL WHEN 1 THEN 1.0::DOUBLE ELSE ratio END AS ratio, emotion, {squeeze('text')} AS text
    FROM turns_raw t WHERE pos % 19 <> 0"""


def register(q) -> None:
    bad = "(conv_id + pos) % 25"
    q(
        "scan_turns_jsonl",
        lambda v: sources.parse_turn_lines(turn_lines(v)).select(
            "conv_id", "pos", "turn_id", "speaker", "planned_start_sec", "overlaps_with", "interrupted", F.coalesce(F.size("present_keys"), F.lit(0)).alias("n_keys"), "is_bad"
        ),
        f"""SELECT conv_id, pos, CASE WHEN {bad} <> 1 THEN turn_id END AS turn_id, CASE WHEN {bad} <> 1 THEN speaker END AS speaker, CASE WHEN {bad} <> 1 THEN planned_start_sec END AS planned_start_sec,
                  CASE WHEN {bad} <> 1 THEN overlaps_with END AS overlaps_with, CASE WHEN {bad} <> 1 THEN interrupted END AS interrupted,
                  CASE WHEN {bad} = 1 THEN 0 WHEN complete THEN 14 ELSE 12 END AS n_keys, {bad} = 1 AS is_bad FROM turns_timed WHERE {bad} <> 0""",
    )
    q(
        "scan_conversation_json",
        lambda v: sources.stored_turns(stored_documents(v)).select("conv_id", "turn", "pos", "turn_id", "text"),
        """SELECT conv_id, turn, i AS pos, 't' || i AS turn_id, line AS text FROM (
               SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM conversations WHERE role <> 'system')
           UNION ALL SELECT conv_id, turn, NULL, NULL, NULL FROM conversations WHERE role = 'system'""",
    )
    clean = "regexp_replace({0}, '^[ \\t]+|[ \\t]+$', '', 'g')"
    q(
        "transcript_clean",
        lambda v: v.blobs.select("conv_id", "turn", dx.clean_transcript(c("transcript")).alias("transcript"), dx.clean_transcript(c("transcript")).isNull().alias("is_error")),
        f"""SELECT conv_id, turn, string_agg(x, chr(10) ORDER BY i) FILTER (regexp_matches(lower(replace(substr(x, 1, 4), ' ', '')), '^(s1:|s2:)')) AS transcript,
                  coalesce(string_agg(x, chr(10)) FILTER (regexp_matches(lower(replace(substr(x, 1, 4), ' ', '')), '^(s1:|s2:)')), '') = '' AS is_error
           FROM (SELECT conv_id, turn, i, {clean.format('line')} AS x FROM (SELECT conv_id, turn, unnest({LINE_SPLIT}) AS line, generate_subscripts({LINE_SPLIT}, 1) AS i FROM blobs)) GROUP BY 1, 2""",
    )
    q("tagged_line_parse", lambda v: parsed(v), "SELECT conv_id, pos, speaker, turn_type, ref_speaker, ratio, emotion, text FROM parsed")
    q("turn_normalise", normalised, NORMALISED_SQL)
    q(
        "emotion_default",
        lambda v: v.turns_full.select("conv_id", "pos", "speaker", "emotion"),
        "SELECT conv_id, pos, speaker, emotion FROM turns_full",
    )
    rate = "CASE emotion WHEN 'Sad' THEN {} WHEN 'Angry' THEN {} ELSE {} END"
    q(
        "speech_duration",
        lambda v: v.turns_full.select("conv_id", "pos", round_half_up(dx.speech_ticks(c("text"), c("emotion")) / F.lit(float(dx.TICKS_PER_SEC)), 4).alias("duration_sec")),
        f"""SELECT conv_id, pos, {rnd(f"greatest(0.6, (greatest({words('text')}, 1) / {rate.format('2.0::DOUBLE', '3.0::DOUBLE', '2.5::DOUBLE')} + greatest(length(text), 1) / {rate.format('10.4::DOUBLE', '15.6::DOUBLE', '13.0::DOUBLE')}) / 2)", 4)} AS duration_sec FROM turns_full""",
    )
    q(
        "timing_error",
        lambda v: v.turns_timed.select(
            "conv_id", "pos",
            round_half_up(dx.timing_error(c("planned_start_sec"), c("planned_end_sec"), c("real_start_sec"), c("real_end_sec")), 3).alias("error_time"),
        ),
        f"SELECT conv_id, pos, {rnd('(planned_end_sec - planned_start_sec) - (real_end_sec - real_start_sec)', 3)} AS error_time FROM turns_timed",
    )
    q(
        "relation_pairs",
        lambda v: turns.relation_pairs(v.turns_timed, quality.PAIR_COLUMNS).select("conv_id", "pos", "turn_id", "overlaps_with", "ref_overlaps_with", "ref_found"),
        f"SELECT conv_id, pos, turn_id, overlaps_with, ref_overlaps_with, found AS ref_found FROM {PAIRS}",
    )
    q(
        "ref_speaker_lookup",
        lambda v: turns.reference_speakers(turns.lower_keys(v.items)),
        "SELECT conv_id, 't' || pos AS turn_id, speaker FROM turns_raw WHERE pos % 4 <> 0",
    )
    q(
        "apply_edits",
        lambda v: turns.apply_edits(v.turns_timed.drop("present_keys"), edits_once(v)).select("conv_id", "pos", "turn_id", "text", "emotion", "turn_type"),
        EDITED_SQL.replace("edits_once", ONCE),
    )
    q(
        "faithfulness_check",
        lambda v: quality.faithfulness(v.turns_raw, faithful_turns(v)),
        f"""WITH RECURSIVE lw AS (SELECT conv_id, pos, speaker, {WORDS} AS w FROM turns_raw),
            tw AS (SELECT conv_id, CASE WHEN k = 6 THEN pos + 5000 WHEN k IN (10, 11) THEN pos + 3000 ELSE pos END AS pos, CASE WHEN k = 7 THEN CASE speaker WHEN 'speaker_1' THEN 'speaker_2' ELSE 'speaker_1' END ELSE speaker END AS speaker,
                          {WORDS.replace('text', "(CASE WHEN k = 8 THEN text || ' indeed' ELSE replace(text, ' ', ' , ') END)")} AS w
                   FROM (SELECT *, (conv_id * 3 + pos) % 17 AS k FROM turns_raw) WHERE k <> 5){FAITHFUL_SQL}""",
    )
    q(
        "simultaneous_speech",
        lambda v: overlap.simultaneous_speech(v.turns_timed),
        f"""SELECT a.conv_id, a.turn_id AS turn_a, b.turn_id AS turn_b, {rnd('least(a.planned_end_sec, b.planned_end_sec) - greatest(a.planned_start_sec, b.planned_start_sec)')} AS overlap_sec
           FROM turns_timed a JOIN turns_timed b ON a.conv_id = b.conv_id AND a.pos < b.pos AND a.speaker <> b.speaker AND a.planned_start_sec < b.planned_end_sec AND b.planned_start_sec < a.planned_end_sec
           WHERE a.planned_end_sec > a.planned_start_sec AND b.planned_end_sec > b.planned_start_sec""",
    )
    q(
        "turn_type_counts",
        lambda v: quality.turn_type_counts(v.turns_timed),
        f"""SELECT conv_id, turn_type, n, {rnd('n * 100.0::DOUBLE / greatest(total, 1)', 1)} AS share_pct FROM (
               SELECT conv_id, turn_type, n, sum(n) OVER (PARTITION BY conv_id) AS total FROM (
                   SELECT t.conv_id, k.kind AS turn_type, count(*) FILTER (t.turn_type = k.kind) AS n FROM turns_timed t, (VALUES ('Normal'), ('Overlapping'), ('Interruption'), ('Backchanneling')) k(kind) GROUP BY 1, 2))""",
    )
    q(
        "turn_type_tally",
        lambda v: quality.turn_type_tally(v.turns_timed.withColumn("turn_type", F.when(c("pos") % 7 == 1, "").when(c("pos") % 7 > 0, c("turn_type")))),
        "SELECT conv_id, CASE WHEN pos % 7 > 1 THEN turn_type ELSE 'Unknown' END AS turn_type, count(*) AS n FROM turns_timed GROUP BY 1, 2",
    )
    q(
        "usable_turns",
        lambda v: turns.usable_conversations(emptied_items(v), turns.normalise_items(emptied_items(v))),
        f"SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN 0 ELSE n END AS n_usable, conv_id % 3 = 0 AS is_error FROM (SELECT conv_id, count(*) AS n FROM ({NORMALISED_SQL}) GROUP BY 1)",
    )
    q("conversation_duration", lambda v: quality.conversation_duration(v.turns_timed).select("conv_id", round_half_up(c("duration_sec"), 2).alias("duration_sec")),
      f"SELECT conv_id, {rnd('max(planned_end_sec) - min(planned_start_sec)')} AS duration_sec FROM turns_timed GROUP BY 1")
    q(
        "validation_report",
        lambda v: quality.validation_report(v.table("conversations").select(F.floor(c("conv_id") / 5).cast("bigint").alias("conv_id")), v.turns_timed, all_issues(v)),
        f"""SELECT d.conv_id, coalesce(n, 0) AS n_turns, CASE WHEN n IS NULL THEN 1 ELSE coalesce(e, 0) END AS n_errors, coalesce(w, 0) AS n_warnings, CASE WHEN n IS NULL THEN TRUE ELSE coalesce(e, 0) > 0 END AS has_errors
           FROM (SELECT DISTINCT conv_id // 5 AS conv_id FROM conversations) d LEFT JOIN (SELECT conv_id, count(*) AS n FROM turns_timed GROUP BY 1) USING (conv_id)
           LEFT JOIN (SELECT conv_id, count(*) FILTER (level = 'ERROR') AS e, count(*) FILTER (level = 'WARNING') AS w FROM ({ALL_SQL}) GROUP BY 1) USING (conv_id)""",
    )
    q(
        "ordered_issue_list",
        lambda v: quality.ordered_issues(all_issues(v)).select(*ISSUE, "issue_no"),
        f"""SELECT conv_id, pos, turn_id, level, rule, message, row_number() OVER (PARTITION BY conv_id ORDER BY CASE level WHEN 'ERROR' THEN 0 ELSE 1 END, pos, turn_id, rule, message) AS issue_no FROM ({ALL_SQL})""",
    )
    q(
        "turn_ids",
        lambda v: turns.renumber(normalised(v)).select("conv_id", "pos", "turn_id", "text"),
        f"SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS pos, 't' || row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS turn_id, text FROM ({NORMALISED_SQL})",
    )
    q("assemble_timeline", lambda v: assembled(v).select("conv_id", "pos", *FIELDS14), ASSEMBLE_SQL)
    q("repaired_turns", repaired, REPAIR_SQL)
    q(
        "scale_to_target",
        lambda v: turns.scale_to_target(
            assembled(v), v.turns_full.select("conv_id", (200 + (c("conv_id") * 97) % 400).cast("double").alias("target_sec")).distinct()
        ).select("conv_id", "pos", "planned_start_sec", "planned_end_sec"),
        SCALED_SQL,
    )
    q(
        "join_ratio_recover",
        lambda v: turns.recover_ratio(v.turns_timed).select("conv_id", "pos", "ref_speaker", round_half_up(c("ratio"), 4).alias("ratio")),
        f"""SELECT t.conv_id, t.pos, CASE WHEN t.turn_type IN ('Overlapping', 'Interruption', 'Backchanneling') THEN r.speaker END AS ref_speaker,
                  CASE WHEN t.turn_type IN ('Overlapping', 'Backchanneling') AND r.planned_end_sec > r.planned_start_sec
                       THEN {rnd('least(greatest((t.planned_start_sec - r.planned_start_sec) / (r.planned_end_sec - r.planned_start_sec), 0.0::DOUBLE), 1.0::DOUBLE)', 4)} END AS ratio
           FROM turns_timed t LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY conv_id, turn_id ORDER BY pos DESC) AS rn FROM turns_timed) r
             ON r.conv_id = t.conv_id AND r.turn_id = t.overlaps_with AND r.rn = 1""",
    )
    q("qa_required_fields", lambda v: quality.qa_required_fields(v.turns_timed).select(*ISSUE), ROW_SQL["required_fields"])
    q("qa_duplicate_id", lambda v: quality.qa_duplicate_id(v.turns_timed).select(*ISSUE), ROW_SQL["duplicate_id"])
    for rule in ("enum_values", "planned_times", "overlap_both_or_none", "interrupted_consistency"):
        q(f"qa_{rule}", lambda v, rule=rule: quality.qa_rows(v.turns_timed, [rule]).select(*ISSUE), ROW_SQL[rule])
    for rule, sql in PAIR_SQL.items():
        q(f"qa_{rule}", lambda v, rule=rule: quality.qa_pairs(v.turns_timed, [rule]).select(*ISSUE), sql)
    q("qa_total_duration", lambda v: quality.qa_conversations(v.turns_timed, ["total_duration"]).select(*ISSUE), CONV_SQL["total_duration"])
    q("qa_min_overlap_counts", lambda v: quality.qa_conversations(v.turns_timed, ["min_overlap_counts"], minimum=12).select(*ISSUE), CONV_SQL["min_overlap_counts"])
    q("validate_turns", lambda v: all_issues(v).select(*ISSUE), ALL_SQL)
    q("qa_transcript_minimums", lambda v: quality.transcript_minimums(parsed(v)), MINIMUM_SQL)
