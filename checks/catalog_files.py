"""Assembly of scripts, published files and uploads."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import catalog_turns as ct
from checks.views import Views, cat
from checks.views_sql import rnd
from duologue.functions import fixed_values as fv
from duologue.operators import assembly, quality, requests
from duologue.operators.planning import INSTANCE
from duologue.plans import publish

c = F.col
USERS = ["user1", "user2"]


def layout(v: Views):
    """Accepted conversations with everything their documents show."""
    month = (F.year("finished_at") * 100 + F.month("finished_at")).cast("string")
    return v.accepted_indexed.join(v.corpus.drop("duration_sec", "row_pos"), INSTANCE).select(
        INSTANCE, "index", "title", "language", "agent_emotion", "user_emotion", "agent_accent", "user_accent", "gender_pair", "duration_sec", "finish_key",
        cat("in ", month).alias("context"),
        F.when(c("finish_key") % 3 > 0, "advice").alias("conversation_type"),
        F.lit(True).alias("passed"),
        (c("finish_key") % 2 == 0).alias("include_numbers"),
        publish.run_id(c("finished_at"), c(INSTANCE), c("index"), c("finish_key")).alias("run_id"),
        F.when(c("finish_key") % 7 > 0, c("title")).alias("transcript"),
    )


LAYOUT = """
    (SELECT a.corpus_combination_id, a."index", a.title, c.language, c.agent_emotion, c.user_emotion, c.agent_accent, c.user_accent, c.gender_pair, a.duration_sec, a.finish_key,
            'in ' || strftime(a.finished_at, '%Y%m') AS context, CASE WHEN finish_key % 3 > 0 THEN 'advice' END AS conversation_type, finish_key % 2 = 0 AS include_numbers,
            strftime(a.finished_at, '%Y%m%d_%H%M%S') || '_corpus' || a.corpus_combination_id || '_conv' || CASE WHEN length(CAST(a."index" AS VARCHAR)) >= 4 THEN CAST(a."index" AS VARCHAR) ELSE lpad(CAST(a."index" AS VARCHAR), 4, '0') END || '_' || substr(sha1(CAST(finish_key AS VARCHAR)), 1, 8) AS run_id,
            CASE WHEN finish_key % 7 > 0 THEN a.title END AS transcript
     FROM accepted a JOIN corpus c USING (corpus_combination_id))"""


def pad(x: str) -> str:
    return f"CASE WHEN length(CAST({x} AS VARCHAR)) >= 4 THEN CAST({x} AS VARCHAR) ELSE lpad(CAST({x} AS VARCHAR), 4, '0') END"


def payload(v: Views):
    """Stored documents of the laid-out conversations, number = instance."""
    documents = requests.turn_documents(v.turns_timed, ["turn_id", "speaker", "turn_type", "overlaps_with", "interrupted"])
    heads = layout(v).withColumn("conv_id", c(INSTANCE)).withColumn("duration_sec", c("duration_sec").cast("double"))
    return publish.payloads(heads, documents)


def sidecar_input(v: Views):
    stats = quality.conversation_stats(v.turns_timed).drop("duration_sec", "n_turns")
    one = layout(v)
    k = c(INSTANCE) % 4
    tally = quality.turn_type_tally(v.turns_timed.withColumn("turn_type", F.when(c("pos") % 7 > 0, c("turn_type"))))
    listed = tally.groupBy(c("conv_id").alias("_conv")).agg(F.collect_list(F.struct("turn_type", "n")).alias("type_counts"))
    return one.join(stats, one[INSTANCE] == stats["conv_id"]).join(listed, c("conv_id") == c("_conv")).select(
        one["*"], *fv.TURN_TYPES, F.when(k > 0, c("duration_sec") + 10).alias("target_sec"), k.alias("generation_attempts"), F.when(k > 1, k).alias("format_attempts"),
        F.when(k != 2, "PASS").alias("content_verdict"), F.when(k == 3, "FAIL").alias("format_verdict"),
        F.lit(3).alias("max_generation_attempts"), F.when(k > 0, 3).alias("max_format_attempts"), (k + 1).alias("content_checks"), (k > 2).alias("content_bypassed"),
        F.when(k > 0, k == 1).alias("format_exhausted"), k.alias("realism_score"), F.when(k == 1, 9).alias("corpus_match_score"), "type_counts",
        F.when(k > 0, F.create_map(F.lit("language"), k == 1, F.lit("agent_accent"), F.when(k < 3, True))).alias("field_matches"),
        F.when(k > 0, F.lit("ok")).alias("content_feedback"), F.lit("t2 differs").alias("format_feedback"),
    )


def wav_files(v: Views):
    """Heads of 16 kHz files as long as the manifest says, some with a list chunk before the data or sizes never filled in."""
    little = lambda n: F.concat(*[F.substring(F.lpad(F.hex(n), 8, "0"), i, 2) for i in (7, 5, 3, 1)])
    size = F.round(c("duration") * 16000).cast("bigint") * 2
    kind = F.pmod(F.crc32(c("path").cast("binary")), F.lit(3))
    fmt = F.lit("666D7420" + "10000000" + "01000100" + "803E0000" + "007D0000" + "02001000")
    extra = F.when(kind == 1, "4C495354" + "03000000" + "61626300").otherwise("")
    shown = F.when(kind == 2, F.lit(0xFFFFFFFF)).otherwise(size)
    hexed = F.concat(F.lit("52494646"), little(size + 36), F.lit("57415645"), fmt, extra, F.lit("64617461"), little(shown))
    made = assembly.manifest(v.scheduled, USERS).select("path", size.alias("size"), F.unhex(hexed).alias("content"))
    return made.select(cat("out/audio/", c("path")).alias("path"), (F.octet_length("content") + c("size")).alias("length"), "content")


def spilled(v: Views):
    """Segments of the output channels, some of them in the other one's."""
    placed = assembly.output_channels(assembly.segments(v.scheduled, USERS))
    other = F.when(c("channel") == "main", "user").otherwise("main")
    return placed.withColumn("channel", F.when(c("pos") % 29 == 3, other).otherwise(c("channel")))


def line(label: str, x: str) -> str:
    return f"'{label}: ' || {x}"


def txt(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), '')"


def dec(x: str) -> str:
    return f"coalesce(CAST(CAST({x} AS DECIMAL(18,2)) AS VARCHAR), 'None')"


SIDECAR = ", ".join([
    line("run_id", "run_id"), line("corpus_combination_id", txt("corpus_combination_id")), line("conversation_index", txt('"index"')), "'passed: true'", line("include_numbers", txt("include_numbers")),
    "chr(10) || '## Topic'", *[line(n, txt(n)) for n in ("title", "conversation_type", "context")],
    "chr(10) || '## Profile'", *[line(n, txt(n)) for n in ("language", "gender_pair", "agent_emotion", "user_emotion", "agent_accent", "user_accent")],
    "chr(10) || '## Duration'", line("duration_sec", dec("duration_sec")), line("duration_min", dec(rnd("duration_sec / 60.0::DOUBLE"))),
    line("target_duration_sec", dec("target_sec")), line("target_duration_min", dec(rnd("target_sec / 60.0::DOUBLE"))),
    "chr(10) || '## Turn counts'", "'total_turns: ' || (n1 + n2 + n3 + n4)", "'backchannel_count: ' || n4", "'overlap_count: ' || n2", "'interruption_count: ' || n3", "'normal_count: ' || n1", "types",
    "chr(10) || '## Retries'", "'generation_attempts_used: ' || k || ' of 3'", "'format_attempts_used: ' || CASE WHEN k > 1 THEN k ELSE 0 END || ' of ' || CASE WHEN k > 0 THEN '3' ELSE 'None' END",
    "'content_checks_used: ' || (k + 1) || ' of None'", "'format_checks_used: 0 of None'",
    "'generation_retries: ' || greatest(0, k - 1)", "'format_retries: ' || CASE WHEN k > 1 THEN k - 1 ELSE 0 END",
    "'content_bypassed: ' || (k > 2)", "'format_bypassed: false'", "'format_exhausted: ' || (k = 1)",
    "chr(10) || '## Content validation'", "'verdict: ' || CASE WHEN k <> 2 THEN 'PASS' ELSE 'none given' END",
    "CASE WHEN k <> 2 THEN 'realism_score: ' || k END", "CASE WHEN k = 1 THEN 'corpus_match_score: 9' END",
    "CASE WHEN k IN (1, 3) THEN '  agent_accent: ' || CASE WHEN k < 3 THEN 'true' ELSE 'None' END || chr(10) || '  language: ' || (k = 1) END", "CASE WHEN k IN (1, 3) THEN 'feedback: ok' END",
    "chr(10) || '## Format validation'", "'verdict: ' || CASE WHEN k = 3 THEN 'FAIL' ELSE 'none given' END", "CASE WHEN k = 3 THEN 'feedback: t2 differs' END",
])
TALLY_SQL = """(SELECT conv_id, string_agg('  ' || turn_type || ': ' || n, chr(10) ORDER BY turn_type) AS types FROM (
    SELECT conv_id, coalesce(CASE WHEN pos % 7 > 0 THEN turn_type END, 'Unknown') AS turn_type, count(*) AS n FROM turns_timed GROUP BY 1, 2) GROUP BY 1)"""


def register(q) -> None:
    # ---- assembly ----
    q(
        "load_script_rows",
        lambda v: v.scripts.select("doc_id", F.when(c("drop_reason").isNull(), c("conversation_id")).alias("conversation_id"), "drop_reason", F.when(c("drop_reason").isNull(), F.size("turns")).alias("n_turns")),
        "SELECT doc_id, CASE WHEN drop_reason IS NULL THEN conversation_id END AS conversation_id, drop_reason, CASE WHEN drop_reason IS NULL THEN n_turns END AS n_turns FROM scripts",
    )
    q("production_report", lambda v: assembly.production_report(v.scripts), "SELECT count(*) FILTER (drop_reason IS NULL) AS num_produced, count(*) FILTER (drop_reason IS NOT NULL) AS num_dropped FROM scripts")
    q(
        "script_schedule",
        lambda v: v.scheduled.drop("language"),
        'SELECT conversation_id, pos, speaker, text, gap, overlap, duration, "start", "end" FROM scheduled',
    )
    q("heuristic_word_alignment", lambda v: assembly.align_words(v.clip_turns), 'SELECT conversation_id, pos, word_no, speaker, word, "start", "end" FROM clip_words')
    q("alignment_merge", lambda v: v.merged_words, 'SELECT conversation_id, pos, word_no, speaker, word, "start", "end", seq FROM merged_words')
    q(
        "channel_swap_variants",
        lambda v: assembly.channel_variants(v.merged_words, USERS).select("variant", "seq", "word", "start", "end", "label"),
        """SELECT conversation_id || '__' || m || '_agent' AS variant, seq, word, "start", "end", CASE WHEN speaker = m THEN 'SPEAKER_MAIN' ELSE 'SPEAKER_OTHER' END AS label
           FROM merged_words, (VALUES ('user1'), ('user2')) x(m)""",
    )
    nothing = lambda kind: F.lit(None).cast(kind)
    q(
        "segments_transcripts",
        lambda v: assembly.segments(v.scheduled, USERS)
        .select("variant", "label", "speaker", "start", "end", nothing("bigint").alias("part"), nothing("string").alias("transcript"))
        .unionByName(
            assembly.merged_transcripts(v.scheduled, USERS).select(
                "variant", "label", nothing("string").alias("speaker"), nothing("double").alias("start"), nothing("double").alias("end"), "part", "transcript"
            )
        ),
        """SELECT conversation_id || '__' || m || '_agent' AS variant, CASE WHEN speaker = m THEN 'SPEAKER_MAIN' ELSE 'SPEAKER_OTHER' END AS label, speaker, "start", "end", CAST(NULL AS BIGINT) AS part, CAST(NULL AS VARCHAR) AS transcript
           FROM scheduled, (VALUES ('user1'), ('user2')) x(m)
           UNION ALL SELECT conversation_id || '__' || m || '_agent', CASE WHEN speaker = m THEN 'SPEAKER_MAIN' ELSE 'SPEAKER_OTHER' END, NULL, NULL, NULL, (seq - 1) // 10000, string_agg(word, ' ' ORDER BY seq)
           FROM merged_words, (VALUES ('user1'), ('user2')) x(m) GROUP BY 1, 2, 6""",
    )
    q(
        "manifest_rows",
        lambda v: assembly.manifest(v.scheduled, USERS),
        f"""SELECT conversation_id || '__' || m || '_agent.wav' AS path, {rnd('d', 3)} AS duration FROM (SELECT conversation_id, max("end") AS d FROM scheduled GROUP BY 1), (VALUES ('user1'), ('user2')) x(m)""",
    )
    q(
        "manifest_from_files",
        lambda v: assembly.manifest_of_files(wav_files(v)),
        f"""SELECT conversation_id || '__' || m || '_agent.wav' AS path, {rnd('d', 3)} AS duration FROM (SELECT conversation_id, max("end") AS d FROM scheduled GROUP BY 1), (VALUES ('user1'), ('user2')) x(m)""",
    )
    q(
        "crosstalk_purity",
        lambda v: assembly.crosstalk_purity(spilled(v)),
        f"""SELECT variant, m AS main_crosstalk, u AS user_crosstalk, m = 0 AND u = 0 AS pass, NOT (m = 0 AND u = 0) AS quarantined FROM (
               SELECT variant, {rnd("coalesce(sum(d) FILTER (main AND wrong) / nullif(sum(d) FILTER (main), 0), 0)", 6)} AS m,
                      {rnd("coalesce(sum(d) FILTER (NOT main AND wrong) / nullif(sum(d) FILTER (NOT main), 0), 0)", 6)} AS u FROM (
                   SELECT conversation_id || '__' || m || '_agent' AS variant, (speaker = m) <> (pos % 29 = 3) AS main, pos % 29 = 3 AS wrong, CAST(CAST("end" - "start" AS DECIMAL(28,6)) AS DOUBLE) AS d
                   FROM scheduled, (VALUES ('user1'), ('user2')) x(m)) GROUP BY 1)""",
    )
    # ---- sinks ----
    q(
        "sink_path_conversation",
        lambda v: layout(v).select(INSTANCE, "index", publish.conversation_path(F.when(c("finish_key") % 5 > 0, cat(" ", c("language"), " ")), c(INSTANCE), c("index")).alias("path")),
        f"""SELECT corpus_combination_id, "index", CASE WHEN finish_key % 5 > 0 THEN lower(language) ELSE 'unknown' END || '/instance_' || {pad('corpus_combination_id')} || '/conversation_' || {pad('"index"')} || '.json' AS path FROM {LAYOUT}""",
    )
    q(
        "dev_output_layout",
        lambda v: publish.dev_files(layout(v)).select("path", "file", "run_id"),
        f"""SELECT lower(language) || '/' || run_id || '/' || file AS path, file, run_id FROM {LAYOUT}, (VALUES ('conversation.json'), ('metadata.txt'), ('transcript.txt')) x(file)
            WHERE file <> 'transcript.txt' OR transcript IS NOT NULL""",
    )
    quoted = lambda k, x: f"""'"{k}":"' || {x} || '"'"""
    opt = lambda k, x: f"CASE WHEN {x} IS NOT NULL THEN {quoted(k, x)} END"
    turn = """'{"turn_id":"' || turn_id || '","speaker":"' || speaker || '","turn_type":"' || turn_type || '","overlaps_with":' || coalesce('"' || overlaps_with || '"', 'null') || ',"interrupted":' || interrupted || '}'"""
    q(
        "conversation_payload",
        payload,
        f"""SELECT corpus_combination_id, "index", lower(language) AS language,
                  '{{"corpus_combination_id":' || corpus_combination_id || ',"index":' || "index" || ',"profile":{{' || concat_ws(',', {', '.join(opt(k, k) for k in ("language", "agent_emotion", "user_emotion", "agent_accent", "user_accent", "gender_pair"))}) ||
                  '}},"topic":{{' || concat_ws(',', {quoted("title", "title")}, {quoted("context", "context")}, {opt("conversation_type", "conversation_type")}) ||
                  '}},"duration_sec":' || CAST(CAST(duration_sec AS DECIMAL(18,1)) AS VARCHAR) || ',"passed":true,"include_numbers":' || include_numbers || ',"turns":[' || t.turns || ']}}' AS body
           FROM {LAYOUT} c JOIN (SELECT conv_id, string_agg({turn}, ',' ORDER BY pos) AS turns FROM turns_timed GROUP BY 1) t ON t.conv_id = c.corpus_combination_id""",
    )
    q(
        "metadata_sidecar",
        lambda v: publish.sidecar(sidecar_input(v)),
        f"""SELECT corpus_combination_id, "index", concat_ws(chr(10), {SIDECAR}) AS metadata FROM (
               SELECT l.*, s."Normal" AS n1, s."Overlapping" AS n2, s."Interruption" AS n3, s."Backchanneling" AS n4, l.corpus_combination_id % 4 AS k, CASE WHEN l.corpus_combination_id % 4 > 0 THEN l.duration_sec + 10 END AS target_sec, y.types
               FROM {LAYOUT} l JOIN {ct.STATS} s ON s.conv_id = l.corpus_combination_id JOIN {TALLY_SQL} y ON y.conv_id = l.corpus_combination_id)""",
    )
    # ---- uploads ----
    q("remote_relative_listing", lambda v: v.remote_relative, "SELECT path FROM remote_relative")
    q("upload_plan", lambda v: publish.upload_plan(v.local_files, v.remote_relative).orderBy("path"), "SELECT path FROM local_files WHERE path NOT IN (SELECT path FROM remote_relative) ORDER BY 1")
    q(
        "upload_batches",
        lambda v: publish.upload_batches(publish.upload_plan(v.local_files, v.remote_relative)),
        "SELECT path, row_number() OVER (ORDER BY path) AS file_no, (row_number() OVER (ORDER BY path) - 1) // 100 AS batch_no FROM local_files WHERE path NOT IN (SELECT path FROM remote_relative)",
    )
    q(
        "local_copy_plan",
        lambda v: publish.copy_plan(v.local_files, v.remote_relative).unionByName(publish.copy_plan(v.local_files, v.local_files, same_place=True)),
        "SELECT count(*) AS n_files, 'copy' AS action FROM local_files WHERE path NOT IN (SELECT path FROM remote_relative) UNION ALL SELECT count(*), 'count' FROM local_files",
    )
