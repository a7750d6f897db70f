"""Requests, replies and usage."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.views import Views, cat, json_string, text_of
from checks.views_sql import quote
from duologue.functions import fixed_values as fv
from duologue.operators import planning, replies, requests, usage
from duologue.operators.planning import INSTANCE

c = F.col
HIDDEN3 = ["turn_id", "speaker", "text", "emotion", "turn_type"]


def bodies(v: Views):
    return replies.extract_json(v.replies).select("doc_id", "body")


def turn_replies(v: Views):
    """Formatter replies of several shapes, one for each message: its lines are the turns."""
    spoken = v.table("conversations").where("role <> 'system'")
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(F.lit("S2").alias("Speaker"), x.alias("Text"), F.lit(None).cast("string").alias("emotion")))
    listed = F.to_json(lines, {"ignoreNullFields": "false"})
    shape = (c("conv_id") + c("turn")) % 5
    body = (
        F.when(shape == 0, cat('{"note":["x"],"turns":', listed, "}"))
        .when(shape == 1, listed)
        .when(shape == 2, cat('{"note":"x","Result":', listed, "}"))
        .when(shape == 3, cat('{"note":', F.to_json(F.struct("text")), "}"))
        .otherwise("[]")
    )
    return spoken.select("conv_id", "turn", body.alias("body"))


TURN_ITEMS_SQL = """
    SELECT conv_id, turn, CASE WHEN shape < 3 THEN i END AS pos, CASE WHEN shape < 3 THEN line END AS text, CASE WHEN shape < 3 THEN 'S2' END AS speaker, FALSE AS has_emotion, shape >= 3 AS is_error FROM (
        SELECT *, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM (
            SELECT *, (conv_id + turn) % 5 AS shape FROM conversations WHERE role <> 'system')) WHERE shape < 3 OR i = 1"""


def verdicts(v: Views):
    return replies.content_verdicts(bodies(v))


MISSED = """array_to_string(list_filter([CASE WHEN NOT m_language THEN 'language' END, CASE WHEN NOT m_agent_emotion THEN 'agent_emotion' END, CASE WHEN NOT m_user_emotion THEN 'user_emotion' END,
    'agent_accent', 'user_accent', 'gender_pair', 'conversation_type', 'topic_relevance'], lambda x: x IS NOT NULL), ', ')"""


def requests_input(v: Views):
    """One request per corpus row, with a topic from the latest accepted conversation."""
    latest = v.accepted.groupBy(INSTANCE).agg(F.max_by("title", "finish_key").alias("title"))
    return v.corpus.join(latest, INSTANCE).join(planning.topic_slots(v.topics, v.ORDER), INSTANCE).select(
        "*",
        cat("about ", c("title")).alias("context"),
        F.when(c(INSTANCE) % 3 > 0, "advice").alias("conversation_type"),
        c("duration_sec").alias("target_sec"),
        (c(INSTANCE) % 2 == 0).alias("include_numbers"),
        F.when(c(INSTANCE) % 4 == 0, cat("fix ", c("title"))).alias("feedback"),
        F.when(c(INSTANCE) % 8 == 0, "S1: [normal] hello (Neutral)").alias("previous"),
        cat("S1: [normal] ", c("title"), " (Neutral)").alias("transcript"),
        cat('[{"turn_id":"t1","text":', json_string(c("title")), "}]").alias("turns_json"),
        F.lit("- (major) [t1] x").alias("issues_text"),
    )


REQUEST_INPUT = """
    (SELECT c.*, l.title, 'about ' || l.title AS context, CASE WHEN c.corpus_combination_id % 3 > 0 THEN 'advice' END AS conversation_type, c.corpus_combination_id % 2 = 0 AS include_numbers,
            CASE WHEN c.corpus_combination_id % 4 = 0 THEN 'fix ' || l.title END AS feedback, CASE WHEN c.corpus_combination_id % 8 = 0 THEN 'S1: [normal] hello (Neutral)' END AS previous,
            'S1: [normal] ' || l.title || ' (Neutral)' AS transcript, '[{"turn_id":"t1","text":"' || l.title || '"}]' AS turns_json
     FROM corpus c JOIN (SELECT corpus_combination_id, arg_max(title, finish_key) AS title FROM accepted GROUP BY 1) l USING (corpus_combination_id))"""
DOMAINS_SQL = "[" + ", ".join(quote(x) for x in fv.TOPIC_DOMAINS) + "]"
TOPICS_SQL = """(SELECT corpus_combination_id, finish_key, title, CASE WHEN finish_key % 3 > 0 THEN 'advice' ELSE 'unknown' END AS kind, finish_key % 7 = 0 AS resumed,
    row_number() OVER (PARTITION BY corpus_combination_id ORDER BY finished_at, finish_key) AS pos FROM accepted)"""
DRAWN_SQL = f"list_sort(list_transform({DOMAINS_SQL}, lambda d: struct_pack(h := sha256(corpus_combination_id || '/' || d), d := d)))[CAST(({{0}}) % {len(fv.TOPIC_DOMAINS)} AS BIGINT) + 1].d"
SLOTS_SQL = f"""(SELECT corpus_combination_id, history, {DRAWN_SQL.format('n')} AS domain FROM (
    SELECT corpus_combination_id, string_agg(title || ' (' || kind || ')', chr(10) ORDER BY pos) AS history, max(pos) - coalesce(max(pos) FILTER (resumed), 0) AS n FROM {TOPICS_SQL} GROUP BY 1))"""


def given(label: str, x: str) -> str:
    return f"CASE WHEN coalesce({x}, '') <> '' THEN '{label}: ' || {x} END"


def block(title: str, x: str) -> str:
    return f"CASE WHEN coalesce({x}, '') <> '' THEN chr(10) || '## {title}' || chr(10) || {x} END"


PROFILE = [given("speaker_1 emotion", "agent_emotion"), given("speaker_2 emotion", "user_emotion"), given("speaker_1 accent", "agent_accent"), given("speaker_2 accent", "user_accent"), given("genders", "gender_pair")]
_markers = " ".join(f"WHEN {quote(k)} THEN {quote(x)}" for k, x in fv.ACCENT_MARKERS.items())
_marker = f"(CASE WHEN lower(language) = 'english' THEN CASE WHEN lower({{0}}) <> 'normal' THEN {quote(fv.ENGLISH_ACCENT_NOTE)} END ELSE CASE lower({{0}}) {_markers} END END)"
_accents = "concat_ws(chr(10), '- speaker_1 (' || agent_accent || '): ' || " + _marker.format("agent_accent") + ", '- speaker_2 (' || user_accent || '): ' || " + _marker.format("user_accent") + ")"
_directive = "(CASE lower(language) " + " ".join(f"WHEN {quote(k)} THEN {quote(x)}" for k, x in fv.LANGUAGE_DIRECTIVES.items()) + " END)"
_genders = "(CASE regexp_extract_all(lower(gender_pair), '[mf]')[{0}] WHEN 'm' THEN 'Male' WHEN 'f' THEN 'Female' END)"
_pace = "CAST(CAST(floor(duration_sec + 0.5) AS BIGINT) AS VARCHAR) || ' seconds, ' || greatest(24, CAST(floor(duration_sec / 7) AS BIGINT)) || ' turns, ' || CAST(floor(duration_sec * 2.5) AS BIGINT) || ' words'"
_both = "CASE WHEN feedback IS NOT NULL AND previous IS NOT NULL THEN {0} END"
PROMPT_SQL = {
    "topic": ["'Propose one conversation topic.'", given("language", "language"), given("area", "domain"), "CASE WHEN include_numbers THEN 'Concrete numbers should come up.' ELSE 'Keep it qualitative.' END", *PROFILE, block("Used topics", "history"), "'Reply with one JSON object: \"title\", \"context\".'"],
    "generator": ["'Write a two-speaker conversation in the tagged line format.'", given("title", "title"), given("context", "context"), given("language", "language"), block("Language", _directive), given("type", "conversation_type"), *PROFILE,
                  block("Accents", _accents), block("Target length", _pace), "CASE WHEN include_numbers THEN 'Use concrete numbers.' ELSE 'Keep it qualitative.' END",
                  block("Feedback to fix", _both.format("feedback")), block("Previous transcript", _both.format("previous")), "'Reply with transcript lines only.'"],
    "content_judge": ["'Judge the transcript against the required attributes.'", given("language", "language"), given("type", "conversation_type"), *PROFILE, given("title", "title"), given("context", "context"), block("Transcript", "transcript"), "'Reply with one JSON object.'"],
    "format_judge": ["'Check that the turns are a faithful conversion of the transcript.'", block("Transcript", "transcript"), block("Turns", "turns_json"), "'Reply with one JSON object.'"],
    "editor": ["'Fix the listed issues by editing only the affected turns.'", given("language", "language"), given("speaker_1 gender", _genders.format(1)), given("speaker_2 gender", _genders.format(2)), *PROFILE[:4],
               block("Transcript", "transcript"), block("Issues", "'- (major) [t1] x'"), block("Feedback", "feedback"), block("Turns", "turns_json"), "'Reply with one JSON edit patch.'"],
}


def all_prompts(v: Views):
    rows = requests_input(v)
    merged = None
    for kind in requests.PROMPTS:
        part = requests.prompt_table(rows, kind, INSTANCE)
        merged = part if merged is None else merged.unionByName(part)
    return merged


def scored(v: Views):
    rows = requests.prompt_table(requests_input(v), "generator", INSTANCE)

    # Nested, so that it travels to the Python workers by value.
    def make_echo():
        """A stand-in model: fails on some prompts, answers the others."""

        def answer(prompt: str) -> str:
            if "Normal" in prompt:
                raise RuntimeError("HTTP 429 too many requests")
            return f'{{"chars": {len(prompt)}}}'

        return answer

    done = usage.score_rows(rows, make_echo, INSTANCE, "prompt")
    return done.select(INSTANCE, "reply", "error_type", usage.limit_error(F.lit(None).cast("int"), c("error_type"), c("error")).alias("is_limit"))


def patches(v: Views):
    """Edit patches built from documents: a dict, a list, one edit, or a list under another key."""
    edit = lambda n, rest: cat('{"turn_id":" t', text_of(c("doc_id") % 50 + n), ' ","', rest)
    one = edit(1, cat('action":"REPLACE","text":', json_string(c("text")), ',"emotion":null}'))
    two = edit(2, cat('Action":"delete","text":"x"}'))
    three = edit(3, cat('action":"zap","turn_type":"overlap"}'))
    blank = F.lit('{"turn_id":"  ","text":"y"}')
    listed = cat("[", one, ",", two, ",", three, ",", blank, ",7]")
    k = c("doc_id") % 4
    return v.table("documents").select(
        "doc_id",
        F.when(k == 0, cat('{"edits":', listed, "}")).when(k == 1, listed).when(k == 2, one).otherwise(cat('{"patch":', listed, ',"note":"n"}')).alias("body"),
    )


def topic_bodies(v: Views):
    k = c("doc_id") % 4
    return v.table("documents").select(
        "doc_id",
        F.when(k == 0, cat('[{"title":" ', c("source"), ' ","context":', json_string(c("text")), "}]"))
        .when(k == 1, cat('{"title":"", "context":', json_string(c("text")), "}"))
        .otherwise(cat('{"title":"', c("lang"), '"}'))
        .alias("body"),
    )


def register(q) -> None:
    q(
        "prompt_compile",
        lambda v: v.table("documents").select(
            "doc_id",
            requests.compile_template(cat("{{lang}}: {{ text }} ({{  source}}) {{other}}"), {"lang": c("lang"), "text": c("text"), "source": c("source")}).alias("prompt"),
        ),
        "SELECT doc_id, lang || ': ' || text || ' (' || source || ') {{other}}' AS prompt FROM documents",
    )
    q(
        "prompt_table",
        all_prompts,
        " UNION ALL ".join(f"SELECT corpus_combination_id, '{k}' AS kind, concat_ws(chr(10), {', '.join(parts)}) AS prompt FROM {REQUEST_INPUT} JOIN {SLOTS_SQL} USING (corpus_combination_id)" for k, parts in PROMPT_SQL.items()),
    )
    q(
        "domain_draw",
        lambda v: planning.drawn_domains(v.topics, v.ORDER).select(INSTANCE, "finish_key", "pos", "domain"),
        f"""SELECT corpus_combination_id, finish_key, pos, CASE WHEN NOT resumed THEN {DRAWN_SQL.format('pos - since - 1')} END AS domain FROM (
               SELECT *, coalesce(max(CASE WHEN resumed THEN pos END) OVER (PARTITION BY corpus_combination_id ORDER BY pos), 0) AS since FROM {TOPICS_SQL})""",
    )
    q(
        "reply_json_extract",
        lambda v: replies.extract_json(v.replies).select("doc_id", "needs_retry", "body"),
        "SELECT doc_id, body IS NULL AS needs_retry, body FROM bodies",
    )
    q(
        "content_verdict_normalise",
        lambda v: verdicts(v).select(
            "doc_id", "is_error", "verdict", "realism_score", "corpus_match_score",
            F.element_at("field_matches", "language").alias("m_language"), F.element_at("field_matches", "agent_emotion").alias("m_agent_emotion"),
            F.element_at("field_matches", "user_emotion").alias("m_user_emotion"), F.element_at("field_matches", "topic_relevance").alias("m_topic"),
            F.array_join("strengths", "|").alias("strengths"), F.size("issues").alias("n_issues"),
            F.try_element_at("issues", F.lit(1))["severity"].alias("severity"), F.try_element_at("issues", F.lit(1))["turn_ref"].alias("turn_ref"), "feedback",
        ),
        """SELECT doc_id, is_error, verdict, realism_score, corpus_match_score, m_language, m_agent_emotion, m_user_emotion, FALSE AS m_topic, coalesce(strength, '') AS strengths,
                  CASE WHEN is_error THEN 0 ELSE 1 END AS n_issues, severity, turn_ref, feedback FROM verdict_fields""",
    )
    q(
        "format_verdict_normalise",
        lambda v: replies.format_verdicts(bodies(v)).select(
            "doc_id", "is_error", "verdict", F.size("issues").alias("n_issues"), F.try_element_at("issues", F.lit(1))["turn_ref"].alias("turn_id"), "feedback"
        ),
        "SELECT doc_id, is_error, verdict, CASE WHEN is_error THEN 0 ELSE 1 END AS n_issues, turn_ref AS turn_id, feedback FROM verdict_fields",
    )
    q("mismatched_fields", lambda v: verdicts(v).select("doc_id", F.array_join(replies.mismatched(c("field_matches")), ", ").alias("missed")), f"SELECT doc_id, {MISSED} AS missed FROM verdict_fields")
    q(
        "feedback_render",
        lambda v: verdicts(v).select("doc_id", replies.render_feedback(c("feedback"), replies.mismatched(c("field_matches")), c("issues")).alias("feedback")),
        f"""SELECT doc_id, concat_ws(chr(10), nullif(feedback, ''), 'Corpus fields NOT satisfied: ' || {MISSED}, CASE WHEN NOT is_error THEN '- (' || severity || ') ' || description || ' [' || turn_ref || ']' END) AS feedback FROM verdict_fields""",
    )
    q(
        "edit_patch_extract",
        lambda v: replies.edit_patches(patches(v)),
        """SELECT doc_id, n AS edit_no, 't' || (doc_id % 50 + n) AS turn_id, CASE n WHEN 2 THEN 'delete' ELSE 'replace' END AS action, CASE n WHEN 1 THEN text END AS text,
                  CAST(NULL AS VARCHAR) AS emotion, CASE n WHEN 3 THEN 'overlap' END AS turn_type
           FROM documents, (VALUES (1), (2), (3)) e(n) WHERE doc_id % 4 <> 2 OR n = 1""",
    )
    q(
        "formatter_reply_items",
        lambda v: replies.turn_items(turn_replies(v)).select(
            "conv_id", "turn", "pos", F.try_element_at("item", F.lit("text")).alias("text"), F.try_element_at("item", F.lit("speaker")).alias("speaker"),
            F.try_element_at("item", F.lit("emotion")).isNotNull().alias("has_emotion"), "is_error",
        ),
        TURN_ITEMS_SQL,
    )
    q(
        "turn_field_projection",
        lambda v: requests.judge_view(v.turns_timed.drop("present_keys")).join(requests.editor_view(v.turns_timed).select("conv_id", "pos", "overlaps_with"), ["conv_id", "pos"]),
        f"SELECT conv_id, pos, {', '.join(HIDDEN3)}, overlaps_with FROM turns_timed",
    )
    limit = " OR ".join(f"contains(lower(message), {quote(m)})" for m in fv.LIMIT_MARKS + fv.LIMIT_PHRASES)
    q(
        "rate_limit_classify",
        lambda v: v.error_log.select("event_id", usage.limit_error(c("status"), c("error_type"), c("message")).alias("is_limit")),
        f"SELECT event_id, coalesce(status = 429, FALSE) OR contains(lower(error_type), 'ratelimit') OR contains(lower(error_type), 'rate_limit') OR {limit} AS is_limit FROM error_log",
    )
    q(
        "topic_normalise",
        lambda v: replies.topics(topic_bodies(v)),
        f"""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN source WHEN 1 THEN NULL ELSE lang END AS title, CASE WHEN doc_id % 4 < 2 THEN regexp_replace(text, '^\\s+|\\s+$', '', 'g') ELSE '' END AS context, doc_id % 4 = 1 AS is_error FROM documents""",
    )
    q(
        "usage_normalise",
        lambda v: usage.normalise_usage(v.usage_log),
        """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS input_tokens, CASE WHEN l_orderkey % 5 = 3 THEN 0 ELSE l_linenumber * 10 END AS output_tokens,
                  CASE WHEN l_orderkey % 5 IN (0, 2) THEN l_suppkey % 7 ELSE 0 END AS cache_tokens, CASE WHEN l_orderkey % 5 = 2 THEN 3 ELSE 0 END AS thinking_tokens
           FROM lineitem WHERE l_orderkey % 5 <> 4""",
    )
    q(
        "truncation_flag",
        lambda v: usage.truncation(
            v.table("lineitem").select(
                "l_orderkey", "l_linenumber", F.when(c("l_returnflag") == "R", "MAX_TOKENS").when(c("l_returnflag") == "A", "STOP").alias("finish_reason"),
                F.lit(8192).alias("max_tokens"), F.when(c("l_linenumber") > 3, c("l_linenumber")).alias("thinking_tokens"), c("l_quantity").cast("bigint").alias("output_tokens"),
            )
        ).select("l_orderkey", "l_linenumber", "is_truncated", "message"),
        """SELECT l_orderkey, l_linenumber, l_returnflag = 'R' AS is_truncated, CASE WHEN l_returnflag = 'R' THEN 'Reply cut by the token budget (max_tokens=8192, thinking=' ||
                  CASE WHEN l_linenumber > 3 THEN CAST(l_linenumber AS VARCHAR) ELSE 'None' END || ', output=' || CAST(l_quantity AS BIGINT) || ').' END AS message FROM lineitem""",
    )
    q("token_usage_rollup", lambda v: usage.token_rollup(v.calls), "SELECT model, input_tokens, output_tokens, cache_tokens, total_tokens, calls, is_total FROM rollup")
    q(
        "token_usage_metrics",
        lambda v: usage.token_metrics(usage.token_rollup(v.calls)),
        """SELECT 'tokens/' || CASE WHEN is_total THEN 'total' ELSE replace(replace(model, '/', '_'), ' ', '_') END || '/' || CASE WHEN is_total AND f = 'total' THEN 'all' ELSE f END AS metric,
                  CASE f WHEN 'input' THEN input_tokens WHEN 'output' THEN output_tokens WHEN 'cache' THEN cache_tokens WHEN 'total' THEN total_tokens ELSE calls_n END AS "value"
           FROM (SELECT *, calls AS calls_n FROM rollup), (VALUES ('input'), ('output'), ('cache'), ('total'), ('calls')) x(f)""",
    )
    q(
        "verdict_stats",
        lambda v: replies.verdict_stats(verdicts(v)).select("metric", F.round("value", 6).alias("value")),
        """SELECT metric, round(v, 6) AS "value" FROM (
               SELECT 'replies' AS metric, CAST(count(*) AS DOUBLE) AS v FROM verdict_fields WHERE NOT is_error UNION ALL SELECT 'mean_realism', avg(realism_score) FROM verdict_fields WHERE NOT is_error
               UNION ALL SELECT 'mean_match', avg(corpus_match_score) FROM verdict_fields WHERE NOT is_error UNION ALL SELECT 'pass_rate', avg(CASE verdict WHEN 'PASS' THEN 1.0 ELSE 0.0 END) FROM verdict_fields WHERE NOT is_error
               UNION ALL SELECT 'missed/language', count(*) FILTER (NOT m_language) FROM verdict_fields WHERE NOT is_error UNION ALL SELECT 'missed/agent_emotion', count(*) FILTER (NOT m_agent_emotion) FROM verdict_fields WHERE NOT is_error
               UNION ALL SELECT 'missed/user_emotion', count(*) FILTER (NOT m_user_emotion) FROM verdict_fields WHERE NOT is_error
               UNION ALL SELECT 'missed/' || f, count(*) FROM verdict_fields, (VALUES ('agent_accent'), ('user_accent'), ('gender_pair'), ('conversation_type'), ('topic_relevance')) x(f) WHERE NOT is_error GROUP BY f)""",
    )
    q(
        "score_rows",
        scored,
        f"""SELECT corpus_combination_id, CASE WHEN NOT contains(prompt, 'Normal') THEN '{{"chars": ' || length(prompt) || '}}' END AS reply,
                  CASE WHEN contains(prompt, 'Normal') THEN 'RuntimeError' END AS error_type, contains(prompt, 'Normal') AS is_limit
           FROM (SELECT corpus_combination_id, concat_ws(chr(10), {', '.join(PROMPT_SQL['generator'])}) AS prompt FROM {REQUEST_INPUT})""",
    )
