"""Corpus planning: progress, budgets, order, failures, topics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.views import Views, cat, text_of
from checks.views_sql import pick, quote, rnd
from duologue.functions import draws
from duologue.functions import dialogue as dx
from duologue.functions import fixed_values as fv
from duologue.operators import planning
from duologue.operators.planning import INSTANCE
from duologue.plans import publish
from duologue.plans.registry import DeltaLog
from duologue.session import checkpoint_root
from duologue.sources import dialogue as sources

c = F.col
LANGUAGES = ["english", "hindi"]
STATE = [INSTANCE, "language", "target_sec", "generated_sec", "conversation_count", "state"]


def corpus_lines(v: Views):
    """Corpus rows as JSON lines; missing attributes are absent keys."""
    return v.corpus.select(F.to_json(F.struct(*[x for x in v.corpus.columns if x != "row_pos"])).alias("value"))


def registry_document(v: Views):
    """Progress entries as registry documents, one per state, read back row by row."""
    entry = F.concat(
        F.lit('{"instances":{"'), text_of(c(INSTANCE)), F.lit('":{"target_sec":'), text_of(c("target_sec")), F.lit(',"generated_sec":'),
        text_of(c("generated_sec")), F.lit(',"conversation_count":'), text_of(c("conversation_count")), F.lit("}}}"),
    )
    return v.corpus_progress.where("state != 'not_started'").select(entry.alias("value"))


def attempts_once(v: Views):
    """One row per conversation, stage and attempt."""
    return v.attempts.groupBy("conv_id", "stage", "attempt").agg(F.max("verdict").alias("verdict"), F.bool_and("manual_clean").alias("manual_clean"))


ATTEMPTS_ONCE = "(SELECT conv_id, stage, attempt, max(verdict) AS verdict, bool_and(manual_clean) AS manual_clean FROM attempts GROUP BY 1, 2, 3)"
UNIFORM = "CAST(('0x' || substr(sha1({key} || '/' || {salt}), 1, 8))::BIGINT AS DOUBLE) / 4294967296.0::DOUBLE"


def gauss(n: str) -> str:
    u = UNIFORM.format(key="c_custkey", salt=f"'u' || {n}")
    w = UNIFORM.format(key="c_custkey", salt=f"'v' || {n}")
    return f"(360.0::DOUBLE + 60.0::DOUBLE * sqrt(-2.0::DOUBLE * ln(greatest({u}, 1e-12::DOUBLE))) * cos(2.0::DOUBLE * pi() * {w}))"


CAP_SQL = f"""
    CASE WHEN rem <= 0 THEN NULL
         WHEN rem >= 240 THEN CASE WHEN least(greatest(s, 240.0), least(480.0, rem + 120)) >= 240 THEN {rnd('least(greatest(s, 240.0), least(480.0, rem + 120))', 1)} END
         WHEN rem + 120 >= 60 THEN {rnd('greatest(least(s, rem + 120), 60.0)', 1)} END"""

ORDERED_SQL = """SELECT *, row_number() OVER (ORDER BY language_pos, row_pos) AS order_no FROM (
    SELECT *, CASE lower(language) WHEN 'english' THEN 0 WHEN 'hindi' THEN 1 END AS language_pos FROM {0} WHERE lower(language) IN ('english', 'hindi'))"""


def in_log(v: Views, schema: str, key: str, *batches: DataFrame) -> DataFrame:
    """A stored registry that got its rows in several batches, read again."""
    log = DeltaLog(f"{checkpoint_root(v.spark)}/registry-{uuid.uuid4().hex}", schema, (key,), fanout=2)
    for number, rows in enumerate(batches):
        log.write(rows, number)
    return log.read(v.spark)


def stored_registry(v: Views) -> DataFrame:
    """Progress documents of three batches: early figures of all instances, then the rest of two thirds and of one."""
    schema = "target_sec: double, generated_sec: double, conversation_count: bigint"
    rows = publish.registry_rows(registry_document(v), schema)
    early = rows.withColumn("generated_sec", F.when(c("registry_key") % 3 == 0, c("generated_sec")).otherwise(0.0))
    return in_log(v, "registry_key bigint, " + schema.replace(":", ""), "registry_key", early, rows.where("registry_key % 3 = 1"), rows.where("registry_key % 3 = 2"))


def stored_skips(v: Views) -> DataFrame:
    """Skipped instances of three batches; the second corrects the first."""
    schema = ", ".join(f"{name} {kind}" for name, kind in v.skipped.dtypes)
    third = c(INSTANCE) % 3
    return in_log(v, schema, INSTANCE, v.skipped.where(third < 2).withColumn("reason", F.lit(None)), v.skipped.where(third < 2), v.skipped.where(third == 2))


def upserted(v: Views) -> DataFrame:
    """Changed entries of a second batch take the place of the first one's."""
    done = v.corpus_progress.where("state in ('complete', 'not_started')")
    changed = done.select(INSTANCE, (c("generated_sec") + 1).alias("generated_sec"), (c("conversation_count") + 1).alias("conversation_count"), F.lit("2024-01-01T00:00:00").alias("updated_at"))
    schema = f"{INSTANCE} bigint, generated_sec double, conversation_count bigint, updated_at string"
    return in_log(v, schema, INSTANCE, v.progress.withColumn("updated_at", F.lit("old")), changed)


def register(q) -> None:
    q(
        "scan_corpus",
        lambda v: corpus_lines(v).select(F.from_json("value", sources.CORPUS_SCHEMA).alias("r")).select(
            "r.corpus_combination_id", "r.language", "r.agent_emotion", "r.user_emotion", "r.agent_accent", "r.user_accent", "r.gender_pair", "r.duration_sec", "r.est_conversations_needed"
        ),
        "SELECT corpus_combination_id, language, agent_emotion, user_emotion, agent_accent, user_accent, gender_pair, duration_sec, CAST(NULL AS BIGINT) AS est_conversations_needed FROM corpus",
    )
    q(
        "scan_progress",
        stored_registry,
        "SELECT corpus_combination_id AS registry_key, target_sec, generated_sec, conversation_count FROM corpus_progress WHERE state <> 'not_started'",
    )
    q("scan_skipped", stored_skips, "SELECT corpus_combination_id, consecutive_failures, reason, generated_sec, target_sec, conversation_count, language, gender_pair, abandoned_at FROM skipped")
    q(
        "profile_projection",
        lambda v: v.corpus.select(INSTANCE, F.explode(planning.profile_map(["language", "agent_emotion", "user_emotion", "agent_accent", "user_accent", "gender_pair"])).alias("name", "value")),
        """SELECT corpus_combination_id, name, value FROM (SELECT corpus_combination_id, language, agent_emotion, user_emotion, agent_accent, user_accent, gender_pair FROM corpus)
           UNPIVOT (value FOR name IN (language, agent_emotion, user_emotion, agent_accent, user_accent, gender_pair))""",
    )
    q(
        "pacing_targets",
        lambda v: v.corpus.select(INSTANCE, *[x.alias(n) for x, n in zip(planning.pacing(c("duration_sec") / 7.3), ("words", "turns"), strict=True)]),
        "SELECT corpus_combination_id, CAST(floor(duration_sec / 7.3::DOUBLE * 2.5::DOUBLE) AS BIGINT) AS words, greatest(24, CAST(floor(duration_sec / 7.3::DOUBLE / 7.0::DOUBLE) AS BIGINT)) AS turns FROM corpus",
    )
    sampled = f"(CASE WHEN d1 BETWEEN 240 AND 480 THEN d1 WHEN d2 BETWEEN 240 AND 480 THEN d2 WHEN d3 BETWEEN 240 AND 480 THEN d3 WHEN d4 BETWEEN 240 AND 480 THEN d4 WHEN d5 BETWEEN 240 AND 480 THEN d5 WHEN d6 BETWEEN 240 AND 480 THEN d6 ELSE d7 END)"
    q(
        "target_duration_sample",
        lambda v: v.table("customer").select("c_custkey", draws.target_duration(c("c_custkey")).alias("target_sec")),
        f"""SELECT c_custkey, {rnd(sampled, 1)} AS target_sec FROM (SELECT c_custkey, {', '.join(f"{gauss(repr(str(i)))} AS d{i}" for i in range(1, 8))} FROM customer)""",
    )
    q(
        "target_duration_cap",
        lambda v: v.corpus_progress.select(INSTANCE, (c("target_sec") - c("generated_sec")).alias("rem"), (200 + (c(INSTANCE) * 13) % 320).cast("double").alias("s")).select(
            INSTANCE, planning.capped_target(c("s"), c("rem")).alias("target_sec")
        ),
        f"SELECT corpus_combination_id, {CAP_SQL} AS target_sec FROM (SELECT corpus_combination_id, target_sec - generated_sec AS rem, CAST(200 + (corpus_combination_id * 13) % 320 AS DOUBLE) AS s FROM corpus_progress)",
    )
    share = ["0.5", "50", "abc", "-1", "250"]
    share_sql = pick(share, "corpus_combination_id % 5")
    q(
        "number_inclusion",
        lambda v: v.corpus.select(INSTANCE, draws.inclusion_share(F.element_at(F.array(*[F.lit(s) for s in share]), (c(INSTANCE) % 5 + 1).cast("int"))).alias("share")).select(
            INSTANCE, "share", draws.includes_numbers(c(INSTANCE), c("share")).alias("include_numbers")
        ),
        f"""SELECT corpus_combination_id, share, {UNIFORM.format(key='corpus_combination_id', salt="'numbers'")} < share AS include_numbers FROM (
               SELECT corpus_combination_id, coalesce(least(greatest(CASE WHEN x > 1 THEN x / 100.0::DOUBLE ELSE x END, 0.0::DOUBLE), 1.0::DOUBLE), 0.5::DOUBLE) AS share
               FROM (SELECT corpus_combination_id, TRY_CAST({share_sql} AS DOUBLE) AS x FROM corpus))""",
    )
    models = [None, "Gemini", None, " openai ", "zzz"]
    q(
        "provider_route",
        lambda v: v.corpus.select(INSTANCE, "language", F.element_at(F.array(*[F.lit(m) for m in models]), (c(INSTANCE) % 5 + 1).cast("int")).alias("m")).select(
            INSTANCE, planning.generation_provider(c("m"), c("language")).alias("generation"), planning.validation_provider(c("m")).alias("validation")
        ).select("*", planning.known_provider(c("generation")).alias("is_known")),
        f"""SELECT corpus_combination_id, g AS generation, coalesce(m, 'gemma') AS validation, g IN ('krutrim', 'gemma', 'sarvam', 'gemini', 'groq', 'openai', 'inception') AS is_known FROM (
               SELECT corpus_combination_id, m, coalesce(m, CASE WHEN lower(language) = 'hindi' THEN 'sarvam' ELSE 'krutrim' END) AS g FROM (
                   SELECT *, lower(trim({pick(models, 'corpus_combination_id % 5')})) AS m FROM corpus))""",
    )
    q(
        "temperature_schedule",
        lambda v: v.table("lineitem").select(
            "l_orderkey", "l_linenumber",
            planning.attempt_temperature((c("l_discount") * 5), c("l_linenumber"), F.when(c("l_suppkey") % 2 == 0, "sarvam").otherwise("gemini")).alias("temperature"),
        ),
        f"""SELECT l_orderkey, l_linenumber, {rnd("least(0.95::DOUBLE, CASE WHEN l_suppkey % 2 = 0 THEN greatest(l_discount * 5, 0.7::DOUBLE) ELSE l_discount * 5 END + 0.15::DOUBLE * (l_linenumber - 1))")} AS temperature FROM lineitem""",
    )
    markers = " ".join(f"WHEN {quote(k)} THEN {quote(x)}" for k, x in fv.ACCENT_MARKERS.items())
    guide = f"CASE WHEN lower(language) = 'english' THEN CASE WHEN lower({{0}}) <> 'normal' THEN {quote(fv.ENGLISH_ACCENT_NOTE)} END ELSE CASE lower({{0}}) {markers} END END"
    q(
        "accent_guidance",
        lambda v: v.corpus.select(INSTANCE, planning.accent_marker(c("agent_accent"), c("language")).alias("agent"), planning.accent_marker(c("user_accent"), c("language")).alias("user")),
        f'SELECT corpus_combination_id, {guide.format("agent_accent")} AS agent, {guide.format("user_accent")} AS "user" FROM corpus',
    )
    directives = " ".join(f"WHEN {quote(k)} THEN {quote(x)}" for k, x in fv.LANGUAGE_DIRECTIVES.items())
    q(
        "language_directive",
        lambda v: v.corpus.select(INSTANCE, planning.language_directive(F.when(c(INSTANCE) % 9 == 0, "Klingon").otherwise(c("language"))).alias("directive")),
        f"SELECT corpus_combination_id, CASE WHEN corpus_combination_id % 9 <> 0 THEN CASE lower(language) {directives} END END AS directive FROM corpus",
    )
    letter = "CASE regexp_extract_all(lower(gender_pair), '[mf]')[{0}] WHEN 'm' THEN 'Male' WHEN 'f' THEN 'Female' END"
    q(
        "speaker_genders",
        lambda v: v.corpus.select(INSTANCE, dx.speaker_genders(c("gender_pair")).alias("g")).select(INSTANCE, "g.speaker_1", "g.speaker_2"),
        f"SELECT corpus_combination_id, {letter.format(1)} AS speaker_1, {letter.format(2)} AS speaker_2 FROM corpus",
    )
    q(
        "run_languages_parse",
        lambda v: v.table("nation").select(
            "n_nationkey",
            F.array_join(planning.run_languages(F.when(c("n_regionkey") == 0, F.array(F.lit(" "))).otherwise(F.array(F.lit(" English"), c("n_name"), F.lit("HINDI "), F.lit(""), F.lit("english")))), ",").alias("languages"),
        ),
        "SELECT n_nationkey, CASE WHEN n_regionkey <> 0 THEN 'english,' || lower(n_name) || ',hindi' END AS languages FROM nation",
    )
    # ---- joins and rollups ----
    q("corpus_progress", lambda v: v.corpus_progress.select(*STATE), "SELECT corpus_combination_id, language, target_sec, generated_sec, conversation_count, state FROM corpus_progress")
    q("instance_state", lambda v: v.corpus_progress.groupBy("state").agg(F.count("*").alias("n")), "SELECT state, count(*) AS n FROM corpus_progress GROUP BY 1")
    q("corpus_not_skipped", lambda v: planning.not_skipped(v.corpus, v.skipped).select(INSTANCE, "language"), "SELECT corpus_combination_id, language FROM corpus WHERE corpus_combination_id NOT IN (SELECT corpus_combination_id FROM skipped)")
    q("language_budget_totals", lambda v: planning.language_totals(v.corpus_progress), "SELECT language, target_sec, generated_sec FROM language_totals")
    q(
        "run_plan_summary",
        lambda v: planning.run_plan_summary(v.corpus_progress, v.skipped),
        """SELECT CASE WHEN grouping(language) = 1 THEN '*' ELSE language END AS language, CASE WHEN grouping(language) = 1 THEN count(*) ELSE count(*) FILTER (NOT sk) END AS total,
                  count(*) FILTER (NOT sk AND state = 'complete') AS complete, count(*) FILTER (NOT sk AND state = 'over_target') AS over_target, count(*) FILTER (NOT sk AND state = 'incomplete') AS incomplete,
                  count(*) FILTER (NOT sk AND state = 'not_started') AS not_started, CASE WHEN grouping(language) = 1 THEN count(*) FILTER (sk) ELSE 0 END AS skipped,
                  count(*) FILTER (NOT sk AND state IN ('incomplete', 'not_started')) AS to_process
           FROM (SELECT lower(language) AS language, state, corpus_combination_id IN (SELECT corpus_combination_id FROM skipped) AS sk FROM corpus_progress) GROUP BY ROLLUP (language)""",
    )
    q(
        "progress_rollup",
        # all titles, as rows: an instance may have any number
        lambda v: v.progress.join(v.accepted_indexed.select(INSTANCE, "index", "title"), INSTANCE),
        """SELECT corpus_combination_id, generated_sec, conversation_count, "index", title FROM accepted
           JOIN (SELECT corpus_combination_id, sum(duration_sec) AS generated_sec, count(*) AS conversation_count FROM accepted GROUP BY 1) USING (corpus_combination_id)""",
    )
    q(
        "budget_headroom",
        lambda v: planning.headroom(
            v.corpus_progress,
            planning.language_totals(v.corpus_progress).where("language != 'english'"),
            v.table("supplier").select((c("s_suppkey") * 3).alias(INSTANCE), c("s_nationkey").cast("double").alias("reserved_sec")),
        ).withColumn("language_headroom", F.when(c("language_headroom") < float("inf"), c("language_headroom"))),
        """SELECT corpus_combination_id, language, ih AS instance_headroom, lh AS language_headroom, least(ih, coalesce(lh, ih)) AS effective_headroom FROM (
               SELECT p.corpus_combination_id, p.language, p.target_sec + 120 - p.generated_sec - coalesce(r, 0) AS ih, t.target_sec + 120 - t.generated_sec - coalesce(r, 0) AS lh
               FROM corpus_progress p LEFT JOIN (SELECT * FROM language_totals WHERE language <> 'english') t ON t.language = lower(p.language)
               LEFT JOIN (SELECT s_suppkey * 3 AS k, sum(CAST(s_nationkey AS DOUBLE)) AS r FROM supplier GROUP BY 1) s ON s.k = p.corpus_combination_id)""",
    )
    q("run_stats", lambda v: planning.run_stats(v.outcomes, v.corpus_progress), """
        SELECT (SELECT count(*) FILTER (accepted) FROM outcomes) AS conversations_accepted, (SELECT count(*) FILTER (NOT accepted) FROM outcomes) AS conversations_failed, (SELECT count(*) FROM outcomes) AS conversations_total,
               (SELECT count(*) FILTER (state IN ('complete', 'over_target')) FROM corpus_progress) AS instances_completed, (SELECT count(*) FROM corpus_progress) AS instances_total""")
    # ---- windows ----
    q("conversation_index", lambda v: v.accepted_indexed.select(INSTANCE, "finish_key", "index"), 'SELECT corpus_combination_id, finish_key, "index" FROM accepted')
    q(
        "recent_domain_window",
        lambda v: planning.allowed_domains(v.history).select(INSTANCE, "doc_id", F.size("allowed").alias("n_allowed"), F.array_join(F.array_sort("allowed"), "|").alias("allowed")),
        f"""WITH domains AS (SELECT unnest([{', '.join(quote(d) for d in fv.TOPIC_DOMAINS)}]) AS d),
            recent AS (SELECT corpus_combination_id, doc_id, coalesce(list(domain) OVER (PARTITION BY corpus_combination_id ORDER BY pos ROWS BETWEEN 23 PRECEDING AND 1 PRECEDING), []) AS used FROM history)
            SELECT corpus_combination_id, doc_id, CAST(count(*) AS INT) AS n_allowed, string_agg(d, '|' ORDER BY d) AS allowed FROM recent, domains WHERE NOT list_contains(used, d) GROUP BY 1, 2""",
    )
    q(
        "consecutive_failures",
        lambda v: v.runs.select(INSTANCE, "finish_key", "attempt_no", "consecutive_failures"),
        "SELECT corpus_combination_id, finish_key, attempt_no, consecutive_failures FROM runs",
    )
    q(
        "budget_admission",
        lambda v: planning.budget_admission(
            v.outcomes, v.corpus_progress.withColumn("generated_sec", c("generated_sec") / 4), v.ORDER
        ).select(INSTANCE, "finish_key", "status", "total_sec"),
        """SELECT corpus_combination_id, finish_key, CASE WHEN total - duration_sec >= target_sec THEN 'not_reached' WHEN total <= target_sec + 120 THEN 'accepted' ELSE 'rejected' END AS status, total AS total_sec
           FROM (SELECT o.corpus_combination_id, finish_key, o.duration_sec, coalesce(p.target_sec, 0) AS target_sec,
                        coalesce(p.generated_sec / 4, 0) + sum(o.duration_sec) OVER (PARTITION BY o.corpus_combination_id ORDER BY finished_at, finish_key) AS total
                 FROM outcomes o LEFT JOIN corpus_progress p USING (corpus_combination_id))""",
    )
    q(
        "attempt_selection",
        lambda v: planning.select_attempts(attempts_once(v)),
        f"""SELECT conv_id, ca AS content_attempt, coalesce(cb, FALSE) AS content_bypassed, CASE WHEN ca IS NOT NULL THEN coalesce(fa, fl) END AS format_attempt,
                  ca IS NOT NULL AND coalesce(fb, FALSE) AS format_bypassed, ca IS NOT NULL AND fa IS NULL AND fl IS NOT NULL AS format_exhausted, ca IS NOT NULL AND fl IS NOT NULL AS passed
           FROM (SELECT conv_id, min(attempt) FILTER (stage = 'content' AND fine) AS ca, arg_min(verdict IS NULL, attempt) FILTER (stage = 'content' AND fine) AS cb,
                        min(attempt) FILTER (stage = 'format' AND manual_clean AND fine) AS fa, arg_min(verdict IS NULL, attempt) FILTER (stage = 'format' AND manual_clean AND fine) AS fb,
                        max(attempt) FILTER (stage = 'format' AND manual_clean) AS fl
                 FROM (SELECT *, verdict IS NULL OR verdict = 'PASS' AS fine FROM {ATTEMPTS_ONCE}) GROUP BY 1)""",
    )
    # ---- orders and sets ----
    q(
        "language_ordered_instances",
        lambda v: planning.language_ordered(v.corpus, LANGUAGES).select(INSTANCE, "language_pos", "row_pos", "order_no"),
        f"SELECT corpus_combination_id, language_pos, row_pos, order_no FROM ({ORDERED_SQL.format('corpus')})",
    )
    q(
        "language_requests_refused",
        lambda v: planning.unsupported_requests(v.table("documents").select("doc_id", F.array(F.lit("english"), c("lang"), F.when(c("doc_id") % 2 == 0, "hindi").otherwise(c("source"))).alias("languages"))).select(
            "doc_id", F.array_join("unsupported", "|").alias("unsupported")
        ),
        "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang WHEN source = lang THEN lang ELSE lang || '|' || source END AS unsupported FROM documents",
    )
    q(
        "processing_order",
        lambda v: planning.processing_order(v.corpus_progress, v.skipped, LANGUAGES).select(INSTANCE, "state", "order_no"),
        """SELECT corpus_combination_id, state, row_number() OVER (ORDER BY CASE state WHEN 'incomplete' THEN 0 ELSE 1 END, CASE lower(language) WHEN 'english' THEN 0 ELSE 1 END, row_pos) AS order_no
           FROM corpus_progress WHERE state IN ('incomplete', 'not_started') AND lower(language) IN ('english', 'hindi') AND corpus_combination_id NOT IN (SELECT corpus_combination_id FROM skipped)""",
    )
    positions = ", ".join(map(str, fv.DEV_POSITIONS))
    q(
        "dev_sample",
        lambda v: planning.dev_sample(v.corpus, LANGUAGES).select(INSTANCE, "language_pos", "list_pos", "max_conversations"),
        f"""SELECT corpus_combination_id, CASE lower(language) WHEN 'english' THEN 1 ELSE 2 END AS language_pos, list_position([{positions}], row_pos) AS list_pos, 1 AS max_conversations
            FROM corpus WHERE row_pos IN ({positions}) AND lower(language) IN ('english', 'hindi')""",
    )
    q(
        "distinct_topics",
        lambda v: planning.distinct_topics(v.accepted_indexed),
        'SELECT corpus_combination_id, title, min("index") AS first_index FROM accepted GROUP BY 1, 2',
    )
    q(
        "topic_history_exclusion",
        lambda v: planning.fresh_topics(
            v.outcomes.where(~c("accepted")).select(INSTANCE, "finish_key", cat(" ", F.upper("title"), " ").alias("title")), v.accepted.select(INSTANCE, "title")
        ).select(INSTANCE, "finish_key"),
        """SELECT corpus_combination_id, finish_key FROM outcomes o WHERE NOT accepted AND NOT EXISTS (
               SELECT 1 FROM accepted a WHERE a.corpus_combination_id = o.corpus_combination_id AND a.title = o.title)""",
    )
    q("skip_registry_entries", lambda v: v.skipped.select(INSTANCE, "consecutive_failures", "reason", "generated_sec", "target_sec", "conversation_count", "language", "gender_pair"),
      "SELECT corpus_combination_id, consecutive_failures, reason, generated_sec, target_sec, conversation_count, language, gender_pair FROM skipped")
    q(
        "registry_upsert",
        upserted,
        """SELECT coalesce(n.corpus_combination_id, p.corpus_combination_id) AS corpus_combination_id, coalesce(n.generated_sec + 1, p.generated_sec) AS generated_sec,
                  coalesce(n.conversation_count + 1, p.conversation_count) AS conversation_count, CASE WHEN n.corpus_combination_id IS NOT NULL THEN '2024-01-01T00:00:00' ELSE 'old' END AS updated_at
           FROM progress p FULL OUTER JOIN (SELECT * FROM corpus_progress WHERE state IN ('complete', 'not_started')) n ON n.corpus_combination_id = p.corpus_combination_id""",
    )
