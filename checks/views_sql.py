"""The same inputs as SQL, written independently of the library."""

from __future__ import annotations

import re

BLANK = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def squeeze(x: str) -> str:
    return strip(f"regexp_replace({x}, '{BLANK}+', ' ', 'g')")


def words(x: str) -> str:
    return f"(CASE WHEN {squeeze(x)} = '' THEN 0 ELSE len(string_split({squeeze(x)}, ' ')) END)"


def rnd(x: str, digits: int = 2) -> str:
    return f"(floor(({x}) * {10.0 ** digits} + 0.5) / {10.0 ** digits})"


def sec(x: str, digits: int = 2) -> str:
    return f"coalesce(CAST(CAST({rnd(x, digits)} AS DECIMAL(18,{digits})) AS VARCHAR), 'None')"


def pick(values: list, index: str) -> str:
    cells = ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return f"([{cells}])[({index}) + 1]"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _gender(x: str) -> str:
    t = f"lower({strip(x)})"
    return (
        f"(CASE WHEN {x} IS NULL OR {t} IN ('', 'nan', 'none', 'unknown') THEN 'unknown' WHEN {t} IN ('m', 'male') THEN 'male' "
        f"WHEN {t} IN ('f', 'female') THEN 'female' ELSE 'other' END)"
    )


EVENT_GENDER = "(CASE event_type WHEN 'purchase' THEN 'M' WHEN 'signup' THEN ' Female' WHEN 'view' THEN 'x' WHEN 'click' THEN '' END)"
LISTENER = "('mhm', 'haan', 'achha', 'ji')"


def build(domains: list[str], kinds: list[str]) -> dict[str, str]:
    fields = [
        "turn_id", "speaker", "text", "emotion", "planned_start_sec", "planned_end_sec", "real_start_sec",
        "real_end_sec", "error_time", "turn_type", "overlaps_with", "overlaps_kind", "interrupted", "interrupted_by",
    ]
    v: dict[str, str] = {}
    v["clips"] = f"""
        SELECT 'u' || user_id || '_' || strftime(ts, '%m%d') AS speaker_id,
               CASE WHEN user_id % 3 = 0 THEN 'hindi' ELSE 'english' END AS language,
               {_gender(EVENT_GENDER)} AS gender, floor(value) AS duration_seconds, props AS transcript,
               'events' AS source_dataset, event_id AS source_index FROM events"""
    v["winners"] = """
        SELECT speaker_id, language, gender, duration_seconds, transcript, source_dataset, source_index,
               CASE WHEN duration_seconds >= 10 THEN 'primary_ge_target' ELSE 'fallback_below_target' END AS selection_tier,
               first_qualifying_index
        FROM (SELECT *, min(source_index) OVER (PARTITION BY speaker_id, language) AS first_qualifying_index,
                     row_number() OVER (PARTITION BY speaker_id, language
                        ORDER BY CASE WHEN duration_seconds >= 10 THEN 0 ELSE 1 END,
                                 CASE WHEN duration_seconds >= 10 THEN duration_seconds ELSE -duration_seconds END, source_index) AS rn
              FROM clips WHERE duration_seconds >= 5) WHERE rn = 1"""
    blank = "event_id % 35 = 0"

    def field(x: str) -> str:
        return f"CASE WHEN {blank} THEN '' ELSE {x} END"

    v["accented_raw"] = f"""
        SELECT event_id AS source_index,
               CASE WHEN event_id % 5 <> 0 THEN 'wavs/' || event_id || CASE WHEN event_id % 2 = 0 THEN '_f' ELSE '_M' END || (user_id + 1000) || '_chunk_0.wav'
                    ELSE 'wavs/' || event_id || '_clip_0.wav' END AS audio_path,
               CASE WHEN event_id % 11 <> 0 THEN value END AS duration,
               CASE WHEN event_id % 13 <> 0 THEN props END AS text,
               {field(EVENT_GENDER)} AS gender, {field("'a' || user_id % 4")} AS age_group,
               {field("'lang' || user_id % 4")} AS primary_language, {field("'d' || user_id % 50")} AS native_place_district,
               {field("CASE WHEN user_id % 6 <> 0 THEN 's' || user_id % 6 END")} AS native_place_state,
               {field("'q' || user_id % 3")} AS highest_qualification, {field("'j' || user_id % 5")} AS job_category,
               {field("'o' || user_id % 7")} AS occupation_domain
        FROM events"""
    joined = " || '|' || ".join(
        f"coalesce({c}, 'None')"
        for c in ["gender", "primary_language", "native_place_district", "native_place_state", "highest_qualification", "job_category", "occupation_domain"]
    )
    v["accented_clips"] = f"""
        SELECT CASE WHEN regexp_matches(audio_path, '(?i)[fm][0-9]{{2,6}}_chunk') THEN lower(regexp_extract(audio_path, '(?i)([fm][0-9]{{2,6}})_chunk', 1))
                    WHEN trim({joined}, '|') = '' THEN 'unknown_spk_' || source_index
                    ELSE 'spk_' || substr(sha1({joined}), 1, 10) END AS speaker_id,
               'english' AS language, {_gender('gender')} AS gender, coalesce(duration, 0.0) AS duration_seconds,
               coalesce(text, '') AS transcript, audio_path, 'accented' AS source_dataset, source_index,
               age_group, native_place_state, occupation_domain
        FROM accented_raw"""
    v["indic_coded"] = """
        SELECT doc_id, lang,
               CASE doc_id % 9 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '0' ELSE source || '_' || (doc_id % 17) END AS speaker_id,
               CASE WHEN doc_id % 5 < 4 THEN doc_id % 5 END AS gender,
               CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 > 1 THEN text END AS normalized,
               CASE WHEN doc_id % 8 = 1 THEN '' WHEN doc_id % 4 <> 0 THEN text END AS verbatim,
               text, n_chars / 13.0::DOUBLE AS duration, source || '/' || doc_id || '.wav' AS audio_path,
               source AS district, n_chars % 40 AS snr FROM documents"""
    v["indic_raw"] = """
        SELECT * EXCLUDE (gender, g), CASE g WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'unknown' ELSE CAST(g AS VARCHAR) END AS gender
        FROM (SELECT *, gender AS g, row_number() OVER (ORDER BY doc_id) - 1 AS source_index FROM indic_coded WHERE lang = 'en')"""
    v["indic_clips"] = f"""
        SELECT CASE WHEN coalesce(speaker_id, '') = '' THEN 'unknown_spk_' || source_index ELSE speaker_id END AS speaker_id,
               'hindi' AS language, {_gender('gender')} AS gender, coalesce(duration, 0.0) AS duration_seconds,
               coalesce(nullif(normalized, ''), nullif(verbatim, ''), text, '') AS transcript, audio_path,
               'indic' AS source_dataset, source_index, district, snr
        FROM indic_raw"""
    v["listing"] = """
        SELECT language, gender, speaker_id AS speaker, file FROM winners, (VALUES ('audio.wav'), ('metadata.json')) f(file)
        WHERE NOT (language = 'hindi' AND file = 'metadata.json' AND duration_seconds = 10)"""
    v["turns_raw"] = f"""
        SELECT conv_id, pos, CASE WHEN role = 'assistant' THEN 'speaker_1' ELSE 'speaker_2' END AS speaker,
               CASE WHEN pos = 1 OR h < 5 THEN 'Normal' WHEN h < 7 THEN 'Backchanneling' WHEN h < 9 THEN 'Overlapping' ELSE 'Interruption' END AS turn_type,
               CASE WHEN r < 10 THEN r / 10.0::DOUBLE END AS ratio,
               {pick(['Happy', 'Sad', 'Angry', 'Neutral', None], '(part * 5 + turn) % 5')} AS emotion, {squeeze('text')} AS text
        FROM (SELECT conv_id // 10 AS conv_id, conv_id AS part, turn, role, text,
                     row_number() OVER (PARTITION BY conv_id // 10 ORDER BY conv_id, turn) AS pos,
                     (conv_id * 31 + turn) % 10 AS h, (conv_id + turn * 3) % 11 AS r
              FROM conversations WHERE role <> 'system')"""
    v["corpus"] = f"""
        SELECT c_custkey AS corpus_combination_id, c_custkey AS row_pos,
               CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'BUILDING') THEN 'Hindi' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'English' ELSE 'Hinglish' END AS language,
               CASE WHEN c_custkey % 11 <> 0 THEN {pick(['Neutral', 'Happy', 'Sad', 'Angry'], 'c_custkey % 4')} END AS agent_emotion,
               {pick(['Neutral', 'Happy', 'Sad', 'Angry'], '(c_custkey // 4) % 4')} AS user_emotion,
               {pick(['Normal', 'Bengali', 'Punjabi', 'Gujarati', 'West', 'South Indian', 'Odd'], 'c_custkey % 7')} AS agent_accent,
               {pick(['Normal', 'Bengali', 'Punjabi', 'Gujarati', 'West', 'South Indian', 'Odd'], '(c_custkey // 7) % 7')} AS user_accent,
               {pick(['F-M', 'MF', 'mm', 'FF', None], 'c_custkey % 5')} AS gender_pair,
               CAST(1200 + (c_custkey % 7) * 600 AS DOUBLE) AS duration_sec FROM customer"""
    v["turns_full"] = """
        SELECT t.conv_id, t.pos, t.speaker, t.turn_type, t.ratio,
               coalesce(t.emotion, CASE WHEN t.speaker = 'speaker_1' THEN c.agent_emotion ELSE c.user_emotion END, 'Neutral') AS emotion, t.text
        FROM turns_raw t LEFT JOIN corpus c ON c.corpus_combination_id = t.conv_id"""
    v["tagged"] = """
        SELECT conv_id, pos,
               'S' || substr(speaker, 9, 1) || ':' ||
               CASE WHEN pos % 9 = 4 THEN '' ELSE ' [' || CASE turn_type WHEN 'Normal' THEN 'normal' WHEN 'Backchanneling' THEN 'backchannel' WHEN 'Overlapping' THEN 'overlap' ELSE 'interrupt' END || ']' END ||
               CASE WHEN turn_type = 'Normal' THEN '' ELSE ' -> S' || CASE WHEN speaker = 'speaker_1' THEN '2' ELSE '1' END ||
                    CASE WHEN turn_type <> 'Interruption' AND ratio IS NOT NULL THEN '@' || CAST(CAST(ratio AS DECIMAL(3,2)) AS VARCHAR) ELSE '' END END || ' ' ||
               CASE WHEN pos % 13 = 5 THEN 'haan' WHEN pos % 17 = 6 THEN '—' || text ELSE text END ||
               CASE WHEN emotion IS NULL THEN '' ELSE ' (' || emotion || ')' END AS line
        FROM turns_raw"""
    pattern = r"^[sS] ?([12]) ?: ?(?:\[([A-Za-z-]+)\])? ?(?:-> ?[sS]([12])(?:@([0-9.]+))?)? ?(.*?) ?(?:\((Neutral|Happy|Sad|Angry)\))?$"
    g = [f"regexp_extract(line, '{pattern}', {i})" for i in range(7)]
    v["parsed"] = f"""
        SELECT conv_id, pos, 'speaker_' || a1 AS speaker,
               CASE WHEN starts_with(a5, '—') AND (a2 = '' OR lower(a2) = 'normal' OR ty IS NULL) THEN 'Interruption'
                    WHEN a2 = '' AND lower(regexp_replace(a5, '[^\\p{{L}} ]', '', 'g')) IN {LISTENER} THEN 'Backchanneling'
                    ELSE coalesce(ty, 'Normal') END AS turn_type,
               CASE WHEN a3 <> '' THEN 'speaker_' || a3 END AS ref_speaker,
               CASE WHEN a4 <> '' THEN least(greatest(CAST(a4 AS DOUBLE), 0.0), 1.0) END AS ratio,
               CASE WHEN a6 = '' THEN 'Neutral' ELSE a6 END AS emotion, a5 AS text
        FROM (SELECT *, CASE lower(a2) WHEN 'normal' THEN 'Normal' WHEN 'overlap' THEN 'Overlapping' WHEN 'interrupt' THEN 'Interruption' WHEN 'backchannel' THEN 'Backchanneling' END AS ty
              FROM (SELECT conv_id, pos, {', '.join(f'{g[i]} AS a{i}' for i in range(1, 7))} FROM tagged))"""
    v["blobs"] = """
        SELECT conv_id, turn, CASE WHEN turn = 3 THEN 'no turns here'
               ELSE '```' || chr(10) || 'Here it is' || chr(10) || ' s1 : ' || replace(text, chr(10), chr(10) || chr(10) || '  S2: ') || chr(10) || 'The end' || chr(10) || '```' END AS transcript
        FROM conversations"""
    k = "((conv_id * 7 + pos) % 40)"
    v["timed_base"] = f"""
        SELECT *, m = 0 AND kind = 'Interruption' AND conv_id % 3 = 0 AND pos % 2 = 0 AS cutter_cut FROM (
            SELECT *, {k} AS k, pos % 3 AS m, ((pos - 1) // 3) * 15.0::DOUBLE AS base,
                   {pick(kinds, '((CASE WHEN pos % 3 = 2 THEN pos + 1 ELSE pos END) // 3) % 3')} AS kind FROM turns_raw)"""
    v["timed_spans"] = """
        SELECT *, CASE WHEN m = 1 THEN base WHEN m = 2 THEN base + 5 WHEN k = 17 THEN base + 5
                       WHEN kind = 'Interruption' THEN CASE WHEN k = 15 THEN base + 11 ELSE base + 9.6::DOUBLE END
                       WHEN kind = 'Overlapping' AND k = 13 THEN base + 9 ELSE base + 6 END AS s,
                  CASE WHEN m = 1 THEN base + 4 WHEN m = 2 THEN base + 10
                       WHEN kind = 'Interruption' THEN CASE WHEN k = 14 THEN base + 9.8::DOUBLE ELSE base + 13 END
                       WHEN kind = 'Backchanneling' THEN CASE WHEN k = 16 THEN base + 11 ELSE base + 7 END ELSE base + 12 END AS e
        FROM timed_base"""
    short = ", ".join(quote(f) for f in fields if f not in ("emotion", "real_end_sec"))
    v["turns_timed"] = f"""
        SELECT conv_id, pos, CASE WHEN k = 1 THEN 't' || (pos - 1) ELSE 't' || pos END AS turn_id,
               CASE WHEN k = 2 THEN 'speaker_9' ELSE speaker END AS speaker, text,
               CASE WHEN k = 3 THEN 'Bored' ELSE coalesce(emotion, 'Neutral') END AS emotion,
               CASE WHEN k <> 6 THEN s END AS planned_start_sec, CASE WHEN k = 5 THEN s - 1 WHEN k <> 7 THEN e END AS planned_end_sec,
               CASE WHEN k <> 24 THEN s + 0.25::DOUBLE END AS real_start_sec, CASE WHEN k <> 24 THEN e + 0.5::DOUBLE END AS real_end_sec,
               CAST(NULL AS DOUBLE) AS error_time,
               CASE WHEN k = 4 THEN 'Chatter' WHEN m = 0 THEN kind ELSE 'Normal' END AS turn_type,
               CASE WHEN m <> 1 THEN CASE WHEN k = 8 THEN NULL WHEN k = 10 THEN 't9999' WHEN m = 2 THEN 't' || (pos + 1) ELSE 't' || (pos - 1) END END AS overlaps_with,
               CASE WHEN m <> 1 AND k NOT IN (8, 11) THEN CASE WHEN k = 9 THEN 'Overlapping' WHEN k = 12 THEN 'Weird' ELSE kind END END AS overlaps_kind,
               (m = 2 AND kind = 'Interruption' AND k NOT IN (18, 20)) OR k IN (19, 21, 22) OR cutter_cut AS interrupted,
               CASE WHEN k = 19 THEN NULL WHEN k = 20 THEN 't1' WHEN k = 21 THEN 't' || (pos - 1) WHEN k = 22 OR cutter_cut THEN 't1'
                    WHEN m = 2 AND kind = 'Interruption' AND k <> 18 THEN 't' || (pos + 1) END AS interrupted_by,
               k <> 23 AS complete
        FROM timed_spans"""
    v["short_fields"] = f"SELECT [{short}] AS present"
    v["edits"] = """
        SELECT conv_id, turn_id, 1 AS edit_no, CASE WHEN (conv_id + pos) % 12 = 3 THEN ' DELETE ' ELSE 'replace' END AS action,
               CASE WHEN (conv_id + pos) % 12 < 5 THEN ' short ' || pos ELSE '  ' END AS text,
               CASE WHEN (conv_id + pos) % 12 < 7 THEN 'sad' ELSE 'confused' END AS emotion,
               CASE WHEN (conv_id + pos) % 12 = 5 THEN 'overlap' END AS turn_type FROM turns_timed
        UNION ALL
        SELECT conv_id, CASE WHEN (conv_id + pos) % 12 = 2 THEN 't0' ELSE turn_id END, 2, 'replace',
               CASE WHEN (conv_id + pos) % 12 = 1 THEN 'again' END, 'ANGRY', NULL FROM turns_timed WHERE (conv_id + pos) % 12 < 4"""
    v["outcomes"] = """
        SELECT o_custkey AS corpus_combination_id, o_orderdate AS finished_at, o_orderkey AS finish_key,
               CAST(240 + (o_orderkey * 37) % 241 AS DOUBLE) AS duration_sec, o_orderstatus = 'F' AS accepted,
               'topic ' || o_orderkey % 50 AS title FROM orders"""
    v["accepted"] = """
        SELECT *, row_number() OVER (PARTITION BY corpus_combination_id ORDER BY finished_at, finish_key) AS "index" FROM outcomes WHERE accepted"""
    v["progress"] = """
        SELECT corpus_combination_id, sum(duration_sec) AS generated_sec, count(*) AS conversation_count FROM accepted GROUP BY 1"""
    v["corpus_progress"] = """
        SELECT *, CASE WHEN generated_sec >= target_sec AND generated_sec > target_sec + 120 THEN 'over_target'
                       WHEN generated_sec >= target_sec THEN 'complete'
                       WHEN conversation_count > 0 OR generated_sec > 0 THEN 'incomplete' ELSE 'not_started' END AS state
        FROM (SELECT c.*, c.duration_sec AS target_sec, coalesce(p.generated_sec, 0.0) AS generated_sec,
                     coalesce(p.conversation_count, 0) AS conversation_count
              FROM corpus c LEFT JOIN progress p USING (corpus_combination_id))"""
    v["runs"] = """
        SELECT *, CAST(sum(CASE WHEN accepted THEN 0 ELSE 1 END) OVER (PARTITION BY corpus_combination_id, island ORDER BY attempt_no) AS BIGINT) AS consecutive_failures
        FROM (SELECT *, sum(CASE WHEN accepted THEN 1 ELSE 0 END) OVER (PARTITION BY corpus_combination_id ORDER BY finished_at, finish_key) AS island,
                     row_number() OVER (PARTITION BY corpus_combination_id ORDER BY finished_at, finish_key) AS attempt_no FROM outcomes)"""
    v["abandoned"] = """
        SELECT corpus_combination_id, min(attempt_no) AS abandoned_at FROM runs WHERE consecutive_failures = 10 GROUP BY 1"""
    v["skipped"] = """
        SELECT a.corpus_combination_id, 10 AS consecutive_failures, '10 consecutive validation failures' AS reason, generated_sec, target_sec,
               conversation_count, language, gender_pair, abandoned_at
        FROM abandoned a JOIN corpus_progress USING (corpus_combination_id)"""
    v["language_totals"] = """
        SELECT lower(language) AS language, sum(target_sec) AS target_sec, sum(generated_sec) AS generated_sec FROM corpus_progress GROUP BY 1"""
    v["history"] = f"""
        SELECT corpus_combination_id, doc_id, title, domain, row_number() OVER (PARTITION BY corpus_combination_id ORDER BY doc_id) AS pos
        FROM (SELECT CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END AS corpus_combination_id, doc_id,
                     source || ' ' || n_chars AS title, {pick(domains, 'CAST(substr(source, 4, 3) AS INT)')} AS domain FROM documents)"""
    v["attempts"] = """
        SELECT l_orderkey AS conv_id, CASE WHEN l_suppkey % 2 = 0 THEN 'content' ELSE 'format' END AS stage, l_linenumber AS attempt,
               CASE (l_partkey + l_linenumber) % 5 WHEN 0 THEN 'PASS' WHEN 1 THEN NULL ELSE 'FAIL' END AS verdict, l_quantity > 20 AS manual_clean
        FROM lineitem"""
    v["replies"] = """
        SELECT doc_id, CASE doc_id % 10
            WHEN 0 THEN '```json' || chr(10) || body || chr(10) || '```'
            WHEN 1 THEN replace(replace(body, '"verdict"', '"VERDICT"'), '"realism_score"', '"REALISM_SCORE"')
            WHEN 2 THEN substr(body, 1, length(body) - 1) WHEN 3 THEN '[' || body || ']' ELSE body END AS reply
        FROM (SELECT doc_id, '{"verdict":"' || CASE WHEN quality = 1 THEN 'pass' WHEN quality = 0 THEN 'FAIL' ELSE 'maybe' END ||
              '","realism_score":' || (n_chars % 13) || ',"corpus_match_score":"' || (n_chars % 9) ||
              '.5","corpus_field_matches":{"language":true,"agent_emotion":' || CASE WHEN quality = 1 THEN 'true' ELSE 'false' END ||
              ',"user_emotion":1},"strengths":["' || source || '",""],"issues":[{"severity":"' || CASE WHEN toxic = 1 THEN 'CRITICAL' ELSE 'odd' END ||
              '","turn_ref":"t' || (doc_id % 30) || '","turn_id":"t' || (doc_id % 30) || '","description":"' || lang || ' chars ' || n_chars ||
              '"},{"severity":"major","description":" "}],"feedback":' || CAST(to_json(text) AS VARCHAR) || '}' AS body
              FROM documents LEFT JOIN labels USING (doc_id))"""
    v["bodies"] = f"""
        SELECT doc_id, CASE WHEN json_valid(b) THEN b END AS body FROM (
            SELECT doc_id, CASE WHEN starts_with(reply, '```') THEN {strip("regexp_replace(regexp_replace(reply, '^[^' || chr(10) || ']*' || chr(10), ''), '```$', '')")} ELSE reply END AS b FROM replies)"""
    v["verdict_fields"] = f"""
        SELECT doc_id, o IS NULL AS is_error,
               CASE WHEN upper(v) IN ('PASS', 'FAIL', 'NEEDS_REVIEW') THEN upper(v) ELSE 'NEEDS_REVIEW' END AS verdict,
               least(greatest(coalesce(CAST(r AS DOUBLE), 0.0), 0.0), 10.0) AS realism_score,
               least(greatest(coalesce(CAST(json_extract_string(o, '$.corpus_match_score') AS DOUBLE), 0.0), 0.0), 10.0) AS corpus_match_score,
               coalesce(json_extract_string(o, '$.corpus_field_matches.language') = 'true', FALSE) AS m_language,
               coalesce(json_extract_string(o, '$.corpus_field_matches.agent_emotion') = 'true', FALSE) AS m_agent_emotion,
               coalesce(json_extract_string(o, '$.corpus_field_matches.user_emotion') = '1', FALSE) AS m_user_emotion,
               json_extract_string(o, '$.strengths[0]') AS strength,
               CASE lower(json_extract_string(o, '$.issues[0].severity')) WHEN 'critical' THEN 'critical' WHEN 'odd' THEN 'minor' END AS severity,
               json_extract_string(o, '$.issues[0].turn_ref') AS turn_ref, json_extract_string(o, '$.issues[0].description') AS description,
               coalesce({strip("json_extract_string(o, '$.feedback')")}, '') AS feedback
        FROM (SELECT *, coalesce(json_extract_string(o, '$.verdict'), json_extract_string(o, '$.VERDICT')) AS v,
                     coalesce(json_extract_string(o, '$.realism_score'), json_extract_string(o, '$.REALISM_SCORE')) AS r
              FROM (SELECT doc_id, CASE WHEN starts_with(body, '[') THEN json_extract(body, '$[0]') ELSE CAST(body AS JSON) END AS o FROM bodies))"""
    v["calls"] = """
        SELECT l_returnflag || '/' || l_linestatus AS model,
               CASE WHEN l_orderkey % 19 <> 0 THEN CAST(l_quantity AS BIGINT) END AS input_tokens,
               CASE WHEN l_orderkey % 19 <> 0 THEN l_linenumber * 10 END AS output_tokens,
               CASE WHEN l_orderkey % 19 <> 0 THEN CASE WHEN l_suppkey % 2 = 0 THEN 5 ELSE 0 END END AS cache_tokens FROM lineitem"""
    v["rollup"] = """
        SELECT CASE WHEN grouping(model) = 1 THEN 'total' ELSE model END AS model, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
               CAST(sum(output_tokens) AS BIGINT) AS output_tokens, CAST(sum(cache_tokens) AS BIGINT) AS cache_tokens,
               CAST(sum(input_tokens) + sum(output_tokens) AS BIGINT) AS total_tokens, count(*) AS calls, grouping(model) = 1 AS is_total
        FROM calls WHERE input_tokens IS NOT NULL GROUP BY ROLLUP (model)"""
    v["error_log"] = f"""
        SELECT event_id, CASE event_id % 8 WHEN 0 THEN 429 WHEN 1 THEN 500 END AS status,
               CASE WHEN event_id % 8 = 2 THEN 'RateLimitError' ELSE 'ValueError' END AS error_type,
               CASE event_id % 8 WHEN 3 THEN 'Server said: ' || upper({pick(['rate limit', 'rate_limit', 'ratelimit', 'too many requests', 'quota exceeded', 'insufficient_quota', 'resource exhausted', 'resource_exhausted', 'billing hard limit', 'exceeded your current quota'], '(event_id // 8) % 10')}) || ' ' || props
                    WHEN 4 THEN 'HTTP 429 ' || props WHEN 5 THEN 'status_code=429' || props ELSE 'failed: ' || props END AS message
        FROM events"""
    v["script_turns_all"] = """
        SELECT doc_id, lang, i, line, CASE WHEN doc_id % 20 = 2 AND i = 1 THEN 'ghost' WHEN i % 2 = 1 THEN 'user1' ELSE 'user2' END AS speaker,
               CASE WHEN (i - 1) % 4 = 0 THEN 0.0::DOUBLE WHEN (i - 1) % 3 = 0 THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END AS gap,
               CASE WHEN (i - 1) % 4 = 0 THEN 0.4::DOUBLE ELSE 0.0::DOUBLE END AS overlap
        FROM (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)"""
    v["scripts"] = f"""
        SELECT doc_id, 'c' || doc_id AS conversation_id, count(*) AS n_turns,
               CASE WHEN doc_id % 20 = 0 THEN 'load: unreadable document' WHEN doc_id % 20 = 1 THEN 'needs exactly two speakers'
                    WHEN doc_id % 20 = 2 THEN 'unknown speaker: ghost' WHEN bool_or({strip('line')} = '') THEN 'empty text' END AS drop_reason
        FROM script_turns_all GROUP BY doc_id"""
    v["clip_turns"] = f"""
        SELECT s.conversation_id, t.i AS pos, t.speaker, t.line AS text, t.gap, t.overlap, {rnd("length(t.line) / 13.0::DOUBLE")} AS duration
        FROM script_turns_all t JOIN scripts s USING (doc_id) WHERE s.drop_reason IS NULL"""
    v["steps"] = """
        SELECT *, CAST(CASE WHEN pos = 1 THEN 0 WHEN overlap > 0 THEN -least(overlap, 1.0) WHEN gap > 0 THEN gap ELSE 0.25 END AS DECIMAL(28,6)) AS step,
               CAST(duration AS DECIMAL(28,6)) AS d FROM clip_turns"""
    v["scheduled"] = """
        SELECT conversation_id, pos, speaker, text, gap, overlap, duration, CAST(t - least(0, low) AS DOUBLE) AS "start", CAST(t - least(0, low) + d AS DOUBLE) AS "end"
        FROM (SELECT *, min(t) OVER (PARTITION BY conversation_id ORDER BY pos) AS low
              FROM (SELECT *, sum(step + d) OVER (PARTITION BY conversation_id ORDER BY pos) - d AS t FROM steps))"""
    v["clip_words"] = f"""
        SELECT conversation_id, pos, word_no, speaker, word, {rnd('duration * (upto - length(word)) / total', 3)} AS "start", {rnd('duration * upto / total', 3)} AS "end"
        FROM (SELECT *, sum(length(word)) OVER (PARTITION BY conversation_id, pos ORDER BY word_no) AS upto, sum(length(word)) OVER (PARTITION BY conversation_id, pos) AS total
              FROM (SELECT conversation_id, pos, speaker, duration, unnest(string_split({squeeze('text')}, ' ')) AS word,
                           generate_subscripts(string_split({squeeze('text')}, ' '), 1) AS word_no FROM clip_turns WHERE duration > 0 AND {squeeze('text')} <> ''))"""
    v["merged_words"] = f"""
        SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY "start", pos, word_no) AS seq
        FROM (SELECT w.conversation_id, w.pos, w.word_no, w.speaker, w.word, {rnd('w."start" + s."start"', 3)} AS "start", {rnd('w."end" + s."start"', 3)} AS "end"
              FROM clip_words w JOIN scheduled s USING (conversation_id, pos))"""
    v["local_files"] = "SELECT regexp_replace(url, '^https?://', '') AS path FROM pages"
    v["remote_files"] = "SELECT 'bucket/' || regexp_replace(url, '^https?://', '') AS path FROM pages WHERE page_id IN (SELECT doc_id FROM labels)"
    v["remote_relative"] = "SELECT DISTINCT substr(path, 8) AS path FROM remote_files"
    return v


def with_views(sql: str, views: dict[str, str]) -> str:
    """Prefix a query with the views it needs, in dependency order."""
    names = re.compile(r"\b(?:FROM|JOIN)\s+(" + "|".join(views) + r")\b")
    order: list[str] = []

    def need(text: str) -> None:
        for name in names.findall(re.sub(r"'[^']*'", "''", text)):
            if name not in order:
                need(views[name])
                order.append(name)

    need(sql)
    heads = [f"{n} AS MATERIALIZED ({views[n]})" for n in order]
    own = re.match(r"WITH (RECURSIVE )?", sql)
    if own:  # the query brings its own steps: put the views before them
        recursive = own.group(1) or ""
        return f"WITH {recursive}" + "".join(h + ", " for h in heads) + sql[own.end():]
    return f"WITH {', '.join(heads)} {sql}" if heads else sql
