"""Voice side: sources, selection, export and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.views import Views, cat, text_of
from checks.views_sql import EVENT_GENDER, _gender, rnd
from duologue.functions import fixed_values as fv
from duologue.functions.text import slug
from duologue.operators import voice
from duologue.plans import publish
from duologue.sources import clips as clip_sources

c = F.col
CLIP = ["speaker_id", "language", "gender", "duration_seconds", "transcript", "source_dataset", "source_index"]


EXTRA = ["age_group", "primary_language", "native_place_state", "native_place_district", "highest_qualification", "job_category", "occupation_domain"]
#: those that the view of the clips has already
KEPT = ["age_group", "native_place_state", "occupation_domain"]


def nation_classes(v: Views, column: str):
    return v.table("nation").select(F.lit(column).alias("column_name"), c("n_nationkey").alias("code"), c("n_name").alias("name"))


def class_table(v: Views):
    """Class numbers of seven columns; scenario has none, so its numbers stay."""
    regions = v.table("region").select(c("r_regionkey").alias("code"), c("r_name").alias("name"))
    columns = F.explode(F.array(*[F.lit(x) for x in ("age_group", "job_type", "qualification", "area")])).alias("column_name")
    return v.classes.unionByName(nation_classes(v, "state")).unionByName(regions.select(columns, "code", "name"))


def coded_customers(v: Views):
    key = c("c_custkey")
    region = v.table("nation").select(c("n_nationkey").alias("c_nationkey"), c("n_regionkey").alias("area"))
    return v.table("customer").join(region, "c_nationkey").select(
        key,
        (key % 4).alias("gender"),
        (key % 5).cast("int").alias("age_group"),
        (key % 6).alias("job_type"),
        F.when(key % 3 > 0, (key + 1) % 5).alias("qualification"),
        "area",
        c("c_nationkey").alias("state"),
        (key % 2).alias("scenario"),
    )


def meta(name: str):
    return F.try_element_at("extra_metadata", F.lit(name)).alias(name)


def sorted_map(column: str):
    """A map as text in key order."""
    entries = F.array_sort(F.map_entries(column))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")


def report(v: Views):
    return voice.voice_report(v.clips, v.winners.withColumn("speaker_id", c("speaker_id")))


REPORT_SQL = f"""
    SELECT language, speakers_seen, coalesce(n, 0) AS speakers_selected, speakers_seen - coalesce(n, 0) AS speakers_discarded,
           coalesce(p, 0) AS primary_tier_count, coalesce(n - p, 0) AS fallback_tier_count, {rnd('coalesce(total, 0)')} AS total_selected_duration_seconds,
           genders, CAST(0 AS BIGINT) AS uploaded_file_count
    FROM (SELECT language, count(DISTINCT speaker_id) AS speakers_seen FROM clips GROUP BY 1)
    LEFT JOIN (SELECT language, count(*) AS n, count(*) FILTER (selection_tier = 'primary_ge_target') AS p, sum(duration_seconds) AS total FROM winners GROUP BY 1) USING (language)
    LEFT JOIN (SELECT language, string_agg(gender || '=' || n, ',' ORDER BY gender) AS genders FROM (SELECT language, gender, count(*) AS n FROM winners GROUP BY 1, 2) GROUP BY 1) USING (language)"""


def flat_report(df):
    return df.withColumn("genders", sorted_map("gender_breakdown")).drop("gender_breakdown")


def stored_reports(v: Views):
    """Reports as stored documents: one whole, one with missing fields, one unreadable."""
    whole = F.to_json(F.struct(*[x for x in report(v).columns]))
    rows = report(v).select(F.when(c("language") == "hindi", cat('{"language":"hindi","speakers_seen":', text_of(c("speakers_seen")), "}")).otherwise(whole).alias("value"))
    broken = rows.select(F.substring("value", 1, 12).alias("value"))
    schema = (
        "language string, speakers_seen bigint, speakers_selected bigint, speakers_discarded bigint, primary_tier_count bigint, "
        "fallback_tier_count bigint, total_selected_duration_seconds double, gender_breakdown map<string,bigint>, uploaded_file_count bigint, _corrupt_record string"
    )
    parsed = rows.unionByName(broken).select(F.from_json("value", schema).alias("r")).select("r.*")
    return flat_report(publish.default_report(parsed))


def completeness(v: Views):
    return voice.export_completeness(v.listing, report(v))


COMPLETE_SQL = """
    SELECT language, speakers_selected, coalesce(k, 0) AS complete_speakers, coalesce(k, 0) = speakers_selected AND coalesce(k, 0) > 0 AS is_complete
    FROM (SELECT language, count(*) AS speakers_selected FROM winners GROUP BY 1)
    LEFT JOIN (SELECT language, count(*) FILTER (a AND b) AS k FROM (
        SELECT language, gender, speaker, bool_or(file = 'audio.wav') AS a, bool_or(file = 'metadata.json') AS b FROM listing GROUP BY 1, 2, 3) GROUP BY 1) USING (language)"""


def register(q) -> None:
    q(
        "source_accented_english",
        lambda v: v.accented_clips.select(*CLIP, "audio_path", *map(meta, EXTRA)),
        f"""SELECT speaker_id, language, gender, duration_seconds, transcript, source_dataset, source_index, audio_path, {', '.join(EXTRA)} FROM accented_clips JOIN (SELECT source_index, {', '.join(x for x in EXTRA if x not in KEPT)} FROM accented_raw) USING (source_index)""",
    )
    q(
        "source_indic",
        lambda v: v.indic_clips.select(*CLIP, "audio_path", meta("district"), meta("snr").cast("bigint").alias("snr")),
        "SELECT speaker_id, language, gender, duration_seconds, transcript, source_dataset, source_index, audio_path, district, snr FROM indic_clips",
    )
    q(
        "source_language_filter",
        lambda v: clip_sources.language_filter(v.table("documents"), "lang", "fr").select("doc_id", "lang", "n_chars"),
        "SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'fr'",
    )
    q(
        "source_named_filter",
        lambda v: clip_sources.named_filter(v.table("customer"), nation_classes(v, "c_nationkey"), "c_nationkey", v.table("nation").where("n_nationkey = 6").first().n_name).select("c_custkey", "c_nationkey"),
        "SELECT c_custkey, c_nationkey FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_name = (SELECT n_name FROM nation WHERE n_nationkey = 6)",
    )
    q(
        "class_columns_decode",
        lambda v: voice.decode_classes(coded_customers(v), class_table(v)),
        """SELECT c_custkey, coalesce(g.name, CAST(c_custkey % 4 AS VARCHAR)) AS gender, a.r_name AS age_group, coalesce(j.r_name, CAST(c_custkey % 6 AS VARCHAR)) AS job_type,
                  CASE WHEN c_custkey % 3 > 0 THEN s.r_name END AS qualification, n.r_name AS area, m.n_name AS state, CAST(c_custkey % 2 AS VARCHAR) AS scenario
           FROM customer JOIN nation m ON m.n_nationkey = c_nationkey JOIN region n ON n.r_regionkey = m.n_regionkey LEFT JOIN (VALUES (0, 'Male'), (1, 'Female'), (2, 'unknown')) g(code, name) ON g.code = c_custkey % 4
           LEFT JOIN region a ON a.r_regionkey = c_custkey % 5 LEFT JOIN region j ON j.r_regionkey = c_custkey % 6 LEFT JOIN region s ON s.r_regionkey = (c_custkey + 1) % 5""",
    )
    q(
        "source_union",
        lambda v: clip_sources.union_sources({"english": v.accented_clips, "hindi": v.indic_clips}).select(
            "language_order", *CLIP
        ),
        """SELECT 0 AS language_order, speaker_id, language, gender, duration_seconds, transcript, source_dataset, source_index FROM accented_clips
           UNION ALL SELECT 1, speaker_id, language, gender, duration_seconds, transcript, source_dataset, source_index FROM indic_clips""",
    )
    q(
        "undecoded_audio_scan",
        lambda v: clip_sources.undecoded(v.table("pages").select(c("url").alias("path"), c("html").cast("binary").alias("content"))).select(
            "path", "length", F.sha1("content").alias("digest")
        ),
        "SELECT url AS path, strlen(html) AS length, sha1(html) AS digest FROM pages",
    )
    q("voice_report_scan", stored_reports, f"""
        SELECT language, speakers_seen, CASE WHEN hi THEN 0 ELSE speakers_selected END AS speakers_selected, CASE WHEN hi THEN 0 ELSE speakers_discarded END AS speakers_discarded,
               CASE WHEN hi THEN 0 ELSE primary_tier_count END AS primary_tier_count, CASE WHEN hi THEN 0 ELSE fallback_tier_count END AS fallback_tier_count,
               CASE WHEN hi THEN 0.0 ELSE total_selected_duration_seconds END AS total_selected_duration_seconds, uploaded_file_count, CASE WHEN hi THEN '' ELSE genders END AS genders
        FROM (SELECT *, language = 'hindi' AS hi FROM ({REPORT_SQL}))""")
    q(
        "sink_path_speaker",
        lambda v: voice.speaker_paths(v.winners).select("speaker_id", "language", "file", "path"),
        """SELECT speaker_id, language, file, language || '/' || gender || '/' || coalesce(nullif(regexp_replace(replace(trim(speaker_id), ' ', '_'), '[^a-zA-Z0-9_-]+', '', 'g'), ''), 'unknown') || '/' || file AS path
           FROM winners, (VALUES ('audio.wav'), ('metadata.json')) f(file)""",
    )
    q(
        "speaker_metadata",
        lambda v: voice.speaker_metadata(
            voice.best_clip_per_speaker(v.accented_clips), c("duration_seconds") * F.lit(0.999)
        ).withColumn("job", F.try_element_at("metadata", F.lit("job_category"))).drop("metadata"),
        f"""SELECT speaker_id, language, gender, transcript, {rnd('d * 0.999::DOUBLE', 3)} AS duration_seconds, {rnd('d', 3)} AS original_duration_seconds,
                  CASE WHEN d >= 10 THEN 'primary_ge_target' ELSE 'fallback_below_target' END AS selection_tier, source_dataset, source_index, 'audio.wav' AS audio_file,
                  (SELECT r.job_category FROM accented_raw r WHERE r.source_index = w.source_index) AS job
           FROM (SELECT *, duration_seconds AS d, row_number() OVER (PARTITION BY speaker_id ORDER BY duration_seconds < 10, abs(duration_seconds - 10), source_index) AS rn
                 FROM accented_clips WHERE duration_seconds >= 5) w WHERE rn = 1""",
    )
    q("gender_normalise", lambda v: v.clips.select("source_index", "gender"), f"SELECT event_id AS source_index, {_gender(EVENT_GENDER)} AS gender FROM events")
    q(
        "speaker_code_extract",
        lambda v: v.accented_raw.select("source_index", voice.speaker_code(c("audio_path")).alias("code")),
        """SELECT source_index, CASE WHEN m THEN lower(regexp_extract(audio_path, '(?i)([fm][0-9]{2,6})_chunk', 1)) END AS code
           FROM (SELECT *, regexp_matches(audio_path, '(?i)[fm][0-9]{2,6}_chunk') AS m FROM accented_raw)""",
    )
    finger = " || '|' || ".join(f"coalesce({f}, 'None')" for f in fv.FINGERPRINT_FIELDS)
    q(
        "speaker_fingerprint",
        lambda v: v.accented_raw.select("source_index", voice.speaker_fingerprint(c("source_index")).alias("fingerprint")),
        f"""SELECT source_index, CASE WHEN trim({finger}, '|') = '' THEN 'unknown_spk_' || source_index ELSE 'spk_' || substr(sha1({finger}), 1, 10) END AS fingerprint FROM accented_raw""",
    )
    q(
        "speaker_id_default",
        lambda v: v.indic_raw.select(
            "doc_id",
            voice.speaker_or_unknown(c("speaker_id"), c("source_index")).alias("speaker_id"),
            voice.speaker_or_unknown(c("doc_id") % 5, c("source_index")).alias("number_id"),
        ),
        """SELECT doc_id, CASE WHEN coalesce(speaker_id, '') = '' THEN 'unknown_spk_' || source_index ELSE speaker_id END AS speaker_id,
                  CASE WHEN doc_id % 5 = 0 THEN 'unknown_spk_' || source_index ELSE CAST(doc_id % 5 AS VARCHAR) END AS number_id FROM indic_raw""",
    )
    q("label_decode", lambda v: v.indic_raw.select("doc_id", "gender"), "SELECT doc_id, gender FROM indic_raw")
    q(
        "extra_metadata_map",
        lambda v: v.accented_clips.select("source_index", F.explode("extra_metadata").alias("name", "value")).where("value is not null"),
        """SELECT source_index, name, value FROM (SELECT source_index, age_group, primary_language, native_place_state, native_place_district, highest_qualification, job_category, occupation_domain FROM accented_raw)
           UNPIVOT (value FOR name IN (age_group, primary_language, native_place_state, native_place_district, highest_qualification, job_category, occupation_domain))""",
    )
    q(
        "folder_slug",
        lambda v: v.table("part").select("p_partkey", slug(cat(" ", c("p_name"), "/", c("p_brand"))).alias("folder"), slug(F.regexp_replace("p_name", "[a-z]", "*")).alias("starred")),
        """SELECT p_partkey, coalesce(nullif(regexp_replace(replace(trim(' ' || p_name || '/' || p_brand), ' ', '_'), '[^a-zA-Z0-9_-]+', '', 'g'), ''), 'unknown') AS folder,
                  coalesce(nullif(regexp_replace(replace(trim(regexp_replace(p_name, '[a-z]', '*', 'g')), ' ', '_'), '[^a-zA-Z0-9_-]+', '', 'g'), ''), 'unknown') AS starred FROM part""",
    )
    q(
        "winner_bytes_fetch",
        lambda v: voice.winner_bytes(
            v.winners,
            v.table("events").select(F.lit("events").alias("source_dataset"), c("event_id").alias("source_index"), F.encode("props", "UTF-8").alias("content")),
        ).select("speaker_id", "source_index", F.decode("content", "UTF-8").alias("content")),
        "SELECT w.speaker_id, w.source_index, e.props AS content FROM winners w JOIN events e ON e.event_id = w.source_index",
    )
    q("voice_report", lambda v: flat_report(report(v)), REPORT_SQL)
    q("export_completeness", completeness, COMPLETE_SQL)
    q(
        "best_clip_per_speaker",
        lambda v: voice.best_clip_per_speaker(v.clips, keys=("speaker_id", "language")).select(*CLIP, "selection_tier"),
        "SELECT speaker_id, language, gender, duration_seconds, transcript, source_dataset, source_index, selection_tier FROM winners",
    )
    q(
        "speaker_cap",
        lambda v: voice.speaker_cap(v.winners, 500).select("speaker_id", "first_qualifying_index", "duration_seconds"),
        "SELECT speaker_id, first_qualifying_index, duration_seconds FROM winners ORDER BY first_qualifying_index LIMIT 500",
    )
    q(
        "anonymised_folder",
        lambda v: voice.anonymised_folders(v.winners).select("speaker_id", "gender", "folder"),
        "SELECT speaker_id, gender, 'speaker_' || row_number() OVER (PARTITION BY gender ORDER BY speaker_id) AS folder FROM winners",
    )
    q(
        "discarded_speakers",
        lambda v: voice.discarded_speakers(v.clips, v.winners).orderBy("speaker_id"),
        "SELECT DISTINCT speaker_id FROM clips WHERE speaker_id NOT IN (SELECT speaker_id FROM winners) ORDER BY 1",
    )
    q(
        "resume_skip",
        lambda v: voice.resume_plan(v.clips.select("language").distinct(), completeness(v)),
        f"SELECT language, CASE WHEN is_complete THEN 'reuse' ELSE 'recompute' END AS action FROM ({COMPLETE_SQL})",
    )
