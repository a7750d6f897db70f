"""Inputs of the check queries, derived from the whole given tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duologue.functions import fixed_values as fv
from duologue.functions.text import round_half_up, squeeze
from duologue.operators import assembly, planning, turns, voice
from duologue.operators.ordered import number_rows
from duologue.operators.planning import INSTANCE
from duologue.plans import publish
from duologue.sources import clips as clip_sources


def pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


GENDER_BY_EVENT = {"purchase": "M", "signup": " Female", "view": "x", "click": ""}
LANG_INSTANCE = {"en": 0, "fr": 1, "de": 2, "es": 3}
CLASSES = [("gender", 0, "Male"), ("gender", 1, "Female"), ("gender", 2, "unknown")]


def event_gender(event_type: Column) -> Column:
    cells: list[Column] = []
    for name, value in GENDER_BY_EVENT.items():
        cells += [F.lit(name), F.lit(value)]
    return F.try_element_at(F.create_map(*cells), event_type)


def cat(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def text_of(column: Column) -> Column:
    return column.cast("string")


def json_string(column: Column) -> Column:
    doc = F.to_json(F.struct(column.alias("v")))
    return F.substring(doc, F.lit(6), F.length(doc) - 6)


class Views:
    """Lazy views of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # ---- voice side ----------------------------------------------------------
    @staticmethod
    def as_clips(events: DataFrame) -> DataFrame:
        c = F.col
        return events.select(
            cat("u", text_of(c("user_id")), "_", F.date_format("ts", "MMdd")).alias("speaker_id"),
            F.when(c("user_id") % 3 == 0, "hindi").otherwise("english").alias("language"),
            voice.gender(event_gender(c("event_type"))).alias("gender"),
            F.floor("value").cast("double").alias("duration_seconds"),
            c("props").alias("transcript"),
            F.lit("events").alias("source_dataset"),
            c("event_id").alias("source_index"),
        )

    @cached_property
    def clips(self) -> DataFrame:
        return self.as_clips(self.table("events"))

    @cached_property
    def winners(self) -> DataFrame:
        return voice.best_clip_per_speaker(self.clips, keys=("speaker_id", "language"))

    @cached_property
    def accented_raw(self) -> DataFrame:
        c = F.col
        user, event = c("user_id"), c("event_id")
        blank = event % 35 == 0
        field = lambda value: F.when(blank, "").otherwise(value)
        return self.table("events").select(
            event.alias("source_index"),
            F.when(
                event % 5 != 0,
                cat("wavs/", text_of(event), F.when(event % 2 == 0, "_f").otherwise("_M"), text_of(user + 1000), "_chunk_0.wav"),
            )
            .otherwise(cat("wavs/", text_of(event), "_clip_0.wav"))
            .alias("audio_path"),
            F.when(event % 11 != 0, c("value")).alias("duration"),
            F.when(event % 13 != 0, c("props")).alias("text"),
            field(event_gender(c("event_type"))).alias("gender"),
            field(cat("a", text_of(user % 4))).alias("age_group"),
            field(cat("lang", text_of(user % 4))).alias("primary_language"),
            field(cat("d", text_of(user % 50))).alias("native_place_district"),
            field(F.when(user % 6 != 0, cat("s", text_of(user % 6)))).alias("native_place_state"),
            field(cat("q", text_of(user % 3))).alias("highest_qualification"),
            field(cat("j", text_of(user % 5))).alias("job_category"),
            field(cat("o", text_of(user % 7))).alias("occupation_domain"),
        )

    @cached_property
    def classes(self) -> DataFrame:
        return self.spark.createDataFrame(CLASSES, "column_name string, code int, name string")

    @cached_property
    def indic_coded(self) -> DataFrame:
        c = F.col
        doc = c("doc_id")
        return self.table("documents").select(
            doc,
            c("lang"),
            F.when(doc % 9 == 0, "")
            .when(doc % 9 == 1, F.lit(None).cast("string"))
            .when(doc % 9 == 2, "0")
            .otherwise(cat(c("source"), "_", text_of(doc % 17)))
            .alias("speaker_id"),
            F.when(doc % 5 < 4, (doc % 5).cast("int")).alias("gender"),
            F.when(doc % 4 == 0, "").when(doc % 4 > 1, c("text")).alias("normalized"),
            F.when(doc % 8 == 1, "").when(doc % 4 != 0, c("text")).alias("verbatim"),
            c("text"),
            (c("n_chars") / F.lit(13.0)).alias("duration"),
            cat(c("source"), "/", text_of(doc), ".wav").alias("audio_path"),
            c("source").alias("district"),
            (c("n_chars") % 40).alias("snr"),
        )

    @cached_property
    def indic_raw(self) -> DataFrame:
        english = clip_sources.language_filter(self.indic_coded, "lang", "en")
        numbered = voice.source_ordinal(english, "doc_id")
        return voice.decode_labels(numbered, self.classes, "gender")

    @cached_property
    def accented_clips(self) -> DataFrame:
        return clip_sources.accented_english(self.accented_raw, "accented")

    @cached_property
    def indic_clips(self) -> DataFrame:
        return clip_sources.indic(self.indic_raw, "indic")

    @cached_property
    def listing(self) -> DataFrame:
        """Exported files: the winners', less the metadata of short-lived users."""
        files = voice.speaker_paths(self.winners)
        lost = (F.col("language") == "hindi") & (F.col("file") == "metadata.json") & (F.col("duration_seconds") == 10)
        return files.where(~lost).select("language", "gender", F.col("speaker_id").alias("speaker"), "file")

    # ---- dialogue side -------------------------------------------------------
    def as_turns(self, conversations: DataFrame) -> DataFrame:
        c = F.col
        spoken = conversations.where(c("role") != "system").select(
            F.floor(c("conv_id") / 10).cast("bigint").alias("conv_id"), c("conv_id").alias("part"), "turn", "role", "text"
        )
        placed = number_rows(spoken, ["conv_id"], ["part", "turn"])
        h = (c("part") * 31 + c("turn")) % 10
        r = (c("part") + c("turn") * 3) % 11
        return placed.select(
            "conv_id",
            "pos",
            F.when(c("role") == "assistant", "speaker_1").otherwise("speaker_2").alias("speaker"),
            F.when((c("pos") == 1) | (h < 5), "Normal")
            .when(h < 7, "Backchanneling")
            .when(h < 9, "Overlapping")
            .otherwise("Interruption")
            .alias("turn_type"),
            F.when(r < 10, r / F.lit(10.0)).alias("ratio"),
            pick(["Happy", "Sad", "Angry", "Neutral", None], (c("part") * 5 + c("turn")) % 5).alias("emotion"),
            squeeze(c("text")).alias("text"),
        )

    @cached_property
    def turns_raw(self) -> DataFrame:
        return self.as_turns(self.table("conversations"))

    @cached_property
    def profiles(self) -> DataFrame:
        """Speaker defaults per conversation, from the corpus row of the same number."""
        return self.corpus.select(F.col(INSTANCE).alias("conv_id"), "agent_emotion", "user_emotion")

    @cached_property
    def turns_full(self) -> DataFrame:
        return turns.with_default_emotion(self.turns_raw, self.profiles)

    @cached_property
    def tagged(self) -> DataFrame:
        c = F.col
        tag = F.when(c("turn_type") == "Normal", "normal").when(c("turn_type") == "Backchanneling", "backchannel").when(
            c("turn_type") == "Overlapping", "overlap"
        ).otherwise("interrupt")
        other = F.when(c("speaker") == "speaker_1", "2").otherwise("1")
        ref = F.when(c("turn_type") == "Normal", "").otherwise(
            cat(" -> S", other, F.when((c("turn_type") != "Interruption") & c("ratio").isNotNull(), cat("@", text_of(c("ratio").cast("decimal(3,2)")))).otherwise(""))
        )
        line = cat(
            "S", F.substring("speaker", 9, 1), ":",
            F.when(c("pos") % 9 == 4, "").otherwise(cat(" [", tag, "]")),
            ref, " ",
            F.when(c("pos") % 13 == 5, "haan").when(c("pos") % 17 == 6, cat("—", c("text"))).otherwise(c("text")),
            F.when(c("emotion").isNull(), "").otherwise(cat(" (", c("emotion"), ")")),
        )
        return self.turns_raw.select("conv_id", "pos", line.alias("line"))

    @cached_property
    def blobs(self) -> DataFrame:
        """One raw transcript per conversation row, with fences and stray prose."""
        c = F.col
        return self.table("conversations").select(
            "conv_id",
            "turn",
            F.when(c("turn") == 3, "no turns here")
            .otherwise(cat("```\nHere it is\n s1 : ", F.replace(c("text"), F.lit("\n"), F.lit("\n\n  S2: ")), "\nThe end\n```"))
            .alias("transcript"),
        )

    @cached_property
    def items(self) -> DataFrame:
        """Formatter replies, one map per turn, with loose spellings."""
        c = F.col
        loose = {"Normal": "NORMAL", "Overlapping": "overlap", "Interruption": "interrupted", "Backchanneling": " Back-Channel"}
        cells: list[Column] = []
        for k, v in loose.items():
            cells += [F.lit(k), F.lit(v)]
        kind = F.element_at(F.create_map(*cells), c("turn_type"))
        item = F.create_map(
            F.lit("TURN_ID"), cat("t", text_of(c("pos"))),
            F.lit("Speaker"), F.when(c("pos") % 4 == 0, cat("S", F.substring("speaker", 9, 1))).when(c("pos") % 4 == 1, F.upper("speaker")).otherwise(c("speaker")),
            F.lit("text"), F.when(c("pos") % 19 == 0, "  ").otherwise(cat(" ", c("text"), " ")),
            F.lit("turn_type"), F.when(c("pos") % 23 == 0, "mystery").otherwise(kind),
            F.lit("emotion"), F.lower("emotion"),
            F.lit("overlaps_with"), F.when(c("turn_type") != "Normal", cat("t", text_of(c("pos") - 1))),
            F.lit("join_ratio"), F.when(c("pos") % 7 == 0, "about half").when(c("pos") % 7 == 1, "1.7").otherwise(text_of(c("ratio").cast("decimal(3,2)"))),
        )
        return self.turns_raw.select("conv_id", "pos", item.alias("item"))

    def as_timed(self, turns_raw: DataFrame) -> DataFrame:
        """Turns in groups of three with planted faults, by ``k``."""
        c = F.col
        pos, k = c("pos"), (c("conv_id") * 7 + c("pos")) % 40
        m, g = pos % 3, F.floor((pos - 1) / 3)
        later = F.when(m == 2, pos + 1).otherwise(pos)
        kind = pick(fv.RELATION_KINDS, F.floor(later / 3) % 3)
        base = (g * 15).cast("double")
        start = (
            F.when(m == 1, base)
            .when(m == 2, base + 5)
            .when(k == 17, base + 5)
            .when(kind == "Interruption", F.when(k == 15, base + 11).otherwise(base + 9.6))
            .when((kind == "Overlapping") & (k == 13), base + 9)
            .otherwise(base + 6)
        )
        end = (
            F.when(m == 1, base + 4)
            .when(m == 2, base + 10)
            .when(kind == "Interruption", F.when(k == 14, base + 9.8).otherwise(base + 13))
            .when(kind == "Backchanneling", F.when(k == 16, base + 11).otherwise(base + 7))
            .otherwise(base + 12)
        )
        name = lambda p: cat("t", text_of(p))
        related = m != 1
        partner = F.when(m == 2, pos + 1).otherwise(pos - 1)
        cut = (m == 2) & (kind == "Interruption")
        # some interrupters are themselves interrupted, by the first turn
        cutter_cut = (m == 0) & (kind == "Interruption") & (c("conv_id") % 3 == 0) & (pos % 2 == 0)
        return turns_raw.select(
            "conv_id",
            "pos",
            F.when(k == 1, name(pos - 1)).otherwise(name(pos)).alias("turn_id"),
            F.when(k == 2, "speaker_9").otherwise(c("speaker")).alias("speaker"),
            "text",
            F.when(k == 3, "Bored").otherwise(F.coalesce("emotion", F.lit("Neutral"))).alias("emotion"),
            F.when(k != 6, start).alias("planned_start_sec"),
            F.when(k == 5, start - 1).when(k != 7, end).alias("planned_end_sec"),
            F.when(k != 24, start + 0.25).alias("real_start_sec"),
            F.when(k != 24, end + 0.5).alias("real_end_sec"),
            F.lit(None).cast("double").alias("error_time"),
            F.when(k == 4, "Chatter").when(m == 0, kind).otherwise("Normal").alias("turn_type"),
            F.when(related, F.when(k == 8, None).when(k == 10, "t9999").otherwise(name(partner))).alias("overlaps_with"),
            F.when(related & ~k.isin(8, 11), F.when(k == 9, "Overlapping").when(k == 12, "Weird").otherwise(kind)).alias("overlaps_kind"),
            ((cut & ~k.isin(18, 20)) | k.isin(19, 21, 22) | cutter_cut).alias("interrupted"),
            F.when(k == 19, None)
            .when(k == 20, "t1")
            .when(k == 21, name(pos - 1))
            .when((k == 22) | cutter_cut, "t1")
            .when(cut & (k != 18), name(pos + 1))
            .alias("interrupted_by"),
            F.array(*[F.lit(f) for f in fv.TURN_FIELDS]).alias("_all"),
            (k == 23).alias("_short"),
        ).select(
            "*",
            F.when(c("_short"), F.array_except("_all", F.array(F.lit("emotion"), F.lit("real_end_sec"))))
            .otherwise(c("_all"))
            .alias("present_keys"),
        ).drop("_all", "_short")

    @cached_property
    def turns_timed(self) -> DataFrame:
        return self.as_timed(self.turns_raw)

    @cached_property
    def edits(self) -> DataFrame:
        """Two ordered edits for many turns; some delete, some are unusable."""
        c = F.col
        k = (c("conv_id") + c("pos")) % 12
        first = self.turns_timed.select(
            "conv_id",
            "turn_id",
            F.lit(1).alias("edit_no"),
            F.when(k == 3, " DELETE ").otherwise("replace").alias("action"),
            F.when(k < 5, cat(" short ", text_of(c("pos")))).otherwise("  ").alias("text"),
            F.when(k < 7, "sad").otherwise("confused").alias("emotion"),
            F.when(k == 5, "overlap").alias("turn_type"),
        )
        second = self.turns_timed.where((c("conv_id") + c("pos")) % 12 < 4).select(
            "conv_id",
            F.when(k == 2, "t0").otherwise(c("turn_id")).alias("turn_id"),
            F.lit(2).alias("edit_no"),
            F.lit("replace").alias("action"),
            F.when(k == 1, "again").alias("text"),
            F.lit("ANGRY").alias("emotion"),
            F.lit(None).cast("string").alias("turn_type"),
        )
        return first.unionByName(second)

    # ---- corpus side ---------------------------------------------------------
    @cached_property
    def corpus(self) -> DataFrame:
        c, key = F.col, F.col("c_custkey")
        emotions = fv.EMOTIONS
        accents = ["Normal", "Bengali", "Punjabi", "Gujarati", "West", "South Indian", "Odd"]
        return self.table("customer").select(
            key.alias(INSTANCE),
            key.alias("row_pos"),
            F.when(c("c_mktsegment").isin("HOUSEHOLD", "BUILDING"), "Hindi")
            .when(c("c_mktsegment") == "AUTOMOBILE", "English")
            .otherwise("Hinglish")
            .alias("language"),
            F.when(key % 11 != 0, pick(emotions, key % 4)).alias("agent_emotion"),
            pick(emotions, F.floor(key / 4) % 4).alias("user_emotion"),
            pick(accents, key % 7).alias("agent_accent"),
            pick(accents, F.floor(key / 7) % 7).alias("user_accent"),
            pick(["F-M", "MF", "mm", "FF", None], key % 5).alias("gender_pair"),
            (1200 + (key % 7) * 600).cast("double").alias("duration_sec"),
        )

    @staticmethod
    def as_outcomes(orders: DataFrame) -> DataFrame:
        c = F.col
        return orders.select(
            c("o_custkey").alias(INSTANCE),
            c("o_orderdate").alias("finished_at"),
            c("o_orderkey").alias("finish_key"),
            (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("finish_month"),
            (240 + (c("o_orderkey") * 37) % 241).cast("double").alias("duration_sec"),
            (c("o_orderstatus") == "F").alias("accepted"),
            cat("topic ", text_of(c("o_orderkey") % 50)).alias("title"),
        )

    ORDER = ["finished_at", "finish_key"]

    @cached_property
    def outcomes(self) -> DataFrame:
        return self.as_outcomes(self.table("orders"))

    @cached_property
    def accepted(self) -> DataFrame:
        return self.outcomes.where("accepted")

    @cached_property
    def topics(self) -> DataFrame:
        """Accepted conversations as topics; every seventh order stands for one read back from storage."""
        c = F.col
        kind = F.when(c("finish_key") % 3 > 0, "advice").alias("conversation_type")
        return self.accepted.select(INSTANCE, "finished_at", "finish_key", "title", kind, (c("finish_key") % 7 == 0).alias("resumed"))

    @cached_property
    def accepted_indexed(self) -> DataFrame:
        return planning.number_conversations(self.accepted, self.ORDER)

    @cached_property
    def progress(self) -> DataFrame:
        return planning.progress_rollup(self.accepted)

    @cached_property
    def corpus_progress(self) -> DataFrame:
        return planning.corpus_progress(self.corpus, self.progress)

    @cached_property
    def runs(self) -> DataFrame:
        return planning.failure_runs(self.outcomes, self.ORDER)

    @cached_property
    def skipped(self) -> DataFrame:
        return planning.skip_entries(planning.abandoned_instances(self.runs), self.corpus_progress)

    @cached_property
    def history(self) -> DataFrame:
        c = F.col
        cells: list[Column] = []
        for k, v in LANG_INSTANCE.items():
            cells += [F.lit(k), F.lit(v).cast("bigint")]
        rows = self.table("documents").select(
            F.element_at(F.create_map(*cells), c("lang")).alias(INSTANCE),
            "doc_id",
            cat(c("source"), " ", text_of(c("n_chars"))).alias("title"),
            pick(fv.TOPIC_DOMAINS, F.substring("source", 4, 3).cast("int")).alias("domain"),
            F.floor(c("doc_id") / 4096).alias("_blk"),
        )
        return number_rows(rows, [INSTANCE], ["doc_id"], ["_blk"], "pos").drop("_blk")

    @cached_property
    def attempts(self) -> DataFrame:
        """Judged attempts: order lines as attempts of their order."""
        c = F.col
        k = (c("l_partkey") + c("l_linenumber")) % 5
        return self.table("lineitem").select(
            c("l_orderkey").alias("conv_id"),
            F.when(c("l_suppkey") % 2 == 0, "content").otherwise("format").alias("stage"),
            c("l_linenumber").alias("attempt"),
            F.when(k == 0, "PASS").when(k != 1, "FAIL").alias("verdict"),
            (c("l_quantity") > 20).alias("manual_clean"),
            F.struct("l_partkey", "l_suppkey").alias("_tie"),
        ).drop("_tie")

    # ---- replies and usage ---------------------------------------------------
    @cached_property
    def replies(self) -> DataFrame:
        c, doc = F.col, F.col("doc_id")
        joined = self.table("documents").join(self.table("labels"), "doc_id", "left")
        body = cat(
            '{"verdict":"', F.when(c("quality") == 1, "pass").when(c("quality") == 0, "FAIL").otherwise("maybe"),
            '","realism_score":', text_of(c("n_chars") % 13),
            ',"corpus_match_score":"', text_of(c("n_chars") % 9),
            '.5","corpus_field_matches":{"language":true,"agent_emotion":',
            F.when(c("quality") == 1, "true").otherwise("false"),
            ',"user_emotion":1},"strengths":["', c("source"), '",""],"issues":[{"severity":"',
            F.when(c("toxic") == 1, "CRITICAL").otherwise("odd"),
            '","turn_ref":"t', text_of(doc % 30), '","turn_id":"t', text_of(doc % 30), '","description":"', c("lang"), " chars ", text_of(c("n_chars")),
            '"},{"severity":"major","description":" "}],"feedback":', json_string(c("text")), "}",
        )
        shouted = F.replace(F.replace(body, F.lit('"verdict"'), F.lit('"VERDICT"')), F.lit('"realism_score"'), F.lit('"REALISM_SCORE"'))
        k = doc % 10
        return joined.select(
            "doc_id",
            F.when(k == 0, cat("```json\n", body, "\n```"))
            .when(k == 1, shouted)
            .when(k == 2, F.substring(body, F.lit(1), F.length(body) - 1))
            .when(k == 3, cat("[", body, "]"))
            .otherwise(body)
            .alias("reply"),
        )

    @cached_property
    def calls(self) -> DataFrame:
        c = F.col
        used = c("l_orderkey") % 19 != 0
        count = lambda value: F.when(used, value.cast("bigint"))
        return self.table("lineitem").select(
            cat(c("l_returnflag"), "/", c("l_linestatus")).alias("model"),
            count(c("l_quantity")).alias("input_tokens"),
            count(c("l_linenumber") * 10).alias("output_tokens"),
            count(F.when(c("l_suppkey") % 2 == 0, 5).otherwise(0)).alias("cache_tokens"),
        )

    @cached_property
    def usage_log(self) -> DataFrame:
        c = F.col
        k = c("l_orderkey") % 5
        i, o, n = text_of(c("l_quantity").cast("bigint")), text_of(c("l_linenumber") * 10), text_of(c("l_suppkey") % 7)
        return self.table("lineitem").select(
            "l_orderkey",
            "l_linenumber",
            (k == 1).alias("streamed"),
            F.when(k < 2, cat('{"usage":{"prompt_tokens":', i, ',"completion_tokens":', o, ',"prompt_tokens_details":{"cached_tokens":', n, "}}}"))
            .when(k == 2, cat('{"usage_metadata":{"prompt_token_count":', i, ',"candidates_token_count":', o, ',"cached_content_token_count":', n, ',"thoughts_token_count":3}}'))
            .when(k == 3, cat('{"usage":{"prompt_tokens":', i, ',"completion_tokens":null}}'))
            .otherwise('{"choices":[]}')
            .alias("reply"),
        )

    @cached_property
    def error_log(self) -> DataFrame:
        """Failed calls: the events table as an error log."""
        c, k = F.col, F.col("event_id") % 8
        phrase = pick(fv.LIMIT_PHRASES, F.floor(c("event_id") / 8) % 10)
        return self.table("events").select(
            "event_id",
            F.when(k == 0, 429).when(k == 1, 500).alias("status"),
            F.when(k == 2, "RateLimitError").otherwise("ValueError").alias("error_type"),
            F.when(k == 3, cat("Server said: ", F.upper(phrase), " ", c("props")))
            .when(k == 4, cat("HTTP 429 ", c("props")))
            .when(k == 5, cat("status_code=429", c("props")))
            .otherwise(cat("failed: ", c("props")))
            .alias("message"),
        )

    # ---- scripts -------------------------------------------------------------
    @cached_property
    def scripts_raw(self) -> DataFrame:
        """Documents as scripts: their lines are spoken in turn by two speakers."""
        c, doc = F.col, F.col("doc_id")
        lines = F.split("text", "\n", -1)
        turn = lambda line, i: F.concat(
            F.lit('{"speaker":"'),
            F.when((doc % 20 == 2) & (i == 0), "ghost").when(i % 2 == 0, "user1").otherwise("user2"),
            F.lit('","text":'), json_string(line),
            F.when(i % 3 == 0, ',"gap":0.3').otherwise(""),
            F.when(i % 4 == 0, ',"overlap":0.4').otherwise(""),
            F.lit("}"),
        )
        body = cat(
            '{"conversation_id":"c', text_of(doc), '","language":"', c("lang"), '","speakers":{"user1":{"voice":"a"}',
            F.when(doc % 20 == 1, "").otherwise(',"user2":{"voice":"b"}'), '},"turns":[', F.array_join(F.transform(lines, turn), ","), "]}",
        )
        return self.table("documents").select(
            "doc_id", F.when(doc % 20 == 0, F.substring(body, F.lit(1), F.length(body) - 1)).otherwise(body).alias("value")
        )

    @cached_property
    def scripts(self) -> DataFrame:
        return assembly.load_scripts(self.scripts_raw)

    @cached_property
    def clip_turns(self) -> DataFrame:
        seconds = round_half_up(F.length("text") / F.lit(13.0), 2)
        return assembly.script_turns(self.scripts).withColumn("duration", seconds)

    @cached_property
    def scheduled(self) -> DataFrame:
        return assembly.schedule(self.clip_turns)

    @cached_property
    def merged_words(self) -> DataFrame:
        return assembly.merged_words(self.scheduled)

    # ---- files ---------------------------------------------------------------
    @cached_property
    def local_files(self) -> DataFrame:
        return self.table("pages").select(F.regexp_replace("url", "^https?://", "").alias("path"))

    @cached_property
    def remote_files(self) -> DataFrame:
        """Pages that carry a label are already stored."""
        path = cat("bucket/", F.regexp_replace("url", "^https?://", ""))
        pages = self.table("pages").withColumnRenamed("page_id", "doc_id")
        return pages.join(self.table("labels").select("doc_id"), "doc_id", "left_semi").select(path.alias("path"))

    @cached_property
    def remote_relative(self) -> DataFrame:
        return publish.relative_listing(self.remote_files, "/bucket/")
