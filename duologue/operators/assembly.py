"""From scripts and clips to word-aligned, channel-swapped variants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duologue.functions.text import round_half_up, squeeze, strip
from duologue.operators.ordered import BLOCK_ROWS, block_of, block_window, carry_over, number_rows
from duologue.session import cut_lineage
from duologue.sources.clips import wav_header

EXACT = "decimal(28,6)"

#: Words of a run, more in clips of more than the square of it, and words that a task sorts.
RUN_WORDS = 16
TASK_WORDS = 1_000_000

SCRIPT_SCHEMA = (
    "conversation_id string, language string, speakers map<string, struct<voice: string>>, "
    "turns array<struct<speaker: string, text: string, gap: double, overlap: double>>, _corrupt string"
)


def load_scripts(documents: DataFrame, column: str = "value") -> DataFrame:
    """Parse script documents; a bad one keeps its row with a ``drop_reason``.

    When a turn gives both gap and overlap, the overlap counts and the gap is 0.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = documents.withColumn("_s", F.from_json(F.col(column), SCRIPT_SCHEMA, options))
    s = F.col("_s")
    speakers = F.map_keys(s["speakers"])
    bad_speaker = F.try_element_at(
        F.filter(s["turns"], lambda t: ~F.coalesce(F.array_contains(speakers, t["speaker"]), F.lit(False))), F.lit(1)
    )
    blank = F.exists(s["turns"], lambda t: F.coalesce(strip(t["text"]), F.lit("")) == "")
    reason = (
        F.when(s.isNull() | s["_corrupt"].isNotNull() | s["turns"].isNull(), "load: unreadable document")
        .when(F.coalesce(F.size(speakers), F.lit(0)) != 2, "needs exactly two speakers")
        .when(bad_speaker.isNotNull(), F.concat(F.lit("unknown speaker: "), F.coalesce(bad_speaker["speaker"], F.lit("None"))))
        .when(blank, "empty text")
    )
    turns = F.transform(
        s["turns"],
        lambda t: F.struct(
            t["speaker"].alias("speaker"),
            t["text"].alias("text"),
            F.when(F.coalesce(t["overlap"], F.lit(0.0)) > 0, F.lit(0.0)).otherwise(F.coalesce(t["gap"], F.lit(0.0))).alias("gap"),
            F.coalesce(t["overlap"], F.lit(0.0)).alias("overlap"),
        ),
    )
    return parsed.select(
        *[c for c in documents.columns if c != column],
        s["conversation_id"].alias("conversation_id"),
        s["language"].alias("language"),
        F.array_sort(speakers).alias("speakers"),
        turns.alias("turns"),
        reason.alias("drop_reason"),
    )


def script_turns(scripts: DataFrame) -> DataFrame:
    """Kept scripts, one row per turn.

    Dropped scripts lose their turns here instead of being filtered: a filter would
    move below the parsing and parse every document again.
    """
    kept = F.when(F.col("drop_reason").isNull(), F.col("turns"))
    return scripts.select("conversation_id", "language", F.posexplode_outer(kept).alias("_p", "_t")).where("_t is not null").select(
        "conversation_id", "language", (F.col("_p") + 1).cast("bigint").alias("pos"), "_t.*"
    )


def production_report(scripts: DataFrame) -> DataFrame:
    return scripts.agg(
        F.count_if(F.col("drop_reason").isNull()).alias("num_produced"),
        F.count_if(F.col("drop_reason").isNotNull()).alias("num_dropped"),
    )


def schedule(
    clips: DataFrame,
    keys: Sequence[str] = ("conversation_id",),
    *,
    lead: float = 0.0,
    default_gap: float = 0.25,
    max_overlap: float = 1.0,
    size: int = BLOCK_ROWS,
) -> DataFrame:
    """Start and end of each clip ``(keys, pos, duration, gap, overlap)``.

    Each clip starts a gap after, or an overlap before, the end of the previous
    one, never below zero.  With ``T`` the running sum of steps, the clamped start
    is ``T - min(0, running minimum of T)``: two prefix operations, no loop.
    """
    exact = lambda v: v.cast(EXACT)
    gap = F.when(F.col("gap") > 0, F.col("gap")).otherwise(F.lit(default_gap))
    shift = F.when(F.col("overlap") > 0, -F.least(F.col("overlap"), F.lit(max_overlap))).otherwise(gap)
    step = F.when(F.col("pos") == 1, exact(F.lit(lead))).otherwise(exact(shift))
    upto = block_window(keys, ["_blk"], ["pos"]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = (
        clips.select("*", block_of(F.col("pos"), size).alias("_blk"), step.alias("_step"), exact(F.col("duration")).alias("_d"))
        .withColumn("_t", (F.sum(F.col("_step") + F.col("_d")).over(upto) - F.col("_d")).cast(EXACT))
        .withColumn("_low", F.min("_t").over(upto))
    )
    # One row per block: its length, and how low it dips below its own beginning.
    dips = local.groupBy(*keys, "_blk").agg(F.sum(F.col("_step") + F.col("_d")).cast(EXACT).alias("_len"), F.min("_t").alias("_dip"))
    earlier = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    begun = dips.withColumn("_base", F.coalesce(F.sum("_len").over(earlier).cast(EXACT), exact(F.lit(0))))
    entry = begun.select(*keys, "_blk", "_base", F.min(F.col("_base") + F.col("_dip")).over(earlier).cast(EXACT).alias("_before"))
    joined = local.join(entry, [*keys, "_blk"])
    lowest = F.least(exact(F.lit(0)), F.col("_before"), (F.col("_base") + F.col("_low")).cast(EXACT))
    start = F.col("_base") + F.col("_t") - lowest
    return joined.select(
        *clips.columns,
        start.cast("double").alias("start"),
        (start + F.col("_d")).cast("double").alias("end"),
    )


def _characters_before(text: Column, mark: str, j: Column, words: Column) -> Column:
    """Characters before the ``j``-th part of a text, ``words`` words, without the single marks or blanks between them."""
    return (F.length(F.call_function("substring_index", text, F.lit(mark), j)) - F.greatest(words - 1, F.lit(0))).cast("bigint")


def _word_runs(clips: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Clips cut into runs of words, with ``columns`` of the clip (``duration`` among them).

    ``_n`` and ``_all`` are the clip's words and characters, ``_first`` and ``_begun`` those
    before the run, ``_size`` and ``_text`` the run's words.  Sums stay inside a row: neither
    a window over words nor an exchange is needed.  A prefix is read again for each of its
    words and runs, so a run has the square root of the words if these are many.
    """
    squeezed = F.col("_squeezed")
    counted = (
        clips.where(F.col("duration") > 0)
        .select(*columns, squeeze(F.col("text")).alias("_squeezed"))
        .withColumn("_all", F.length(F.replace(squeezed, F.lit(" "), F.lit(""))).cast("bigint"))
        .withColumn("_n", (F.length(squeezed) - F.col("_all") + 1).cast("int"))
        .withColumn("_run", F.greatest(F.lit(RUN_WORDS), F.ceil(F.sqrt("_n"))).cast("int"))
    )
    # The blank after each run becomes a line end; squeezed texts have no other.
    pattern = F.concat(F.lit("((?:[^ ]++ ){"), (F.col("_run") - 1).cast("string"), F.lit("}+[^ ]++) "))
    marked = counted.withColumn("_marked", F.regexp_replace(squeezed, pattern, F.lit("$1\n"))).drop("_squeezed")
    # The outer form: Spark guards a plain explode with a filter on the array's size and
    # splits every text once more.  Blank texts are left out after it for the same reason.
    spread = marked.select("*", F.posexplode_outer(F.split("_marked", "\n", -1)).alias("_i", "_text")).where("_text != ''")
    first = F.col("_i") * F.col("_run")
    return spread.select(
        *columns,
        "_n",
        "_all",
        first.alias("_first"),
        _characters_before(F.col("_marked"), "\n", F.col("_i"), first).alias("_begun"),
        F.least(F.col("_run"), F.col("_n") - first).alias("_size"),
        "_text",
    )


def _count_before(j: Column) -> Column:
    """Characters of the clip before word ``j`` of a run."""
    return F.col("_begun") + _characters_before(F.col("_text"), " ", j, j)


def _time_in_clip(count: Column, index: Column, inter_word_gap: float) -> Column:
    """When ``count`` characters and ``index`` gaps of a clip are over."""
    gaps = F.lit(inter_word_gap) * (F.col("_n") - 1)
    speech = F.greatest(F.col("duration") - gaps, F.lit(0.0))
    gap = (F.col("duration") - speech) / F.greatest(F.col("_n") - 1, F.lit(1))
    return round_half_up(speech * count / F.col("_all") + gap * index, 3)


def _words_of_runs(runs: DataFrame, columns: Sequence[str], inter_word_gap: float) -> DataFrame:
    """``columns`` of the run and ``word_no, speaker, word, start, end`` of its words, times within the clip."""
    # The explode and what follows are one loop in which the run's columns are not copied.
    spread = runs.select("*", F.posexplode_outer(F.split("_text", " ", -1)).alias("_j", "word"))
    counted = spread.withColumn("_i", F.col("_first") + F.col("_j")).withColumn("_count", _count_before(F.col("_j")))
    return counted.select(
        *columns,
        (F.col("_i") + 1).cast("bigint").alias("word_no"),
        "speaker",
        "word",
        _time_in_clip(F.col("_count"), F.col("_i"), inter_word_gap).alias("start"),
        _time_in_clip(F.col("_count") + F.length("word"), F.col("_i"), inter_word_gap).alias("end"),
    )


def align_words(
    clips: DataFrame, keys: Sequence[str] = ("conversation_id", "pos"), *, inter_word_gap: float = 0.0
) -> DataFrame:
    """Words of a clip with times in proportion to their characters.

    Nothing is shuffled or sorted, a clip's words come from its row alone.
    """
    return _words_of_runs(_word_runs(clips, [*keys, "speaker", "duration"]), keys, inter_word_gap)


def _numbered_words(scheduled: DataFrame, keys: Sequence[str], inter_word_gap: float, block_sec: float) -> DataFrame:
    """Rows of ``merged_words`` and ``_blk``, the stretch of time a word begins in; hash partitioned by it and the keys."""
    if inter_word_gap < 0:
        raise ValueError("words of a clip must be in order of time")
    c = F.col
    on_clock = lambda value: round_half_up(value + c("_clip_start"), 3)
    clip = ["pos", "speaker", "duration", "_clip_start"]
    runs = _word_runs(scheduled.withColumn("_clip_start", c("start")), [*keys, *clip])

    def block(j: Column) -> Column:
        return F.floor(on_clock(_time_in_clip(_count_before(j), c("_first") + j, inter_word_gap)) / F.lit(block_sec))

    # A run that goes on into later blocks is cut where its words' blocks change.
    bounded = runs.withColumn("_from_blk", block(F.lit(0))).withColumn("_to_blk", block(c("_size") - 1))
    placed = bounded.select("*", F.explode_outer(F.sequence("_from_blk", "_to_blk")).alias("_blk"))
    whole = c("_from_blk") == c("_to_blk")
    inside = F.when(~whole, F.filter(F.sequence(F.lit(0), c("_size") - 1), lambda j: block(j) == c("_blk")))
    cut = placed.withColumn("_in", inside).where(whole | (F.size("_in") > 0)).withColumn("_at", F.when(whole, 0).otherwise(F.get("_in", F.lit(0))))
    size = F.when(whole, c("_size")).otherwise(F.size("_in"))
    pieces = cut_lineage(
        cut.select(
            *keys,
            "_blk",
            *clip,
            "_n",
            "_all",
            (c("_first") + c("_at")).alias("_first"),
            F.when(whole, c("_begun")).otherwise(_count_before(c("_at"))).alias("_begun"),
            size.alias("_size"),
            F.when(whole, c("_text")).otherwise(F.array_join(F.slice(F.split("_text", " ", -1), c("_at") + 1, size), " ")).alias("_text"),
        )
    )
    before = carry_over(pieces, keys, ["_blk"], {"_before": ("sum", c("_size"))})
    # Runs are small before their words are spread and sorted, so the number of tasks follows from the words.
    words = pieces.agg(F.sum("_size")).first()[0] or 0
    dealt = pieces.repartition(1 + words // TASK_WORDS, *keys, "_blk").join(before, [*keys, "_blk"], "left")
    spread = _words_of_runs(dealt, [*keys, "_blk", "_before", "_clip_start", "pos"], inter_word_gap)
    moved = spread.withColumn("start", on_clock(c("start"))).withColumn("end", on_clock(c("end")))
    place = F.row_number().over(block_window(keys, ["_blk"], ["start", "pos", "word_no"]))
    return moved.select(*keys, "_blk", "pos", "word_no", "speaker", "word", "start", "end", (F.coalesce("_before", F.lit(0)) + place).cast("bigint").alias("seq"))


def merged_words(
    scheduled: DataFrame, keys: Sequence[str] = ("conversation_id",), *, inter_word_gap: float = 0.0, block_sec: float = 600.0
) -> DataFrame:
    """Words of all speakers on the conversation's clock, numbered in time order.

    The same rows as ``merge_alignments`` of the words of ``align_words``.  Here runs of words
    are stored and shuffled as texts, to the stretch of time they begin in, and become words there.
    """
    return _numbered_words(scheduled, keys, inter_word_gap, block_sec).drop("_blk")


def merge_alignments(words: DataFrame, scheduled: DataFrame, keys: Sequence[str] = ("conversation_id",), *, block_sec: float = 60.0) -> DataFrame:
    """Words of both speakers on the conversation's clock, numbered in time order.

    Minutes of the conversation are the blocks of the numbering.  It reads its input
    twice, and the words are costly to make, so they are written out first.
    """
    starts = scheduled.select(*keys, "pos", F.col("start").alias("_clip_start"))
    moved = words.join(starts, [*keys, "pos"]).select(
        *keys,
        "pos",
        "word_no",
        "speaker",
        "word",
        round_half_up(F.col("start") + F.col("_clip_start"), 3).alias("start"),
        round_half_up(F.col("end") + F.col("_clip_start"), 3).alias("end"),
    )
    blocked = cut_lineage(moved.withColumn("_blk", F.floor(F.col("start") / F.lit(block_sec))))
    return number_rows(blocked, keys, ["start", "pos", "word_no"], ["_blk"], "seq").drop("_blk")


LABELS = ("SPEAKER_MAIN", "SPEAKER_OTHER")


def label(speaker: Column, main: Column) -> Column:
    return F.when(speaker == main, LABELS[0]).otherwise(LABELS[1])


def variant_name(key: Column, main: Column) -> Column:
    return F.concat(key.cast("string"), F.lit("__"), main, F.lit("_agent"))


def channel_variants(rows: DataFrame, speakers: Sequence[str], key: str = "conversation_id") -> DataFrame:
    """Every row once per variant: each speaker in turn is the main one."""
    mains = F.explode(F.array(*[F.lit(s) for s in speakers]))
    return rows.select("*", mains.alias("main_speaker")).select(
        "*",
        variant_name(F.col(key), F.col("main_speaker")).alias("variant"),
        label(F.col("speaker"), F.col("main_speaker")).alias("label"),
    )


def transcript_parts(variants: DataFrame, part_words: int = 10_000) -> DataFrame:
    """Words of a variant by label, as texts of at most ``part_words`` words."""
    part = F.floor((F.col("seq") - 1) / part_words).cast("bigint")
    return (
        variants.groupBy("variant", "label", part.alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct("seq", "word"))).alias("_w"))
        .select("variant", "label", "part", F.array_join(F.transform("_w", lambda w: w["word"]), " ").alias("transcript"))
    )


def merged_transcripts(
    scheduled: DataFrame,
    speakers: Sequence[str],
    key: str = "conversation_id",
    part_words: int = 10_000,
    *,
    inter_word_gap: float = 0.0,
    block_sec: float = 600.0,
) -> DataFrame:
    """``transcript_parts`` of the variants of ``merged_words``.

    Words are joined to texts where they were numbered, only these are shuffled.
    """
    rows = _numbered_words(scheduled, [key], inter_word_gap, block_sec)
    part = F.floor((F.col("seq") - 1) / part_words).cast("bigint")
    local = rows.groupBy(key, "_blk", part.alias("part")).agg(F.array_sort(F.collect_list(F.struct("seq", "speaker", "word"))).alias("_w"))

    def text(main: str, name: str) -> Column:
        said = F.filter("_w", lambda w: label(w["speaker"], F.lit(main)) == name)
        return F.struct(F.lit(main).alias("main"), F.lit(name).alias("label"), F.array_join(F.transform(said, lambda w: w["word"]), " ").alias("text"))

    texts = F.explode_outer(F.array(*[text(m, n) for m in speakers for n in LABELS])).alias("_t")
    return (
        local.select(key, "_blk", "part", texts)
        .where("_t.text != ''")
        .groupBy(variant_name(F.col(key), F.col("_t.main")).alias("variant"), F.col("_t.label").alias("label"), "part")
        .agg(F.array_sort(F.collect_list(F.struct("_blk", F.col("_t.text").alias("text")))).alias("_w"))
        .select("variant", "label", "part", F.array_join(F.transform("_w", lambda w: w["text"]), " ").alias("transcript"))
    )


def segments(scheduled: DataFrame, speakers: Sequence[str], key: str = "conversation_id") -> DataFrame:
    return channel_variants(scheduled.select(key, "pos", "speaker", "start", "end"), speakers, key)


def manifest(scheduled: DataFrame, speakers: Sequence[str], key: str = "conversation_id") -> DataFrame:
    """Path and length of both variants of every conversation."""
    lengths = scheduled.groupBy(key).agg(F.max("end").alias("duration"))
    named = lengths.select("*", F.explode(F.array(*[F.lit(s) for s in speakers])).alias("main_speaker"))
    return named.select(
        F.concat(F.col(key).cast("string"), F.lit("__"), F.col("main_speaker"), F.lit("_agent.wav")).alias("path"),
        round_half_up(F.col("duration"), 3).alias("duration"),
    )


def manifest_of_files(files: DataFrame) -> DataFrame:
    """The manifest rebuilt from stored files ``(path, length, content)``; of the content only the heads of chunks are read.

    Files that are no WAV files have a null duration.
    """
    head = wav_header(F.col("content"), F.col("length"))
    return files.select(F.substring_index("path", "/", -1).alias("path"), round_half_up(head["duration"], 3).alias("duration"))


def output_channels(variant_segments: DataFrame) -> DataFrame:
    """Adds the channel a segment is written to: the main speaker's or the other one."""
    return variant_segments.withColumn("channel", F.when(F.col("label") == "SPEAKER_MAIN", "main").otherwise("user"))


def crosstalk_purity(channel_segments: DataFrame) -> DataFrame:
    """Share of each channel's speech that is not by the channel's speaker.

    ``channel_segments``: ``variant, main_speaker, channel (main|user), speaker, start,
    end`` as found in the output.  The main channel belongs to the main speaker, the other
    one to everyone else.
    """
    c = F.col
    seconds = (c("end") - c("start")).cast(EXACT)
    main = c("channel") == "main"
    wrong = main != (c("speaker") == c("main_speaker"))
    share = lambda side: round_half_up(
        F.coalesce(
            F.sum(F.when(side & wrong, seconds)).cast("double") / F.nullif(F.sum(F.when(side, seconds)).cast("double"), F.lit(0.0)),
            F.lit(0.0),
        ),
        6,
    )
    return (
        channel_segments.groupBy("variant")
        .agg(share(main).alias("main_crosstalk"), share(~main).alias("user_crosstalk"))
        .withColumn("pass", (c("main_crosstalk") == 0) & (c("user_crosstalk") == 0))
        .withColumn("quarantined", ~c("pass"))
    )
