"""Corpus planning: progress, budgets, order of work, failures and topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duologue.functions import draws
from duologue.functions import fixed_values as fv
from duologue.functions.text import lookup, round_half_up, strip
from duologue.operators.ordered import BLOCK_ROWS, block_of, block_window, join_parts, number_rows, part_window, running, with_halo, with_parts

INSTANCE = "corpus_combination_id"
MONEY = "decimal(28,3)"  # exact seconds, so that sums do not depend on their order


# ---- expressions -------------------------------------------------------------
def instance_state(
    generated: Column, target: Column, count: Column, overflow: float = fv.OVERFLOW_SEC
) -> Column:
    return (
        F.when((generated >= target) & (generated > target + F.lit(overflow)), "over_target")
        .when(generated >= target, "complete")
        .when((count > 0) | (generated > 0), "incomplete")
        .otherwise("not_started")
    )


def capped_target(
    sampled: Column,
    remaining: Column,
    *,
    overflow: float = fv.OVERFLOW_SEC,
    low: float = fv.MIN_DURATION_SEC,
    high: float = fv.MAX_DURATION_SEC,
    viable: float = fv.MIN_VIABLE_SEC,
) -> Column:
    """Conversation length that still fits the budget; NULL when none is worth making."""
    room = remaining + F.lit(overflow)
    normal = F.least(F.greatest(sampled, F.lit(low)), F.least(F.lit(high), room))
    tail = F.greatest(F.least(sampled, room), F.lit(viable))
    return (
        F.when(remaining <= 0, F.lit(None).cast("double"))
        .when(remaining >= low, F.when(normal >= low, round_half_up(normal, 1)))
        .when(room >= viable, round_half_up(tail, 1))
    )


def generation_provider(model: Column, language: Column) -> Column:
    """Explicit model first, then the Hindi route, then the default."""
    hindi = F.lower(strip(language)) == "hindi"
    return F.coalesce(
        F.lower(strip(model)), F.when(hindi, fv.HINDI_PROVIDER), F.lit(fv.GENERATION_PROVIDER)
    )


def validation_provider(model: Column) -> Column:
    return F.coalesce(F.lower(strip(model)), F.lit(fv.VALIDATION_PROVIDER))


def known_provider(provider: Column) -> Column:
    return provider.isin(fv.PROVIDERS)


def attempt_temperature(base: Column, attempt: Column, provider: Column) -> Column:
    """Hotter with every retry, up to a ceiling; one provider starts hotter."""
    start = F.when(provider == fv.HINDI_PROVIDER, F.greatest(base, F.lit(fv.HOT_PROVIDER_TEMPERATURE))).otherwise(base)
    return round_half_up(F.least(F.lit(fv.TEMPERATURE_MAX), start + F.lit(fv.TEMPERATURE_STEP) * (attempt - 1)), 2)


def pacing(target: Column) -> tuple[Column, Column]:
    """Words and turns to ask for, from the target seconds."""
    words = F.floor(target * F.lit(2.5)).cast("bigint")
    turns = F.greatest(F.lit(24).cast("bigint"), F.floor(target / F.lit(7.0)).cast("bigint"))
    return words, turns


def run_languages(names: Column) -> Column:
    """Requested languages, lower case and distinct in order; NULL means all."""
    clean = F.array_distinct(F.filter(F.transform(names, lambda n: F.lower(strip(n))), lambda n: n != ""))
    return F.when(F.size(clean) > 0, clean)


def profile_map(columns: Sequence[str]) -> Column:
    """Non-null attributes of an instance."""
    cells: list[Column] = []
    for name in columns:
        cells += [F.lit(name), F.col(name).cast("string")]
    return F.map_filter(F.create_map(*cells), lambda _, value: value.isNotNull())


# ---- progress ----------------------------------------------------------------
def progress_rollup(accepted: DataFrame) -> DataFrame:
    """Generated seconds and number of accepted conversations per instance."""
    return accepted.groupBy(INSTANCE).agg(
        F.sum(F.col("duration_sec").cast(MONEY)).cast("double").alias("generated_sec"),
        F.count("*").alias("conversation_count"),
    )


def number_conversations(
    accepted: DataFrame, order: Sequence[str], stored: DataFrame | None = None
) -> DataFrame:
    """1-based index per instance in acceptance order, after those already stored."""
    numbered = number_rows(accepted, [INSTANCE], order, name="index")
    if stored is None:
        return numbered
    offset = stored.select(INSTANCE, F.col("conversation_count").alias("_stored"))
    return (
        numbered.join(offset, INSTANCE, "left")
        .withColumn("index", F.col("index") + F.coalesce("_stored", F.lit(0)))
        .drop("_stored")
    )


def distinct_topics(topics: DataFrame) -> DataFrame:
    """First occurrence of every title per instance, in order of appearance."""
    title = strip(F.col("title"))
    return (
        topics.where(title != "")
        .groupBy(INSTANCE, title.alias("title"))
        .agg(F.min("index").alias("first_index"))
    )


def corpus_progress(corpus: DataFrame, progress: DataFrame) -> DataFrame:
    """Corpus with progress, zeros where there is none; the corpus target rules."""
    done = progress.select(INSTANCE, "generated_sec", "conversation_count")
    joined = corpus.join(done, INSTANCE, "left")
    target = F.coalesce("duration_sec", F.lit(0.0))
    generated = F.coalesce("generated_sec", F.lit(0.0))
    count = F.coalesce("conversation_count", F.lit(0).cast("bigint"))
    return (
        joined.withColumn("target_sec", target)
        .withColumn("generated_sec", generated)
        .withColumn("conversation_count", count)
        .withColumn("state", instance_state(F.col("generated_sec"), F.col("target_sec"), F.col("conversation_count")))
    )


def not_skipped(corpus: DataFrame, skipped: DataFrame) -> DataFrame:
    return corpus.join(skipped.select(INSTANCE), INSTANCE, "left_anti")


def language_totals(progress: DataFrame) -> DataFrame:
    """Target and generated seconds per language."""
    return progress.groupBy(F.lower("language").alias("language")).agg(
        F.sum(F.col("target_sec").cast(MONEY)).cast("double").alias("target_sec"),
        F.sum(F.col("generated_sec").cast(MONEY)).cast("double").alias("generated_sec"),
    )


def headroom(progress: DataFrame, totals: DataFrame, reserved: DataFrame | None = None) -> DataFrame:
    """Seconds an instance and its language may still take; no language cap is infinite."""
    caps = totals.select(
        F.col("language").alias("_language"),
        F.col("target_sec").alias("_lt"),
        F.col("generated_sec").alias("_lg"),
    )
    joined = progress.withColumn("_language", F.lower("language")).join(caps, "_language", "left")
    if reserved is None:
        held, held_language = F.lit(0.0), F.lit(0.0)
    else:
        mine = reserved.groupBy(INSTANCE).agg(F.sum("reserved_sec").alias("_held"))
        joined = joined.join(mine, INSTANCE, "left")
        held = held_language = F.coalesce("_held", F.lit(0.0))
    instance = F.col("target_sec") + F.lit(fv.OVERFLOW_SEC) - F.col("generated_sec") - held
    language = F.coalesce(
        F.col("_lt") + F.lit(fv.OVERFLOW_SEC) - F.col("_lg") - held_language, F.lit(float("inf"))
    )
    return joined.select(
        INSTANCE,
        "language",
        instance.alias("instance_headroom"),
        language.alias("language_headroom"),
        F.least(instance, language).alias("effective_headroom"),
    )


def run_plan_summary(progress: DataFrame, skipped: DataFrame) -> DataFrame:
    """Counts by state, per language and overall (``language`` NULL).

    Skipped instances count in the overall line only.
    """
    flagged = progress.join(
        skipped.select(INSTANCE).withColumn("_skip", F.lit(True)), INSTANCE, "left"
    ).withColumn("_skip", F.coalesce("_skip", F.lit(False)))
    active = lambda state: F.count_if(~F.col("_skip") & (F.col("state") == state)).alias(state)
    rolled = (
        flagged.withColumn("language", F.lower("language"))
        .rollup("language")
        .agg(
            F.grouping("language").alias("_all"),
            F.count("*").alias("_rows"),
            F.count_if(~F.col("_skip")).alias("_active"),
            F.count_if("_skip").alias("_skipped"),
            active("complete"),
            active("over_target"),
            active("incomplete"),
            active("not_started"),
        )
    )
    overall = F.col("_all") == 1
    return rolled.select(
        F.when(overall, "*").otherwise(F.col("language")).alias("language"),
        F.when(overall, F.col("_rows")).otherwise(F.col("_active")).alias("total"),
        "complete",
        "over_target",
        "incomplete",
        "not_started",
        F.when(overall, F.col("_skipped")).otherwise(F.lit(0)).alias("skipped"),
        (F.col("incomplete") + F.col("not_started")).alias("to_process"),
    ).where((F.col("total") > 0) | (F.col("language") == "*"))


# ---- order of work -----------------------------------------------------------
def by_language(corpus: DataFrame, languages: Sequence[str] | None) -> DataFrame:
    """Rows of the requested languages with the language's place among them (0 if none is requested)."""
    refuse_unsupported(languages)
    lang = F.lower("language")
    if not languages:
        return corpus.withColumn("language_pos", F.lit(0))
    wanted = F.array(*[F.lit(x) for x in languages])
    return corpus.where(lang.isin(list(languages))).withColumn("language_pos", F.array_position(wanted, lang).cast("int") - 1)


def language_ordered(corpus: DataFrame, languages: Sequence[str] | None) -> DataFrame:
    """Rows in the order of requested languages, corpus order inside; none -> corpus order."""
    return number_rows(by_language(corpus, languages), [], ["language_pos", "row_pos"], name="order_no")


def refuse_unsupported(languages: Sequence[str] | None, supported: Sequence[str] = tuple(fv.LANGUAGE_DIRECTIVES)) -> None:
    """An error that names the requested languages a run can't do; no request means all."""
    odd = [x for x in languages or [] if x not in supported]
    if odd:
        raise ValueError(f"unsupported languages {odd}, choose from {list(supported)}")


def unsupported_requests(requests: DataFrame, supported: Sequence[str] = tuple(fv.LANGUAGE_DIRECTIVES)) -> DataFrame:
    """Requests (an id and a ``languages`` list) that name unsupported languages, and which."""
    odd = F.array_except("languages", F.array(*[F.lit(x) for x in supported]))
    return requests.withColumn("unsupported", odd).where(F.size("unsupported") > 0)


def processing_order(progress: DataFrame, skipped: DataFrame, languages: Sequence[str] | None = None) -> DataFrame:
    """Started instances first, then untouched ones; finished and skipped ones are out."""
    open_rows = not_skipped(progress, skipped).where(F.col("state").isin("incomplete", "not_started"))
    ordered = by_language(open_rows, languages)
    ranked = ordered.withColumn("state_pos", F.when(F.col("state") == "incomplete", 0).otherwise(1))
    return number_rows(ranked, [], ["state_pos", "language_pos", "row_pos"], name="order_no")


def dev_sample(
    corpus: DataFrame,
    languages: Sequence[str] | None = None,
    positions: Sequence[int] = tuple(fv.DEV_POSITIONS),
    conversations_each: int = 1,
) -> DataFrame:
    """The fixed development rows, by requested language and then by list order."""
    lang = F.lower("language")
    listed = F.array(*[F.lit(p).cast("bigint") for p in positions])
    rows = corpus.where(F.col("row_pos").isin(list(positions)))
    if languages:
        wanted = F.array(*[F.lit(x) for x in languages])
        rows = rows.where(lang.isin(list(languages))).withColumn("language_pos", F.array_position(wanted, lang))
    else:
        rows = rows.withColumn("language_pos", F.lit(1).cast("bigint"))
    return rows.select(
        "*",
        F.array_position(listed, F.col("row_pos").cast("bigint")).alias("list_pos"),
        F.lit(conversations_each).alias("max_conversations"),
    )


# ---- acceptance --------------------------------------------------------------
def budget_admission(
    candidates: DataFrame, progress: DataFrame, order: Sequence[str], overflow: float = fv.OVERFLOW_SEC
) -> DataFrame:
    """Admit finished conversations in order until the target is met.

    ``accepted`` while the total so far is below the target and the new total stays
    within the allowance; the first that would pass it is ``rejected`` and ends the
    instance; everything later is ``not_reached``.  Totals only grow, so a running
    sum decides each row on its own.
    """
    summed = running(candidates, [INSTANCE], order, None, {"_upto": ("sum", F.col("duration_sec").cast(MONEY))})
    start = progress.select(INSTANCE, "target_sec", F.col("generated_sec").alias("_start"))
    total = F.coalesce("_start", F.lit(0.0)).cast(MONEY) + F.col("_upto")
    before = total - F.col("duration_sec").cast(MONEY)
    target = F.coalesce("target_sec", F.lit(0.0)).cast(MONEY)
    status = (
        F.when(before >= target, "not_reached")
        .when(total <= target + F.lit(overflow).cast(MONEY), "accepted")
        .otherwise("rejected")
    )
    return (
        summed.join(start, INSTANCE, "left")
        .withColumn("status", status)
        .withColumn("total_sec", total.cast("double"))
        .drop("_upto", "_start", "target_sec")
    )


def failure_runs(outcomes: DataFrame, order: Sequence[str], open_runs: DataFrame | None = None) -> DataFrame:
    """Length of the run of failures ending at every outcome (0 on acceptance).

    Rows are numbered inside their instance, or its part where the instance is split; one
    row per part carries the count and the place of the latest acceptance forward.
    ``open_runs`` (``open_failures``, ``attempts`` per instance) continues runs that an
    earlier batch left open.
    """
    upto = part_window([INSTANCE], order)
    local = with_parts(outcomes, [INSTANCE], order).select("*", F.count(F.lit(1)).over(upto).alias("_n"))
    local = local.select("*", F.max(F.when(F.col("accepted"), F.col("_n"))).over(upto).alias("_near"))
    ends = local.where(F.col("_part").isNotNull()).groupBy(INSTANCE, "_part").agg(F.max("_n").alias("_rows"), F.max("_near").alias("_end"))
    earlier = Window.partitionBy(INSTANCE).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    based = ends.withColumn("_base", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    entry = based.select(INSTANCE, "_part", "_base", F.max(F.col("_base") + F.col("_end")).over(earlier).alias("_before"))
    marked = join_parts(local, entry, [INSTANCE]).withColumn("_base", F.coalesce("_base", F.lit(0)))
    held, seen = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    if open_runs is not None:
        kept = open_runs.select(INSTANCE, F.col("open_failures").alias("_open"), F.col("attempts").alias("_seen"))
        marked = marked.join(kept, INSTANCE, "left")
        held, seen = F.coalesce("_open", held), F.coalesce("_seen", seen)
    number = F.col("_base") + F.col("_n")
    last = F.coalesce(F.col("_base") + F.col("_near"), F.col("_before"))
    return marked.select(
        *outcomes.columns,
        (number + seen).alias("attempt_no"),
        F.when(last.isNull(), number + held).otherwise(number - last).alias("consecutive_failures"),
    )


def abandoned_instances(runs: DataFrame, limit: int = fv.MAX_CONSECUTIVE_FAILURES) -> DataFrame:
    """Instances given up, with the outcome at which the run first reached the limit."""
    return (
        runs.where(F.col("consecutive_failures") == limit)
        .groupBy(INSTANCE)
        .agg(F.min("attempt_no").alias("abandoned_at"))
    )


def skip_entries(abandoned: DataFrame, progress: DataFrame, limit: int = fv.MAX_CONSECUTIVE_FAILURES) -> DataFrame:
    """Registry rows of abandoned instances."""
    return abandoned.join(progress, INSTANCE).select(
        INSTANCE,
        F.lit(limit).alias("consecutive_failures"),
        F.lit(f"{limit} consecutive validation failures").alias("reason"),
        "generated_sec",
        "target_sec",
        "conversation_count",
        "language",
        "gender_pair",
        "abandoned_at",
    )


def select_attempts(attempts: DataFrame) -> DataFrame:
    """Which content and format attempt of a conversation counts, and does it pass?

    ``attempts``: ``conv_id, stage (content|format), attempt, verdict`` (NULL when the
    judge was unavailable) and ``manual_clean`` (format stage).
    """
    c = F.col
    content, form = c("stage") == "content", c("stage") == "format"
    fine = (c("verdict") == "PASS") | c("verdict").isNull()
    clean = form & c("manual_clean")
    number = lambda cond: F.when(cond, c("attempt"))
    picked = attempts.groupBy("conv_id").agg(
        F.min(number(content & fine)).alias("content_attempt"),
        F.min_by(c("verdict").isNull(), number(content & fine)).alias("content_bypassed"),
        F.min(number(clean & fine)).alias("_format_ok"),
        F.min_by(c("verdict").isNull(), number(clean & fine)).alias("_format_bypassed"),
        F.max(number(clean)).alias("_last_clean"),
    )
    content_ok, format_ok = c("content_attempt").isNotNull(), c("_format_ok").isNotNull()
    exhausted = content_ok & ~format_ok & c("_last_clean").isNotNull()
    return picked.select(
        "conv_id",
        "content_attempt",
        F.coalesce("content_bypassed", F.lit(False)).alias("content_bypassed"),
        F.when(content_ok, F.coalesce("_format_ok", "_last_clean")).alias("format_attempt"),
        (content_ok & F.coalesce("_format_bypassed", F.lit(False))).alias("format_bypassed"),
        exhausted.alias("format_exhausted"),
        (content_ok & c("_last_clean").isNotNull() & (format_ok | exhausted)).alias("passed"),
    )


def run_stats(outcomes: DataFrame, progress: DataFrame) -> DataFrame:
    """Accepted, failed and all conversations; finished and all instances."""
    zero = F.lit(0)
    talks = outcomes.select(F.col("accepted").cast("int").alias("a"), F.lit(1).alias("t"), zero.alias("c"), zero.alias("i"))
    done = F.col("state").isin("complete", "over_target").cast("int")
    instances = progress.select(zero.alias("a"), zero.alias("t"), done.alias("c"), F.lit(1).alias("i"))
    total = lambda name: F.coalesce(F.sum(name), F.lit(0).cast("bigint"))
    return talks.unionByName(instances).agg(
        total("a").alias("conversations_accepted"),
        (total("t") - total("a")).alias("conversations_failed"),
        total("t").alias("conversations_total"),
        total("c").alias("instances_completed"),
        total("i").alias("instances_total"),
    )


# ---- topics ------------------------------------------------------------------
def fresh_topics(candidates: DataFrame, history: DataFrame) -> DataFrame:
    """Candidates whose title the instance has not used yet."""
    used = history.select(INSTANCE, F.lower(strip(F.col("title"))).alias("_title"))
    return candidates.withColumn("_title", F.lower(strip(F.col("title")))).join(
        used, [INSTANCE, "_title"], "left_anti"
    ).drop("_title")


def allowed_domains(
    history: DataFrame,
    domains: Sequence[str] = tuple(fv.TOPIC_DOMAINS),
    keys: Sequence[str] = (INSTANCE,),
    size: int = BLOCK_ROWS,
) -> DataFrame:
    """Domains open before each topic: all but those of the latest ``len(domains) - 1``.

    ``history`` has a dense ``pos``; topics without a domain exclude nothing.
    """
    back = len(domains) - 1
    blocks = with_halo(history, "pos", size, before=back, after=0)
    recent = F.collect_set("domain").over(block_window(keys, ["_block"], ["pos"]).rowsBetween(-back, -1))
    every = F.array(*[F.lit(d) for d in domains])
    left = F.array_except(every, recent)
    return (
        blocks.withColumn("allowed", F.when(F.size(left) > 0, left).otherwise(every))
        .where("_own")
        .drop("_block", "_own")
    )


def drawn_domains(topics: DataFrame, order: Sequence[str], domains: Sequence[str] = tuple(fv.TOPIC_DOMAINS)) -> DataFrame:
    """Adds ``pos`` and the ``domain`` each topic was drawn from; ``resumed`` topics were read back without theirs.

    When all of the last ``len(domains) - 1`` domains are barred, one is left: the choices are
    the instance's permutation of all domains, over and over.  A resumed topic bars nothing,
    so the topics after it begin the permutation anew.
    """
    numbered = number_rows(topics, [INSTANCE], order)
    blocked = numbered.withColumn("_blk", block_of(F.col("pos") - 1))
    since = running(blocked, [INSTANCE], ["pos"], ["_blk"], {"_since": ("max", F.when(F.col("resumed"), F.col("pos")))})
    nth = (F.col("pos") - F.coalesce("_since", F.lit(0)) - 1) % len(domains)
    drawn = F.get(draws.permuted(F.col(INSTANCE), domains), nth.cast("int"))
    return since.withColumn("domain", F.when(~F.col("resumed"), drawn)).drop("_since", "_blk")


def topic_slots(topics: DataFrame, order: Sequence[str], domains: Sequence[str] = tuple(fv.TOPIC_DOMAINS)) -> DataFrame:
    """Per instance what its next topic request needs: ``history`` lines in order, and the ``domain`` to draw from.

    The lines of an instance make one text, as its request holds them all: one line for each
    accepted conversation, which its target duration bounds.
    """
    line = F.concat(strip(F.col("title")), F.lit(" ("), F.coalesce("conversation_type", F.lit("unknown")), F.lit(")"))
    entry = F.struct(*order, line.alias("line"), F.col("resumed").alias("resumed"))
    found = topics.groupBy(INSTANCE).agg(F.array_sort(F.collect_list(entry)).alias("_all"))
    back = F.array_position(F.reverse(F.transform("_all", lambda x: x["resumed"])), F.lit(True))
    nth = F.when(back > 0, back - 1).otherwise(F.size("_all")) % len(domains)
    return found.select(
        INSTANCE,
        F.array_join(F.transform("_all", lambda x: x["line"]), "\n").alias("history"),
        F.get(draws.permuted(F.col(INSTANCE), domains), nth.cast("int")).alias("domain"),
    )


# ---- guidance ----------------------------------------------------------------
def accent_marker(accent: Column, language: Column) -> Column:
    """Marker text for one speaker's accent, NULL when there is nothing to add."""
    name = F.lower(strip(accent))
    english = F.coalesce(F.lower(strip(language)) == "english", F.lit(False))
    return F.when(F.coalesce(accent, F.lit("")) == "", F.lit(None)).when(
        english, F.when(name != "normal", fv.ENGLISH_ACCENT_NOTE)
    ).otherwise(lookup(fv.ACCENT_MARKERS, name))


def language_directive(language: Column) -> Column:
    """Instruction for a supported language, NULL otherwise."""
    return lookup(fv.LANGUAGE_DIRECTIVES, F.lower(strip(language)))
