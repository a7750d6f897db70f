"""Model replies: from raw text to typed verdicts, patches and topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duologue.functions import fixed_values as fv
from duologue.functions.text import bind, last_wins, strip

FENCE = "```"
FALSY = ["false", "null", "0", "0.0", "-0.0", '""', "[]", "{}"]


# ---- raw text ------------------------------------------------------------------
def unfenced(reply: Column) -> Column:
    """Reply without an enclosing code fence."""

    def inner(text: Column) -> Column:
        newline = F.instr(text, "\n")
        body = F.when(newline > 0, F.substring(text, newline + 1, F.length(text))).otherwise(text)
        return F.when(F.startswith(text, F.lit(FENCE)), strip(bind(body, before_last_fence))).otherwise(text)

    def before_last_fence(body: Column) -> Column:
        tail = F.substring_index(body, FENCE, -1)
        kept = F.substring(body, F.lit(1), F.length(body) - F.length(tail) - len(FENCE))
        return F.when(F.contains(body, F.lit(FENCE)), kept).otherwise(body)

    return bind(strip(reply), inner)


def extract_json(replies: DataFrame, column: str = "reply") -> DataFrame:
    """Adds ``body`` (the JSON text, NULL when unreadable) and ``needs_retry``."""
    body = unfenced(F.col(column))
    return (
        replies.withColumn("_body", body)
        .withColumn("body", F.when(F.try_parse_json("_body").isNotNull(), F.col("_body")))
        .withColumn("needs_retry", F.col("body").isNull())
        .drop("_body")
    )


def first_object(body: Column) -> Column:
    """The object itself, the first of a list, an empty object for an empty list."""
    return F.when(F.startswith(body, F.lit("[")), F.coalesce(F.get_json_object(body, "$[0]"), F.lit("{}"))).otherwise(body)


def fields(body: Column) -> Column:
    """Top-level fields by lower-case key, each as JSON text; NULL unless an object."""
    lowered = F.transform(
        F.map_entries(F.from_json(body, "map<string,variant>")),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), F.to_json(e["value"]).alias("value")),
    )
    return F.when(F.startswith(body, F.lit("{")), last_wins(lowered))


def raw(field_map: Column, key: str) -> Column:
    return F.try_element_at(field_map, F.lit(key))


def plain(json_text: Column) -> Column:
    """Unquoted text of a JSON value; ``null`` reads ``None``."""

    def unquote(j: Column) -> Column:
        quoted = F.from_json(F.concat(F.lit('{"v":'), j, F.lit("}")), "v string")["v"]
        return F.when(j == "null", F.lit("None")).when(F.startswith(j, F.lit('"')), quoted).otherwise(j)

    return bind(json_text, unquote)


def text_field(field_map: Column, key: str, default: str = "") -> Column:
    return strip(F.coalesce(plain(raw(field_map, key)), F.lit(default)))


def truthy(json_text: Column) -> Column:
    return json_text.isNotNull() & ~json_text.isin(FALSY)


def score(json_text: Column, low: float = 0.0, high: float = 10.0) -> Column:
    """A number within the scoring range; anything unreadable is the lowest."""
    number = plain(json_text).try_cast("double")
    return F.coalesce(F.least(F.greatest(number, F.lit(low)), F.lit(high)), F.lit(low))


def choice(value: Column, allowed: list[str], default: str) -> Column:
    return bind(value, lambda x: F.when(x.isin(allowed), x).otherwise(default))


def objects(json_text: Column) -> Column:
    """Objects of a JSON list as field maps."""
    listed = F.from_json(F.when(F.startswith(json_text, F.lit("[")), json_text), "array<variant>")
    texts = F.transform(listed, lambda v: F.to_json(v))
    return F.transform(F.filter(texts, lambda t: F.startswith(t, F.lit("{"))), fields)


def issues(json_text: Column, *references: str) -> Column:
    """Described issues; an unknown severity is minor, the first given reference counts."""
    listed = F.transform(
        F.coalesce(objects(json_text), F.array().cast("array<map<string,string>>")),
        lambda m: F.struct(
            choice(F.lower(text_field(m, "severity", "minor")), fv.SEVERITIES, "minor").alias("severity"),
            F.coalesce(*[F.when(truthy(raw(m, r)), plain(raw(m, r))) for r in references]).alias("turn_ref"),
            text_field(m, "description").alias("description"),
        ),
    )
    return F.filter(listed, lambda i: i["description"] != "")


# ---- verdicts ------------------------------------------------------------------
def with_fields(bodies: DataFrame, column: str) -> DataFrame:
    """Adds ``_f``, the lower-case fields of the reply's object."""
    return bodies.withColumn("_o", first_object(F.col(column))).withColumn("_f", fields(F.col("_o")))


def content_verdicts(bodies: DataFrame, column: str = "body") -> DataFrame:
    """Typed content verdicts; ``is_error`` marks a reply that is no object."""
    f = F.col("_f")
    found = with_fields(bodies, column)
    low_matches = fields(F.coalesce(raw(f, "corpus_field_matches"), F.lit("{}")))
    cells: list[Column] = []
    for name in fv.CORPUS_FIELDS:
        cells += [F.lit(name), F.coalesce(truthy(raw(F.col("_m"), name)), F.lit(False))]
    strengths = F.filter(
        F.transform(
            F.coalesce(F.from_json(F.when(F.startswith(raw(f, "strengths"), F.lit("[")), raw(f, "strengths")), "array<string>"), F.array().cast("array<string>")),
            lambda s: strip(F.coalesce(s, F.lit("None"))),
        ),
        lambda s: s != "",
    )
    return found.withColumn("_m", low_matches).select(
        *bodies.columns,
        f.isNull().alias("is_error"),
        choice(F.upper(text_field(f, "verdict", "NEEDS_REVIEW")), fv.VERDICTS, "NEEDS_REVIEW").alias("verdict"),
        score(raw(f, "realism_score")).alias("realism_score"),
        score(raw(f, "corpus_match_score")).alias("corpus_match_score"),
        F.create_map(*cells).alias("field_matches"),
        strengths.alias("strengths"),
        issues(raw(f, "issues"), "turn_ref", "turn_id").alias("issues"),
        text_field(f, "feedback").alias("feedback"),
    )


def format_verdicts(bodies: DataFrame, column: str = "body") -> DataFrame:
    f = F.col("_f")
    return with_fields(bodies, column).select(
        *bodies.columns,
        f.isNull().alias("is_error"),
        choice(F.upper(text_field(f, "verdict", "NEEDS_REVIEW")), fv.VERDICTS, "NEEDS_REVIEW").alias("verdict"),
        issues(raw(f, "issues"), "turn_id").alias("issues"),
        text_field(f, "feedback").alias("feedback"),
    )


def mismatched(field_matches: Column) -> Column:
    """Names the judge marked as not satisfied, in the fixed order of the fields."""
    return F.filter(
        F.array(*[F.lit(n) for n in fv.CORPUS_FIELDS]), lambda n: ~F.coalesce(F.try_element_at(field_matches, n), F.lit(False))
    )


def render_feedback(feedback: Column, missed: Column | None, listed: Column) -> Column:
    """Feedback text, the missed attributes and one line per issue."""
    lines = F.transform(
        listed,
        lambda i: F.concat(
            F.lit("- ("), i["severity"], F.lit(") "), i["description"],
            F.when(F.coalesce(i["turn_ref"], F.lit("")) != "", F.concat(F.lit(" ["), i["turn_ref"], F.lit("]"))).otherwise(""),
        ),
    )
    parts = [F.nullif(feedback, F.lit(""))]
    if missed is not None:
        parts.append(F.when(F.size(missed) > 0, F.concat(F.lit("Corpus fields NOT satisfied: "), F.array_join(missed, ", "))))
    parts.append(F.when(F.size(listed) > 0, F.array_join(lines, "\n")))
    return strip(F.concat_ws("\n", *parts))


def verdict_stats(verdicts: DataFrame) -> DataFrame:
    """Mean scores, pass rate and how often each attribute is missed, as long rows."""
    # Conditions stay inside the aggregates: a filter would be pushed below the parsing
    # and repeat it.
    good = ~F.col("is_error")
    n = F.count_if(good)
    mean = lambda name: F.sum(F.when(good, F.col(name)).cast("decimal(18,4)")).cast("double") / n
    missed = {
        f: F.count_if(good & ~F.coalesce(F.try_element_at("field_matches", F.lit(f)), F.lit(False))) for f in fv.CORPUS_FIELDS
    }
    wide = verdicts.agg(
        n.cast("double").alias("replies"),
        mean("realism_score").alias("mean_realism"),
        mean("corpus_match_score").alias("mean_match"),
        (F.count_if(good & (F.col("verdict") == "PASS")) / n).alias("pass_rate"),
        *[count.cast("double").alias(f"missed/{name}") for name, count in missed.items()],
    )
    return wide.unpivot([], wide.columns, "metric", "value")


# ---- patches and topics ----------------------------------------------------------
def edit_patches(bodies: DataFrame, column: str = "body") -> DataFrame:
    """Edits of a patch reply, one row each in their order.

    Accepts ``{"edits": [...]}``, a bare list, a single edit, or one list under any key.
    """
    body = F.col(column)
    parsed = bodies.withColumn("_f", fields(body))
    f = F.col("_f")
    exact = F.get_json_object(body, "$.edits")
    lists = F.filter(F.map_values(f), lambda v: F.startswith(v, F.lit("[")))
    listed = (
        F.when(F.startswith(body, F.lit("[")), body)
        .when(exact.isNotNull(), exact)
        .when(F.get_json_object(body, "$.turn_id").isNotNull(), F.concat(F.lit("["), body, F.lit("]")))
        .otherwise(F.try_element_at(lists, F.lit(1)))
    )
    rows = parsed.select(
        *bodies.columns, F.posexplode_outer(objects(listed)).alias("_n", "_e")
    )
    e = F.col("_e")
    action = choice(F.lower(text_field(e, "action", "replace")), ["replace", "delete"], "replace")
    given = lambda key: F.when((action == "replace") & (raw(e, key) != "null"), plain(raw(e, key)))
    return rows.select(
        *[c for c in bodies.columns if c != column],
        (F.col("_n") + 1).alias("edit_no"),
        text_field(e, "turn_id").alias("turn_id"),
        action.alias("action"),
        given("text").alias("text"),
        given("emotion").alias("emotion"),
        given("turn_type").alias("turn_type"),
    ).where(F.col("turn_id") != "")


def turn_items(bodies: DataFrame, column: str = "body") -> DataFrame:
    """Items of a formatter's reply, one row each in their order, for ``normalise_items``.

    Accepts ``{"turns": [...]}``, a bare list, or one list under any key.  A reply without
    a list of objects is one row with ``is_error`` and no item.  A JSON null reads as
    absent.
    """
    body = F.col(column)
    parsed = bodies.withColumn("_f", fields(body))
    starts = lambda v: F.startswith(v, F.lit("["))
    named = raw(F.col("_f"), "turns")
    lists = F.filter(F.map_values("_f"), starts)
    listed = F.when(starts(body), body).when(starts(named), named).otherwise(F.try_element_at(lists, F.lit(1)))
    rows = parsed.select(*bodies.columns, F.posexplode_outer(objects(listed)).alias("_n", "_e"))
    item = F.transform_values("_e", lambda _, v: F.when(v != "null", plain(v)))
    return rows.select(
        *[c for c in bodies.columns if c != column],
        (F.col("_n") + 1).cast("bigint").alias("pos"),
        item.alias("item"),
        F.col("_e").isNull().alias("is_error"),
    )


def topics(bodies: DataFrame, column: str = "body") -> DataFrame:
    """Title and context of a topic reply; a missing title is an error."""
    f = F.col("_f")
    title = text_field(f, "title")
    return bodies.withColumn("_f", F.from_json(first_object(F.col(column)), "map<string,variant>")).withColumn(
        "_f",
        last_wins(
            F.transform(F.map_entries("_f"), lambda x: F.struct(x["key"].alias("key"), F.to_json(x["value"]).alias("value")))
        ),
    ).select(
        *[c for c in bodies.columns if c != column],
        F.nullif(title, F.lit("")).alias("title"),
        text_field(f, "context").alias("context"),
        (F.coalesce(title, F.lit("")) == "").alias("is_error"),
    )
