"""Call logs: token usage, limit errors, truncation, and scoring with a model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duologue.functions import fixed_values as fv

# Fixed value: the two field families of usage objects.
USAGE_OBJECT = (
    "prompt_tokens bigint, completion_tokens bigint, prompt_tokens_details struct<cached_tokens: bigint>, "
    "prompt_token_count bigint, candidates_token_count bigint, cached_content_token_count bigint, thoughts_token_count bigint"
)
USAGE_FIELDS = ["input_tokens", "output_tokens", "cache_tokens", "total_tokens", "calls"]


def limit_error(status: Column, error_type: Column, message: Column) -> Column:
    """Does a failed call report an exhausted rate limit or quota?"""
    text = F.lower(F.coalesce(message, F.lit("")))
    name = F.lower(F.coalesce(error_type, F.lit("")))
    found = F.coalesce(status == 429, F.lit(False)) | name.contains("ratelimit") | name.contains("rate_limit")
    for mark in fv.LIMIT_MARKS + fv.LIMIT_PHRASES:
        found = found | text.contains(mark)
    return found


def normalise_usage(log: DataFrame, column: str = "reply") -> DataFrame:
    """Token counts of raw replies in either field family; no usage object, no row.

    A missing or null count is 0.  Event-stream replies carry no cache count.
    """
    number = lambda *names: F.coalesce(*[F.col(f"_u.{n}") for n in names], F.lit(0).cast("bigint"))
    streamed = F.coalesce(F.col("streamed"), F.lit(False)) if "streamed" in log.columns else F.lit(False)
    kept = [c for c in log.columns if c not in (column, "streamed")]
    # The reply is parsed once; its usage object, a short text, is parsed again by type.
    outer = log.withColumn("_r", F.from_json(column, "usage string, usage_metadata string"))
    found = outer.withColumn(
        "_u",
        F.from_json(
            F.coalesce(F.nullif(F.col("_r.usage"), F.lit("{}")), F.nullif(F.col("_r.usage_metadata"), F.lit("{}"))), USAGE_OBJECT
        ),
    )
    # Explode instead of a filter, which would move below the parsing and repeat it.
    present = found.select(
        *kept, streamed.alias("_streamed"), F.explode_outer(F.array("_u")).alias("_u")
    ).where("_u is not null")
    cached = number("prompt_tokens_details.cached_tokens", "cached_content_token_count")
    return present.select(
        *kept,
        number("prompt_tokens", "prompt_token_count").alias("input_tokens"),
        number("completion_tokens", "candidates_token_count").alias("output_tokens"),
        F.when(F.col("_streamed"), F.lit(0).cast("bigint")).otherwise(cached).alias("cache_tokens"),
        number("thoughts_token_count").alias("thinking_tokens"),
    )


def truncation(log: DataFrame) -> DataFrame:
    """Replies cut off by the token budget, with the message to report."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("None"))
    message = F.concat(
        F.lit("Reply cut by the token budget (max_tokens="), text("max_tokens"),
        F.lit(", thinking="), text("thinking_tokens"), F.lit(", output="), text("output_tokens"), F.lit(")."),
    )
    cut = F.coalesce(F.col("finish_reason") == "MAX_TOKENS", F.lit(False))
    return log.withColumn("is_truncated", cut).withColumn("message", F.when(cut, message))


def token_rollup(calls: DataFrame) -> DataFrame:
    """Totals per model and overall (``model`` = ``total``); cache is not in the total."""
    used = calls.where("input_tokens is not null or output_tokens is not null or cache_tokens is not null")
    zero = F.lit(0).cast("bigint")
    amount = lambda name: F.sum(F.coalesce(F.col(name).cast("bigint"), zero)).alias(name)
    return (
        used.rollup("model")
        .agg(
            F.grouping("model").alias("_all"),
            amount("input_tokens"),
            amount("output_tokens"),
            amount("cache_tokens"),
            F.count("*").alias("calls"),
        )
        .select(
            F.when(F.col("_all") == 1, "total").otherwise(F.col("model")).alias("model"),
            "input_tokens",
            "output_tokens",
            "cache_tokens",
            (F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens"),
            "calls",
            (F.col("_all") == 1).alias("is_total"),
        )
    )


def token_metrics(rollup: DataFrame) -> DataFrame:
    """Wide usage as long ``tokens/<model>/<field>`` metrics."""
    name = F.when(F.col("is_total"), "total").otherwise(F.translate("model", "/ ", "__"))
    wide = rollup.select(
        name.alias("name"),
        "is_total",
        *[F.col(c).alias(c.removesuffix("_tokens")) for c in USAGE_FIELDS],
    )
    long = wide.unpivot(["name", "is_total"], ["input", "output", "cache", "total", "calls"], "field", "value")
    field = F.when(F.col("is_total") & (F.col("field") == "total"), "all").otherwise(F.col("field"))
    return long.select(F.concat_ws("/", F.lit("tokens"), "name", field).alias("metric"), "value")


def score_rows(
    requests: DataFrame,
    make_model: Callable[[], Callable[[str], str]],
    key: str = "request_id",
    column: str = "prompt",
    partitions: int | None = None,
) -> DataFrame:
    """Apply a text-to-text model to every request; replies keep the request key.

    ``make_model`` is called once per Python worker task.  A failing call yields a
    row with its error, so one bad request does not fail the job.  Filter before
    this step: nothing is pushed through Python.  ``partitions`` spreads costly
    calls by key.
    """
    if partitions:
        requests = requests.repartition(partitions, key)
    key_type = requests.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for batch in batches:
            replies, error_types, errors = [], [], []
            for prompt in batch[column]:
                try:
                    replies.append(model(prompt))
                    error_types.append(None)
                    errors.append(None)
                except Exception as problem:
                    replies.append(None)
                    error_types.append(type(problem).__name__)
                    errors.append(str(problem))
            yield pd.DataFrame({key: batch[key], "reply": replies, "error_type": error_types, "error": errors})

    return requests.select(key, column).mapInPandas(
        run, schema=f"{key} {key_type}, reply string, error_type string, error string"
    )
