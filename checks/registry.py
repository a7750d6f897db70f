"""All check queries: name -> (Spark callable, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from checks import views_sql
from checks.views import Views
from duologue.functions import fixed_values as fv

MODULES = ["catalog_voice", "catalog_turns", "catalog_corpus", "catalog_text", "catalog_files", "catalog_streams"]


@cache
def catalog() -> dict[str, tuple[Callable[[Views], DataFrame], str | None]]:
    views = views_sql.build(fv.TOPIC_DOMAINS, fv.RELATION_KINDS)
    found: dict[str, tuple[Callable[[Views], DataFrame], str | None]] = {}

    def q(name: str, query: Callable[[Views], DataFrame], sql: str | None = None) -> None:
        if name in found:
            raise ValueError(f"query {name} is registered twice")
        found[name] = (query, views_sql.with_views(sql.strip(), views) if sql else None)

    for module in MODULES:
        import_module(f"checks.{module}").register(q)
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Callable[[Views], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: query(Views(spark, folder))

    return {name: bind(query) for name, (query, _) in catalog().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in catalog().items() if sql}
