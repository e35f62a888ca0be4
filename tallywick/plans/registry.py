"""Registered queries and, where SQL can say the same, the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallywick.plans.views import Tables, check_sql
from tallywick.session import reach_workers


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Tables], DataFrame]
    covers: tuple[str, ...]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, covers: str, views: Sequence[str] = (), sql: str | None = None):
    """Register a function of the tables under `name`; `covers` lists the operator ids it runs."""

    def register(run: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"two queries named {name}")
        text = None if sql is None else check_sql(sql, *views)
        REGISTRY[name] = Query(name, run, tuple(covers.split()), text)
        return run

    return register


def load_all() -> dict[str, Query]:
    from tallywick.plans import (  # noqa: F401  (importing a module registers its queries)
        graph_queries,
        kvlog_queries,
        layout_queries,
        monitor_queries,
        ngram_queries,
        pageview_queries,
        scalar_queries,
        social_queries,
        song_queries,
        star_queries,
        stream_queries,
        tweet_queries,
    )

    return REGISTRY


def callable_for(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return REGISTRY[name].run(Tables(reach_workers(spark), sf_dir))

    run.__name__ = name
    return run
