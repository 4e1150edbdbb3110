"""Registered queries: one Spark callable and, where SQL can say it, one ANSI SQL text per operator."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from placeloom.plans.views import Tables, with_views
from placeloom.session import broadcast_measured, small_shares, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame`; `sql` may name any view of `views.VIEWS` (pulled in as CTEs)."""
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(small_shares(broadcast_measured(tune(spark))), sf_dir))
        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn
    return wrap
