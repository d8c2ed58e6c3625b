"""Registry of queries: a Spark plan per operator and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.bridge import Tables, check_sql

PLANS: dict[str, Callable[[Tables], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, deps: Sequence[str] = (), sql: str | None = None):
    """Register ``fn(tables)`` under ``name``; ``sql`` is its DuckDB equivalent over ``deps``."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in PLANS:
            raise ValueError(f"query {name} registered twice")
        PLANS[name] = fn
        if sql is not None:
            CHECKS[name] = check_sql(list(deps), sql)
        return fn

    return register


def as_callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: fn(Tables(spark, sf_dir))

    return {name: bind(fn) for name, fn in PLANS.items()}
