"""Where queries and their SQL counterparts are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tenura.registry.inputs import rounded

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, run: Query, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = lambda spark, sf_dir: rounded(run(spark, sf_dir))
    if sql is not None:
        ORACLES[name] = sql


def query(name: str, sql: str | None = None):
    """Decorator form of ``register``."""

    def keep(run: Query) -> Query:
        register(name, run, sql)
        return run

    return keep
