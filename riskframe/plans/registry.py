"""Names of the registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskframe.plans.data import IncidentData, incident_data

QUERIES: dict[str, Callable[[IncidentData], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(data)`` under ``name``; ``sql`` is the twin that DuckDB runs."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return QUERIES[name](incident_data(spark, sf_dir))

    run.__name__ = name
    return run
