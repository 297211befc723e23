"""All registered queries; importing the query modules fills the registry."""

from __future__ import annotations

from riskframe.plans import (  # noqa: F401
    evaluation_queries,
    model_queries,
    row_queries,
    table_queries,
)
from riskframe.plans.registry import ORACLES, QUERIES, runnable


def queries():
    return {name: runnable(name) for name in QUERIES}


def oracle_sql():
    return dict(ORACLES)
