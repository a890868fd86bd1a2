"""Registry of named queries: a Spark builder and (when SQL can express it)
the equivalent DuckDB SQL used as a value oracle.

Every builder takes ``(spark, sf_dir)`` and reads the driver tables (or data
Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from clickweave.sources.tables import CLICKS_CTE, EVENT_CLICKS_CTE, MANUAL_LABELS_CTE  # noqa: F401


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    survey_id: str


REGISTRY: dict[str, Query] = {}


def with_ctes(body: str, *ctes: str) -> str:
    """Prefix ``body`` (which may start with further ``name AS (...)`` CTEs
    separated by commas, then a final SELECT) with the shared CTEs."""
    return "WITH " + ",\n".join(ctes) + body


def clicks_sql(body: str) -> str:
    """``body`` must begin with ``,`` (more CTEs) or ``\\nSELECT``."""
    return "WITH " + CLICKS_CTE + body


def events_sql(body: str) -> str:
    return "WITH " + EVENT_CLICKS_CTE + body


def labels_sql(body: str) -> str:
    return "WITH " + CLICKS_CTE + ",\n" + MANUAL_LABELS_CTE + body


def register(key: str, survey_id: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, fn, sql, survey_id)
        return fn
    return deco
