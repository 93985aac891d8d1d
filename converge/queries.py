"""All registered queries over the shared tables but those of the llm subpackage, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from converge.plans import projection, quality, reconcile, search, sources

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for _plans in (search, reconcile, projection, sources, quality):
    QUERIES |= _plans.QUERIES
    ORACLE_SQL |= _plans.ORACLE_SQL
