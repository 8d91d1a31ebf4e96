"""Names of all core queries, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siftwork.plans import core_queries, problem_queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return core_queries.QUERIES | {"p6_found": problem_queries.p6_found, "p6_times": problem_queries.p6_times}


def oracle_sql() -> dict[str, str]:
    return core_queries.ORACLE | problem_queries.oracle_sql()
