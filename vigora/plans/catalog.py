"""Registry of the core's queries and of the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vigora.plans import documents, library, problems

GROUPS = (problems, documents, library)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for group in GROUPS for name, query in group.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for group in GROUPS for name, sql in group.ORACLE.items()}
