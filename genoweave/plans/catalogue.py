"""All queries of the library, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from genoweave.plans import format_queries as formats
from genoweave.plans import queries as domain


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return domain.QUERIES | formats.QUERIES


def oracle_sql() -> dict[str, str]:
    return domain.SQL | formats.SQL
