"""Registered queries of the change-data engine and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tideline.plans import catalog, cdc, monitoring, tables


def _entries():
    for module in (cdc, catalog, monitoring, tables):
        for entry in module.QUERIES:
            name, query, sql = entry if len(entry) == 3 else (entry[0].__name__, *entry)
            yield name, query, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, query, _ in _entries()}


def oracle_sql() -> dict[str, str]:
    return {name: sql.strip() for name, _, sql in _entries() if sql}
