"""Registered queries over the given tables, each with its SQL counterpart where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stockspark.catalog import (
    aggregates,
    forecasting,
    inventory,
    loading,
    logbook,
    panels,
    seriesops,
    textrisk,
)

GROUPS = (loading, panels, aggregates, seriesops, forecasting, logbook, inventory, textrisk)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {}
    for group in GROUPS:
        found.update({name: entry[0] for name, entry in group.ENTRIES.items()})
    return found


def all_sql() -> dict[str, str]:
    found = {}
    for group in GROUPS:
        found.update({name: entry[1] for name, entry in group.ENTRIES.items() if entry[1]})
    return found
