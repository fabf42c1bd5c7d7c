"""Registered queries: one Spark callable and (where SQL can express it) one
DuckDB oracle statement per SURVEY §2 key.

Every query reads the driver's tables through ``plans/fixtures.py`` and runs
over whole tables and whole texts.  Column names are identical on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register keys."""
    from . import q_logs, q_orders, q_traffic, q_changes, q_listings, q_misc  # noqa: F401
