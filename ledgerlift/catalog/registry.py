"""The two dictionaries the queries are collected in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (views) as a query, with its SQL if it has one."""
    from ledgerlift.catalog.views import Views

    def register(build):
        QUERIES[name] = lambda spark, sf_dir: build(Views(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return build

    return register
