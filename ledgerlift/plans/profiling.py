"""Profiles of several raw tables at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.operators import profile


def _labelled(reports: dict[str, DataFrame]) -> DataFrame:
    named = [df.select(F.lit(name).alias("table_name"), "*") for name, df in reports.items()]
    return reduce(DataFrame.unionByName, named)


def table_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and cells of every table."""
    return _labelled({name: profile.shape(df) for name, df in tables.items()})


def table_nulls(tables: dict[str, DataFrame]) -> DataFrame:
    """Share of missing values of every column of every table."""
    return _labelled({name: profile.null_fraction(df) for name, df in tables.items()})


def table_schemas(tables: dict[str, DataFrame]) -> DataFrame:
    """Column names and types of every table."""
    return _labelled({name: profile.schema_listing(df) for name, df in tables.items()})


def key_counts(tables: dict[str, DataFrame], key: str = "user_id") -> DataFrame:
    """Distinct keys of every table that has the key."""
    found = {name: profile.distinct_counts(df, [key], bitmaps=True) for name, df in tables.items() if key in df.columns}
    return _labelled(found).drop("column_name")
