"""Scaling features by their standard deviation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_scales(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Population standard deviation per column, 1 where a column does not vary."""
    row = df.agg(
        *[F.stddev_pop(F.col(f"`{c}`")).alias(f"s{i}") for i, c in enumerate(columns)],
        *[(F.min(F.col(f"`{c}`")) < F.max(F.col(f"`{c}`"))).alias(f"v{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"s{i}"] if row[f"v{i}"] and row[f"s{i}"] else 1.0) for i, c in enumerate(columns)}


def scale_by_std(df: DataFrame, columns: list[str]) -> DataFrame:
    """Divide each column by its population standard deviation, without centring."""
    scales = column_scales(df, columns)
    return df.withColumns({c: F.col(f"`{c}`").cast("double") / F.lit(s) for c, s in scales.items()})
