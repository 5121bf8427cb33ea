"""First event per key, label joins, key sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.sources.tables import require_same_type


def _order(time: str, tie: str) -> list[Column]:
    return [F.col(time).asc_nulls_last(), F.col(tie).asc_nulls_last()]


def first_per_key(
    df: DataFrame, key: str, time: str, tie: str, mode: str = "per_column"
) -> DataFrame:
    """One row per non-null key, earliest ``time`` first, null times last, ties broken by ``tie``.

    ``per_column`` gives for each column its first non-null value, which may come from different
    rows; ``row`` gives the first row as it is. Both reduce each key to one row per input
    partition before the shuffle, so a key with very many rows costs no more than any other.
    """
    known = df.where(F.col(key).isNotNull())
    if mode == "row":
        numbered = known.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*_order(time, tie))))
        return numbered.where("_n = 1").drop("_n")
    if mode != "per_column":
        raise ValueError(f"unknown mode {mode}")
    rank = F.struct(F.col(time).isNull(), F.col(time), F.col(tie).isNull(), F.col(tie))
    firsts = [
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in df.columns if c != key
    ]
    return known.groupBy(key).agg(*firsts).select(*df.columns)


def label_join(firsts: DataFrame, labels: DataFrame, left: str = "request_id", right: str = "advance_id") -> DataFrame:
    """First advances with their labels. Null ids match nothing."""
    if firsts.schema[left].dataType != labels.schema[right].dataType:
        raise TypeError(f"{left} and {right} have different types")
    return firsts.join(labels, F.col(left) == F.col(right), "inner")


def keep_known_users(df: DataFrame, users: DataFrame, key: str = "user_id") -> DataFrame:
    """Rows whose key occurs in ``users``."""
    require_same_type(df, users, key)
    return df.join(users.select(key), key, "left_semi")


def common_keys(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Distinct keys, as text, found on both sides.

    Each side is reduced to its distinct keys before they meet.
    """
    def keys(df: DataFrame, c: str) -> DataFrame:
        return df.where(F.col(c).isNotNull()).select(F.col(c).cast("string").alias("key")).distinct()

    return keys(left, left_key).join(keys(right, right_key), "key", "left_semi")


def key_overlap(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """How many distinct keys both sides share."""
    return common_keys(left, left_key, right, right_key).agg(F.count(F.lit(1)).alias("shared_keys"))


def distinct_values(df: DataFrame, column: str, without: tuple = ()) -> DataFrame:
    """Distinct non-null values of a column, less the listed ones."""
    kept = df.where(F.col(column).isNotNull())
    if without:
        kept = kept.where(~F.col(column).isin(*without))
    return kept.select(column).distinct()


def top_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows by a stated order."""
    return df.orderBy(*order).limit(n)
