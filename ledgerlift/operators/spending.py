"""Outflow by category: sums, pivot, shares of the total."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.functions.arithmetic import exact_sum, guarded_ratio

# The two categories that are money coming in.
INCOME = "INCOME"
TRANSFER_IN = "TRANSFER_IN"
INFLOW_CATEGORIES = (INCOME, TRANSFER_IN)


class Categories(NamedTuple):
    """The outflow categories of a transaction table, and whether it has any outflow row."""

    names: list[str]
    any_outflow: bool


def is_outflow() -> Column:
    """Money going out: a known category other than the inflow ones, and a positive amount."""
    category, amount = F.col("primary_category"), F.col("amount")
    return category.isNotNull() & ~category.isin(*INFLOW_CATEGORIES) & (amount > 0)


def outflow(tx: DataFrame) -> DataFrame:
    return tx.where(F.col("user_id").isNotNull() & is_outflow())


def spending_categories(tx: DataFrame, limit: int = 1000) -> Categories:
    """All non-inflow categories that occur, in order.

    They become column names, so they have to reach the driver; more than ``limit`` of them is an
    error, never a cut.
    """
    known = tx.where(F.col("primary_category").isNotNull() & ~F.col("primary_category").isin(*INFLOW_CATEGORIES))
    spends = F.bool_or((F.col("amount") > 0) & F.col("user_id").isNotNull())
    rows = known.groupBy("primary_category").agg(spends.alias("spends")).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} spending categories; they cannot all become columns")
    return Categories(sorted(r["primary_category"] for r in rows), any(r["spends"] for r in rows))


def user_category_sums(tx: DataFrame, scale: int = 4) -> DataFrame:
    """Outflow per user and category."""
    sums = outflow(tx).groupBy("user_id", "primary_category")
    return sums.agg(exact_sum(F.col("amount"), scale=scale).alias("amount"))


def spending_pivot(tx: DataFrame, names: list[str], scale: int = 4) -> DataFrame:
    """Outflow per user, one column per category and ``total_spending``; absent categories are 0.

    One conditional aggregate instead of a two-step pivot: a single shuffle on the user.
    """
    sums = [exact_sum(F.col("amount"), F.col("primary_category") == n, scale).alias(n) for n in names]
    total = exact_sum(F.col("amount"), scale=scale).alias("total_spending")
    return outflow(tx).groupBy("user_id").agg(*sums, total)


def spending_shares(
    tx: DataFrame, anchors: DataFrame | None = None, categories: Categories | None = None, scale: int = 4
) -> DataFrame:
    """Share of each category in a user's outflow, and the total.

    If there is no outflow at all, every anchored user gets a total of 0 and no share columns.
    """
    categories = categories or spending_categories(tx)
    if not categories.any_outflow:
        if anchors is None:
            raise ValueError("no outflow, and no anchors to fall back to")
        return anchors.select("user_id").distinct().withColumn("total_spending", F.lit(0.0))
    wide = spending_pivot(tx, categories.names, scale)
    shares = [guarded_ratio(F.col(f"`{n}`"), F.col("total_spending")).alias(n) for n in categories.names]
    return wide.select("user_id", *shares, "total_spending")


def spending_shares_long(tx: DataFrame, scale: int = 4) -> DataFrame:
    """The shares as rows (user_id, primary_category, share): any number of categories will do."""
    sums = user_category_sums(tx, scale)
    total = F.sum("amount").over(Window.partitionBy("user_id"))  # one row per user and category
    return sums.select("user_id", "primary_category", guarded_ratio(F.col("amount"), total).alias("share"))
