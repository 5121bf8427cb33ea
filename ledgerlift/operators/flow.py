"""Money in and money out per user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.arithmetic import clip, exact_sum, guarded_ratio
from ledgerlift.operators.spending import INCOME, INFLOW_CATEGORIES, TRANSFER_IN, is_outflow

# The published feature names.
FLOW_COLUMNS = (
    "total_outflow",
    "total_inflow",
    "total_income",
    "total_transfer_in",
    "outflow_inflow_ratio",
    "income_spent_pct",
)


def is_inflow() -> Column:
    """Money coming in: an inflow category and a negative amount."""
    return F.col("primary_category").isin(*INFLOW_CATEGORIES) & (F.col("amount") < 0)


def inflow_totals(tx: DataFrame, category: str | None = None, scale: int = 4) -> DataFrame:
    """Absolute inflow per user, over both inflow categories or one of them."""
    rows = tx.where(F.col("user_id").isNotNull() & is_inflow())
    if category is not None:
        rows = rows.where(F.col("primary_category") == category)
    return rows.groupBy("user_id").agg(F.abs(exact_sum(F.col("amount"), scale=scale)).alias("total"))


def with_flow_ratios(df: DataFrame) -> DataFrame:
    """Add the two ratios to a table with the four totals."""
    return df.withColumns(
        {
            "outflow_inflow_ratio": guarded_ratio(F.col("total_outflow"), F.col("total_inflow")),
            "income_spent_pct": clip(guarded_ratio(F.col("total_outflow"), F.col("total_income")), 0.0, 10.0),
        }
    )


def flow_metrics(tx: DataFrame, scale: int = 4) -> DataFrame:
    """Totals and ratios for every user with money going out or coming in.

    The four totals are conditional sums of one aggregate over the contributing rows, which leaves
    the same users as a full outer join of four separate totals.
    """
    rows = tx.where(F.col("user_id").isNotNull() & (is_outflow() | is_inflow()))
    amount, category = F.col("amount"), F.col("primary_category")
    totals = rows.groupBy("user_id").agg(
        exact_sum(amount, amount > 0, scale).alias("total_outflow"),
        F.abs(exact_sum(amount, amount < 0, scale)).alias("total_inflow"),
        F.abs(exact_sum(amount, category == INCOME, scale)).alias("total_income"),
        F.abs(exact_sum(amount, category == TRANSFER_IN, scale)).alias("total_transfer_in"),
    )
    return with_flow_ratios(totals)
