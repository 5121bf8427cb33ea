"""How varied a user's history is before an anchor date.

The plan has two aggregates behind the join with the anchors, each with partial sums before its
shuffle:

1. every transaction counts for its merchant, its category and its detailed category: one row per
   (anchor, kind, value) with a count, the first and the latest date;
2. one row per anchor.

The lookback windows share their end, the anchor date, so a merchant is in the last N days exactly
if its latest date is. Distinct counts over windows thus become comparisons on one maximum, and no
step counts distinct values or joins a window back. After a shuffled join all rows of a user are in
one place, so the partial sums of step 1 shrink them to their distinct values before they move.

The anchor (user and date) is kept as one struct. Aggregating on it cannot reuse the partitioning of
the join on ``user_id``, so a user with very many rows is spread over tasks by value, and the
adaptive skew join stays free to split that user's side of the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.arithmetic import checked_sum, days_before, from_units, guarded_ratio, units, whole_days
from ledgerlift.operators.flow import FLOW_COLUMNS, with_flow_ratios
from ledgerlift.operators.spending import INCOME, INFLOW_CATEGORIES, TRANSFER_IN
from ledgerlift.session import stage
from ledgerlift.sources.tables import require_same_type

# The lookback windows in days.
LOOKBACKS = (30, 60, 90)
MERCHANT, CATEGORY, DETAIL = 0, 1, 2
KINDS = {MERCHANT: "merchant_name", CATEGORY: "primary_category", DETAIL: "detailed_category"}


def join_anchors(tx: DataFrame, anchors: DataFrame) -> DataFrame:
    """Transactions of anchored users with their ``underwritten_at``. One anchor per user."""
    require_same_type(tx, anchors, "user_id")
    return tx.join(anchors.select("user_id", "underwritten_at"), "user_id", "inner")


def before_anchor(tx: DataFrame, anchors: DataFrame, days: int | None = None) -> DataFrame:
    """Transactions strictly before the anchor, and not more than ``days`` days before it."""
    rows = join_anchors(tx, anchors).where(F.col("date") < F.col("underwritten_at"))
    if days is not None:
        rows = rows.where(F.col("date") >= days_before(F.col("underwritten_at"), days))
    return rows


def merchant_counts(rows: DataFrame) -> DataFrame:
    """Transactions per user and known merchant.

    Grouped on the pair as one value, so that rows which come partitioned by user from a join are
    spread by merchant too.
    """
    known = rows.where(F.col("user_id").isNotNull() & F.col("merchant_name").isNotNull())
    pairs = known.groupBy(F.struct("user_id", "merchant_name").alias("pair")).agg(F.count(F.lit(1)).alias("cnt"))
    return pairs.select("pair.user_id", "pair.merchant_name", "cnt")


def per_user(rows: DataFrame, *aggregates: Column) -> DataFrame:
    """Aggregates per user over rows that come from a join on the user.

    Grouping on the user as a struct keeps the partial sums before a shuffle of their own.
    """
    grouped = rows.where(F.col("user_id").isNotNull()).groupBy(F.struct("user_id").alias("_user")).agg(*aggregates)
    return grouped.select("_user.user_id", *[c for c in grouped.columns if c != "_user"])


def merchant_concentration(rows: DataFrame, over: str = "transactions") -> DataFrame:
    """Sum of squared merchant shares per user.

    ``over='transactions'`` divides by the user's transactions (a Herfindahl index);
    ``over='merchants'`` divides by the number of distinct merchants.
    """
    return merchant_counts(rows).groupBy("user_id").agg(
        _concentration(F.lit(True), over).alias("merchant_concentration")
    )


def recurring_merchants(rows: DataFrame, least: int = 3) -> DataFrame:
    """Merchants with at least ``least`` transactions, their number and share, per user."""
    per_user = merchant_counts(rows).groupBy("user_id").agg(
        F.count_if(F.col("cnt") >= least).alias("recurring_merchants_count"),
        F.count(F.lit(1)).alias("unique_merchants"),
    )
    share = guarded_ratio(F.col("recurring_merchants_count"), F.col("unique_merchants"))
    return per_user.withColumn("recurring_merchant_pct", share)


def _concentration(where: Column, over: str, cnt: str = "cnt") -> Column:
    n = F.when(where, F.col(cnt).cast("double"))
    if over == "transactions":
        base = F.sum(n)
    elif over == "merchants":
        base = F.count(n).cast("double")
    else:
        raise ValueError(f"unknown denominator {over}")
    return F.coalesce(F.sum(n * n) / F.nullif(base * base, F.lit(0.0)), F.lit(0.0))


def _by_value(joined: DataFrame, lookbacks, money: bool, scale: int = 4) -> DataFrame:
    """Step 1: counts, dates and money per (anchor, kind, value)."""
    date, anchor = F.col("date"), F.col("underwritten_at")
    past = F.coalesce(date < anchor, F.lit(False))
    known_id = past & F.col("id").isNotNull()
    columns = {
        "past": past,
        "past_date": F.when(past, date),
        "ids": known_id.cast("int"),
    }
    for n in lookbacks:
        columns[f"ids_{n}"] = F.coalesce(known_id & (date >= days_before(anchor, n)), F.lit(False)).cast("int")
    if money:
        value = units(F.col("amount"), scale)
        columns["out_units"] = F.when(F.col("amount") > 0, value).otherwise(F.lit(0))
        columns["in_units"] = F.when(F.col("amount") < 0, value).otherwise(F.lit(0))
    entries = [F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in KINDS.items()]
    rows = joined.select(
        F.struct("user_id", "underwritten_at").alias("anchor"),
        *[c.alias(name) for name, c in columns.items()],
        F.inline(F.array(*entries)),
    )
    totals = [name for name in columns if name not in ("past", "past_date")]
    return rows.groupBy("anchor", "kind", "value").agg(
        F.count_if("past").alias("cnt"),
        F.min("past_date").alias("first_date"),
        F.max("past_date").alias("last_date"),
        *[(checked_sum(F.col(name)) if name.endswith("_units") else F.sum(name)).alias(name) for name in totals],
    )


def _per_anchor(by_value: DataFrame, lookbacks, over: str, names: list[str] | None, scale: int) -> DataFrame:
    """Step 2: one row per anchor. Every transaction has one category row, so totals add those up."""
    known = F.col("value").isNotNull() & (F.col("cnt") > 0)
    merchant = known & (F.col("kind") == MERCHANT)
    category = known & (F.col("kind") == CATEGORY)

    def total(c: str) -> Column:
        return F.sum(F.when(F.col("kind") == CATEGORY, F.col(c)))

    columns = [
        F.count_if(merchant).alias("unique_merchants_all_time"),
        F.count_if(category).alias("unique_categories_all_time"),
        F.count_if(known & (F.col("kind") == DETAIL)).alias("unique_detailed_categories"),
        total("ids").alias("total_transactions_all_time"),
        _concentration(merchant, over).alias("merchant_concentration"),
        F.count_if(merchant & (F.col("cnt") >= 3)).alias("recurring_merchants_count"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    ]
    for n in lookbacks:
        recent = F.col("last_date") >= days_before(F.col("anchor.underwritten_at"), n)
        columns += [
            F.count_if(merchant & recent).alias(f"unique_merchants_{n}d"),
            F.count_if(category & recent).alias(f"unique_categories_{n}d"),
            total(f"ids_{n}").alias(f"transaction_count_{n}d"),
        ]
    if names is not None:
        value, spend = F.col("value"), F.col("value").isNotNull() & ~F.col("value").isin(*INFLOW_CATEGORIES)

        def money(c: str, where: Column) -> Column:
            where = (F.col("kind") == CATEGORY) & where
            return from_units(checked_sum(F.when(where, F.col(c))), scale)

        columns += [money("out_units", value == name).alias(f"spent:{name}") for name in names]
        columns += [
            money("out_units", spend).alias("total_outflow"),
            F.abs(money("in_units", value.isin(*INFLOW_CATEGORIES))).alias("total_inflow"),
            F.abs(money("in_units", value == INCOME)).alias("total_income"),
            F.abs(money("in_units", value == TRANSFER_IN)).alias("total_transfer_in"),
        ]
    return by_value.groupBy("anchor").agg(*columns)


def _with_time_features(df: DataFrame) -> DataFrame:
    span = F.greatest(whole_days(F.col("last_date"), F.col("first_date")), F.lit(0))
    return df.withColumns(
        {
            "time_span_days": span,
            "transaction_frequency_all_time": guarded_ratio(F.col("total_transactions_all_time"), span),
            "days_since_last_transaction": whole_days(F.col("anchor.underwritten_at"), F.col("last_date")),
        }
    )


def diversity_columns(lookbacks=LOOKBACKS) -> list[str]:
    """Output columns in order."""
    # The published feature names.
    columns = [
        "unique_merchants_all_time",
        "unique_categories_all_time",
        "unique_detailed_categories",
        "total_transactions_all_time",
        "merchant_concentration",
        "recurring_merchants_count",
        "time_span_days",
        "transaction_frequency_all_time",
        "days_since_last_transaction",
    ]
    for n in lookbacks:
        columns += [f"unique_merchants_{n}d", f"unique_categories_{n}d", f"transaction_count_{n}d"]
    return columns


def fill_with_max(df: DataFrame, column: str) -> DataFrame:
    """Fill missing values with the column's maximum, or with 0 if it has none."""
    most = df.agg(F.max(column)).scalar()
    zero = F.lit(0).cast(df.schema[column].dataType)
    return df.withColumn(column, F.coalesce(F.col(column), most, zero))


def _of_variant(features: DataFrame, lookbacks, variant: str) -> tuple[DataFrame, list[str]]:
    """The features of a variant, and their names in order."""
    columns = diversity_columns(lookbacks)
    if variant == "exploratory":
        share = guarded_ratio(F.col("recurring_merchants_count"), F.col("unique_merchants_all_time"))
        features = features.withColumn("recurring_merchant_pct", share)
        columns = [c for c in columns if c != "time_span_days"] + ["recurring_merchant_pct"]
    return features, columns


def diversity_features(
    tx: DataFrame, anchors: DataFrame, lookbacks=LOOKBACKS, variant: str = "standard"
) -> DataFrame:
    """One row per anchored user; users without history get zeros.

    ``variant='exploratory'`` divides the concentration by distinct merchants, adds
    ``recurring_merchant_pct``, leaves ``time_span_days`` out, and gives users without history the
    largest recency instead of 0.
    """
    if variant not in ("standard", "exploratory"):
        raise ValueError(f"unknown variant {variant}")
    over = "transactions" if variant == "standard" else "merchants"
    by_value = _by_value(before_anchor(tx, anchors), lookbacks, money=False)
    per_anchor = _per_anchor(by_value, lookbacks, over, None, 0)
    features, columns = _of_variant(_with_time_features(per_anchor), lookbacks, variant)
    features = features.select(F.col("anchor.user_id").alias("user_id"), *columns)
    out = anchors.select("user_id").join(features, "user_id", "left")
    if variant == "exploratory":
        # Staged, one row per user: the largest recency would else be a second pass over the transactions.
        out = fill_with_max(stage(out, "features"), "days_since_last_transaction")
    return out.na.fill(0, columns)


def user_features(
    tx: DataFrame, anchors: DataFrame, names: list[str], lookbacks=LOOKBACKS, as_of: bool = False, scale: int = 4,
    variant: str = "standard",
) -> DataFrame:
    """Spending shares, diversity and flow of the anchored users from one scan of the transactions.

    Users without any counted transaction are absent. Money counts all of a user's transactions, or
    with ``as_of`` only those before the anchor.
    """
    if variant not in ("standard", "exploratory"):
        raise ValueError(f"unknown variant {variant}")
    return features_of_partials(feature_partials(tx, anchors, lookbacks, as_of, scale), names, lookbacks, scale, variant)


def feature_partials(
    tx: DataFrame, anchors: DataFrame, lookbacks=LOOKBACKS, as_of: bool = False, scale: int = 4
) -> DataFrame:
    """What the features of anchored users are made from: counts, dates and money per (anchor, kind, value).

    Partials of different transactions can be merged, see ``merged_partials``.
    """
    rows = before_anchor(tx, anchors) if as_of else join_anchors(tx, anchors)
    return _by_value(rows, lookbacks, money=True, scale=scale)


def merged_partials(partials: DataFrame) -> DataFrame:
    """One partial per (anchor, kind, value) from those of several sets of transactions."""

    def merge(c: str) -> Column:
        if c in ("first_date", "last_date"):
            return (F.min if c == "first_date" else F.max)(c)
        return checked_sum(F.col(c)) if c.endswith("_units") else F.sum(c)

    keys = ("anchor", "kind", "value")
    return partials.groupBy(*keys).agg(*[merge(c).alias(c) for c in partials.columns if c not in keys])


def features_of_partials(
    by_value: DataFrame, names: list[str], lookbacks=LOOKBACKS, scale: int = 4, variant: str = "standard"
) -> DataFrame:
    """One row of features per anchored user from merged partials."""
    over = "transactions" if variant == "standard" else "merchants"
    per_anchor = _per_anchor(by_value, lookbacks, over, names, scale)
    features, columns = _of_variant(with_flow_ratios(_with_time_features(per_anchor)), lookbacks, variant)
    shares = [guarded_ratio(F.col(f"`spent:{n}`"), F.col("total_outflow")).alias(n) for n in names]
    return features.select(
        F.col("anchor.user_id").alias("user_id"),
        *shares,
        F.col("total_outflow").alias("total_spending"),
        *columns,
        *FLOW_COLUMNS,
    )
