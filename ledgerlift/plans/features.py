"""From raw advances, labels and transactions to one row of features per labelled user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlift.operators.cohort import first_per_key, label_join
from ledgerlift.operators.diversity import LOOKBACKS, fill_with_max, user_features
from ledgerlift.operators.spending import Categories, spending_categories
from ledgerlift.operators.supervised import assemble, labelled_users, target_column
from ledgerlift.session import stage
from ledgerlift.sources import tables


def first_advances(advances: DataFrame, mode: str = "per_column") -> DataFrame:
    """The first advance of every user."""
    return first_per_key(advances, "user_id", "underwritten_at", "request_id", mode)


def supervised_table(
    advances: DataFrame,
    labels: DataFrame,
    tx: DataFrame,
    target: str | None = None,
    categories: Categories | None = None,
    lookbacks=LOOKBACKS,
    as_of: bool = False,
    drop_null_labels: bool = False,
    variant: str = "standard",
    category_limit: int = 1000,
) -> DataFrame:
    """``user_id, request_id, target`` and all features, one row per labelled user and label.

    Only the transactions of labelled users are aggregated; the others cannot reach the result. The
    labelled users are staged first, so Spark knows their size when it plans the join with the
    transactions: few users are broadcast and the transactions stay where they are.
    ``as_of`` also cuts spending and flow at the anchor date. ``variant='exploratory'`` takes the
    exploratory diversity features: users without history get the largest recency. More than
    ``category_limit`` spending categories are an error, never a cut.
    """
    target = target or target_column(labels)
    categories = categories or spending_categories(tx, category_limit)
    joined = label_join(first_advances(advances), labels)
    joined = stage(joined.select("user_id", "request_id", "underwritten_at", target), "cohort")
    users = labelled_users(joined, target, ("user_id", "request_id"), drop_null_labels)
    anchors = joined.select("user_id", "underwritten_at").distinct()
    names = categories.names if categories.any_outflow else []
    block = user_features(tx, anchors, names, lookbacks, as_of, variant=variant)
    if variant == "exploratory":
        # The largest recency among the anchored users stands in where there is none.
        block = stage(block, "features")
        block = fill_with_max(anchors.select("user_id").distinct().join(block, "user_id", "left"), "days_since_last_transaction")
    return assemble(users, [block])


def load_supervised(
    spark: SparkSession,
    advances_path: str,
    labels_path: str,
    transaction_paths: list[str],
    date_formats: tuple[str, ...] = (),
    user_id_type: str | None = None,
    **options,
) -> DataFrame:
    """The supervised table straight from parquet files."""
    advances = tables.normalize_advances(tables.read_parquet(spark, advances_path), date_formats, user_id_type)
    labels = tables.normalize_labels(tables.read_parquet(spark, labels_path))
    files = tables.read_existing(spark, transaction_paths)
    # Of a transaction's own id only matters whether it is there: no decoding.
    files = [tables.presence_only(f, "id") for f in files]
    tx = tables.normalize_transaction_files(files, date_formats, user_id_type)
    return supervised_table(advances, labels, tx, **options)
