"""Features that grow with their transactions: a new file is folded in without reading the earlier ones.

The state is a table of mergeable partials - counts, first and latest dates, money in whole units per
(anchor, kind, value) - with the anchors beside it. A new file adds its own partials as one more part of the
table. Features are made from the partials, and after an append only those of users that it touched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.operators.diversity import CATEGORY, LOOKBACKS, feature_partials, features_of_partials, merged_partials
from ledgerlift.operators.spending import INFLOW_CATEGORIES
from ledgerlift.session import stage
from ledgerlift.sources.tables import path_exists


@dataclass(frozen=True)
class FeatureState:
    """The partials and anchors kept under ``path``.

    The anchors are fixed when the state is begun: a user's features count up to the same moment in every
    part. Other anchors need a state of their own.
    """

    spark: SparkSession
    path: str
    lookbacks: tuple[int, ...] = LOOKBACKS
    as_of: bool = False
    scale: int = 4

    def begin(self, anchors: DataFrame) -> None:
        """An empty state for the users of ``anchors`` (user_id, underwritten_at; one row each)."""
        anchors.select("user_id", "underwritten_at").write.parquet(f"{self.path}/anchors")

    def anchors(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/anchors")

    def partials(self) -> DataFrame:
        """All partials; those of one (anchor, kind, value) may be in several parts."""
        return self.spark.read.parquet(f"{self.path}/partials")

    def append(self, tx: DataFrame) -> DataFrame:
        """Fold new transactions in; the users that they touch. ``tx`` must not be in the state already."""
        new = stage(feature_partials(tx, self.anchors(), self.lookbacks, self.as_of, self.scale), "partials")
        new.write.mode("append").parquet(f"{self.path}/partials")
        return new.select(F.col("anchor.user_id").alias("user_id")).distinct()

    def compact(self) -> None:
        """Merge the parts into one, so that reading does not grow with the number of appends."""
        whole = stage(merged_partials(self.partials()), "partials")
        whole.write.mode("overwrite").parquet(f"{self.path}/partials")

    def categories(self) -> list[str]:
        """The spending categories so far, in order; they become columns."""
        value = F.col("value")
        found = self.partials().where((F.col("kind") == CATEGORY) & value.isNotNull() & ~value.isin(*INFLOW_CATEGORIES))
        return sorted(r["value"] for r in found.select("value").distinct().collect())

    def features(self, users: DataFrame | None = None, names: list[str] | None = None) -> DataFrame:
        """The features of all users with transactions, or of some of them."""
        partials = self.partials() if path_exists(self.spark, f"{self.path}/partials") else None
        if partials is None:
            raise ValueError("nothing has been appended yet")
        if users is not None:
            chosen = users.select(F.col("user_id").alias("chosen")).distinct()
            partials = partials.join(chosen, F.col("anchor.user_id") == F.col("chosen"), "left_semi")
        names = self.categories() if names is None else names
        return features_of_partials(merged_partials(partials), names, self.lookbacks, self.scale)

    def refresh(self, before: DataFrame, touched: DataFrame) -> DataFrame:
        """The features after an append from those before it: only touched users are made anew.

        A category that is new in the append is a new column, 0 for users that it did not touch.
        """
        anew = self.features(touched)
        kept = before.join(touched, "user_id", "left_anti")
        kept = kept.withColumns({c: F.lit(0.0) for c in anew.columns if c not in kept.columns})
        return kept.select(*anew.columns).unionByName(anew)
