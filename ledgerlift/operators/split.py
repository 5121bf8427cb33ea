"""Exact stratified splits and folds, class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.operators.rank import ordered_totals


def shuffle_key(id: str, seed: int) -> Column:
    """A pseudo-random order key that depends only on the id and the seed."""
    return F.md5(F.concat_ws("|", F.col(id).cast("string"), F.lit(str(seed))))


def _shuffled(df: DataFrame, label: str, id: str, seed: int) -> DataFrame:
    """Rows numbered class by class, in pseudo-random order inside each class."""
    keyed = df.withColumn("_shuffle", shuffle_key(id, seed))
    ranked = ordered_totals(keyed, [F.col(label).asc_nulls_first(), F.col("_shuffle").asc(), F.col(id).asc()], rank="_place")
    return ranked.drop("_shuffle")


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class: ``class`` and ``n``. A null label is a class of its own."""
    return df.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))


def _train_places(counts: DataFrame, test_size: float) -> DataFrame:
    """Per class, the places (of all rows in class order) of its training rows: ``first`` to ``last``.

    Training rows per class are whole parts first, what is left goes to the largest remainders. The
    windows run over one row per class.
    """
    everything, in_order = Window.partitionBy(), Window.orderBy(F.col("class").asc_nulls_first())
    rows = counts.withColumn("total", F.sum("n").over(everything))
    wanted = F.col("total") - F.ceil(F.col("total") * F.lit(float(test_size)))
    rows = rows.withColumn("wanted", wanted).withColumn("exact", F.col("n") / F.col("total") * F.col("wanted"))
    rows = rows.withColumn("whole", F.floor("exact"))
    by_rest = Window.orderBy(F.desc(F.col("exact") - F.col("whole")), F.col("class").asc_nulls_first())
    rows = rows.withColumns(
        {
            "over": F.col("wanted") - F.sum("whole").over(everything),
            "rest": F.row_number().over(by_rest),
            "last": F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    size = F.col("whole") + (F.col("rest") <= F.col("over")).cast("int")
    return rows.select("class", (F.col("last") - size + 1).alias("first"), "last")


def stratified_split(
    df: DataFrame, label: str = "y", id: str = "id", test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``split`` ('train' or 'test'), with the share of every class kept to within one row."""
    places = _train_places(class_counts(df, label), test_size)
    places = places.select(*[F.col(c).alias(f"_{c}") for c in places.columns])
    placed = _shuffled(df, label, id, seed).join(places, F.col(label).eqNullSafe(F.col("_class")))
    is_train = F.col("_place").between(F.col("_first"), F.col("_last"))
    return placed.select(*df.columns, F.when(is_train, "train").otherwise("test").alias("split"))


def stratified_folds(
    df: DataFrame, label: str = "y", id: str = "id", folds: int = 5, seed: int = 42
) -> DataFrame:
    """Add ``fold`` from 0. Fold sizes, overall and per class, differ by at most one row."""
    placed = _shuffled(df, label, id, seed)
    return placed.withColumn("fold", F.pmod(F.col("_place") - 1, F.lit(folds)).cast("int")).drop("_place")


def sampled_split(df: DataFrame, id: str = "id", test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split`` by a hash of the id: approximate class shares, the same on every run, and no shuffle."""
    draw = F.conv(F.substring(shuffle_key(id, seed), 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))
    return df.withColumn("split", F.when(draw < test_size, "test").otherwise("train"))


def class_weights(df: DataFrame, label: str = "y") -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()  # over one row per class
    total, classes = F.sum("n").over(everything), F.count(F.lit(1)).over(everything)
    return counts.withColumn("weight", total.cast("double") / (classes * F.col("n")))


def with_class_weights(df: DataFrame, label: str = "y", weight: str = "weight") -> DataFrame:
    """Add the balanced class weight to every row."""
    per_class = class_weights(df, label).select(F.col(label).alias("_class"), F.col("weight").alias("_weight"))
    joined = df.join(per_class, F.col(label).eqNullSafe(F.col("_class")))
    return joined.select(*[c for c in df.columns if c != weight], F.col("_weight").alias(weight))


def positive_weight(df: DataFrame, label: str = "y") -> DataFrame:
    """Positive rate, and the weight that balances positives against negatives."""
    rate = df.agg(F.coalesce(F.avg((F.col(label) == 1).cast("int")), F.lit(0.0)).alias("positive_rate"))
    weight = (1 - F.col("positive_rate")) / F.greatest(F.col("positive_rate"), F.lit(1e-6))
    return rate.withColumn("positive_weight", weight)
