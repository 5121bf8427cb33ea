"""Target detection and the supervised table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.functions.normalize import known, numeric_casts
from ledgerlift.sources.tables import require_same_type


def binary_flags(df: DataFrame) -> DataFrame:
    """One row: for each column, whether all its values that are not null or NaN are 0, 1, true or false.

    An all-null column counts as binary; text never does unless it is all null.
    """
    flags = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.NumericType):
            c = known(c, field.dataType)
            flag = F.coalesce(F.bool_and(F.when(c.isNotNull(), c.isin(0, 1))), F.lit(True))
        elif isinstance(field.dataType, T.BooleanType):
            flag = F.count(F.lit(1)) >= 0
        else:
            flag = F.count(c) == 0
        flags.append(flag.alias(field.name))
    return df.agg(*flags)


def binary_columns(df: DataFrame) -> DataFrame:
    """The same as one row per column: position, name, whether it is binary."""
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("column_name"), F.col(f"`{name}`").alias("is_binary"))
        for i, name in enumerate(df.columns)
    ]
    return binary_flags(df).select(F.inline(F.array(*entries)))


def target_column(labels: DataFrame) -> str:
    """The first binary column in schema order."""
    flags = binary_flags(labels).first()
    for name in labels.columns:
        if flags[name]:
            return name
    raise ValueError("no column with only 0 and 1")


def labelled_users(
    joined: DataFrame, target: str, keys: tuple[str, ...] = ("user_id",), drop_null_labels: bool = False
) -> DataFrame:
    """Distinct keys with their target; a user with two different labels keeps two rows.

    A null or NaN label counts as 0 unless ``drop_null_labels`` is set.
    """
    joined = joined.withColumn(target, known(F.col(target), joined.schema[target].dataType))
    named = joined.where(F.col("user_id").isNotNull())
    if drop_null_labels:
        named = named.where(F.col(target).isNotNull())
    pairs = named.select(*keys, target).distinct()
    return pairs.withColumn(target, F.coalesce(F.col(target).cast("int"), F.lit(0)))


def assemble(users: DataFrame, blocks: list[DataFrame]) -> DataFrame:
    """Left-join feature blocks on ``user_id`` and fill what is missing with 0."""
    for block in blocks:
        require_same_type(users, block, "user_id")
    joined = reduce(lambda a, b: a.join(b, "user_id", "left"), blocks, users)
    return joined.na.fill(0)


def numeric_matrix(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Numeric columns only, as doubles, with nulls, NaN and infinities turned into 0.

    Text columns are kept if every value is a number. Booleans, dates and other text are dropped.
    ``keep`` names columns to carry along unchanged.
    """
    features = [f for f in df.schema.fields if f.name not in keep]
    casts = numeric_casts(df, [f.name for f in features])
    columns = []
    for f in features:
        if not isinstance(f.dataType, T.NumericType) and f.name not in casts:
            continue
        value = F.col(f"`{f.name}`").cast("double")
        finite = F.abs(value) < F.lit(float("inf"))
        columns.append(F.coalesce(F.when(finite, value), F.lit(0.0)).alias(f.name))
    return df.select(*keep, *columns)
