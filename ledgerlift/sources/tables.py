"""Parquet and CSV scans, and the normalised advances, labels and transactions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.functions import normalize as N

TEXT_COLUMNS = ("merchant_name", "primary_category", "detailed_category")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A CSV file with a header. Without a schema Spark reads the data once more to infer one."""
    reader = spark.read.option("header", True)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return file_system.exists(hadoop_path)


def presence_only(df: DataFrame, column: str) -> DataFrame:
    """The column as a text that only tells values from missing ones."""
    if column not in df.columns:
        return df
    value = N.known(F.col(column), df.schema[column].dataType)
    return df.withColumn(column, F.when(value.isNotNull(), "1"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, missing ones null, nothing de-duplicated."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_existing(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """Those parquet tables that exist; at least one must."""
    found = [p for p in paths if path_exists(spark, p)]
    if not found:
        raise FileNotFoundError(f"none of {len(paths)} paths exists")
    return [read_parquet(spark, p) for p in found]


def union_existing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The union of those parquet tables that exist; at least one must."""
    return union_all(read_existing(spark, paths))


def _user_ids(df: DataFrame, user_id_type: str | None) -> DataFrame:
    """User ids as numbers if all of them are, or as stated.

    Text takes a pass over the column to find out. Numbers do not, and a bigint column stays as it is,
    so that Spark still knows a table to be bucketed by it.
    """
    found = df.schema["user_id"].dataType
    wanted = user_id_type or ("bigint" if isinstance(found, T.IntegralType) else None)
    if wanted is None:
        return N.numeric_or_keep(df, ("user_id",))
    return df if found.simpleString() == wanted else df.withColumn("user_id", F.col("user_id").cast(wanted))


def _plain_ids(df: DataFrame, columns) -> DataFrame:
    """Ids as text, but whole numbers as they are."""
    return N.normalize_ids(df, [c for c in columns if c in df.columns and not isinstance(df.schema[c].dataType, T.IntegralType)])


def normalize_transactions(
    raw: DataFrame, date_formats: tuple[str, ...] = (), user_id_type: str | None = None
) -> DataFrame:
    """Ids as text or numbers, text as UTF-8, dates as timestamps, amounts as finite doubles.

    Amounts that are not numbers, or are infinite, count as 0. State ``user_id_type`` to save the
    pass that finds out whether all text user ids are numbers.
    """
    return _user_ids(_transaction_columns(_plain_ids(raw, ("user_id",)), date_formats), user_id_type)


def normalize_transaction_files(
    frames: list[DataFrame], date_formats: tuple[str, ...] = (), user_id_type: str | None = None
) -> DataFrame:
    """The union of raw files, each normalised by its own types first.

    The same id is then the same text whether a file has it as bytes, as a literal or as a number, junk
    amounts are 0 and junk dates null whatever another file holds. Only whether all user ids are numbers
    is asked of the whole.
    """
    plain = [_transaction_columns(_plain_ids(f, ("user_id",)), date_formats) for f in frames]
    if len({f.schema["user_id"].dataType for f in plain}) > 1:
        plain = [f.withColumn("user_id", F.col("user_id").cast("string")) for f in plain]
    return _user_ids(union_all(plain), user_id_type)


def _transaction_columns(raw: DataFrame, date_formats: tuple[str, ...]) -> DataFrame:
    df = N.normalize_ids(raw, ("id",))
    df = N.normalize_text(df, TEXT_COLUMNS)
    df = N.normalize_dates(df, ("date",), date_formats)
    value = N.amount(F.col("amount"), df.schema["amount"].dataType)
    return df.withColumn("amount", F.when(F.abs(value) < F.lit(float("inf")), value).otherwise(F.lit(0.0)))


def normalize_advances(
    raw: DataFrame, date_formats: tuple[str, ...] = (), user_id_type: str | None = None
) -> DataFrame:
    """Ids as text or numbers, the underwriting date as a timestamp."""
    df = _plain_ids(N.normalize_ids(raw, ("request_id",)), ("user_id",))
    df = N.normalize_dates(df, ("underwritten_at",), date_formats)
    return _user_ids(df, user_id_type)


def normalize_labels(raw: DataFrame) -> DataFrame:
    """Ids as text; NaN labels as missing ones."""
    df = N.normalize_ids(raw, ("advance_id",))
    return df.withColumns({f.name: N.known(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields})


def require_same_type(left: DataFrame, right: DataFrame, key: str) -> None:
    """Refuse to join keys of different types, which Spark would cast silently."""
    a, b = left.schema[key].dataType, right.schema[key].dataType
    if a != b:
        raise TypeError(f"{key} is {a.simpleString()} on one side and {b.simpleString()} on the other")
