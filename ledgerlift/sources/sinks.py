"""CSV sinks and materialised tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlift.sources.tables import path_exists


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, one file per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_series(df: DataFrame, index: str, value: str, path: str) -> None:
    """An indexed series as a two-column CSV."""
    write_csv(df.select(index, value), path)


def write_keys(df: DataFrame, key: str, path: str) -> None:
    """One key column as CSV."""
    write_csv(df.select(key), path)


def materialize(df: DataFrame, path: str, refresh: bool = True) -> DataFrame:
    """Write ``df`` as parquet and read it back.

    With ``refresh=False`` a table already there is reused, but only if its columns and types are
    those of ``df``; a table of another shape raises instead of being mixed in.
    """
    spark = df.sparkSession
    if refresh or not path_exists(spark, path):
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    found = spark.read.parquet(path)
    if [(f.name, f.dataType) for f in found.schema] != [(f.name, f.dataType) for f in df.schema]:
        raise ValueError(f"{path} holds another schema; pass refresh=True to rebuild it")
    return found


def input_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Path, size and time of every file under the paths; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return files.select("path", "length", "modificationTime")


def materialize_once(spark: SparkSession, path: str, inputs: list[str], build: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``, built only if it is not there or its input files have changed.

    The files it was built from are kept beside it, in ``path`` + ".inputs".
    """
    now, kept = input_files(spark, inputs), f"{path}.inputs"
    if path_exists(spark, path) and path_exists(spark, kept):
        before = spark.read.parquet(kept)
        if now.exceptAll(before).isEmpty() and before.exceptAll(now).isEmpty():
            return spark.read.parquet(path)
    out = materialize(build(), path)
    now.write.mode("overwrite").parquet(kept)
    return out
