"""Helpers the operators share: tables, staging and text columns."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.session import shared_dir, staging_path

__all__ = [
    "shared_dir", "stage", "staging_path", "table", "whole_text", "shuffle_width", "setting", "small_batches", "stage_at", "delete", "pressed",
    "unpressed", "in_parts",
]

#: Spark's setting to delete the shuffle files of a query when it ends, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session with another value of a setting."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def small_batches(spark: SparkSession, rows: int = 1000):
    """Arrow batches of ``rows`` at most: a batch is held by Spark and by Python, in each running task."""
    most = int(spark.conf.get(BATCH))
    return setting(spark, BATCH, str(min(most, rows) if most > 0 else rows))


def stage(df: DataFrame, name: str) -> DataFrame:
    """As the session's ``stage``, and the shuffle files behind the table go when it is written."""
    return stage_at(df, name)[0]


def stage_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``stage``, with the path, for a table that goes when its last reader has."""
    path = staging_path(df.sparkSession, name)
    with setting(df.sparkSession, CLEANUP, "true"):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def delete(spark: SparkSession, path: str) -> None:
    """Delete a staged table that has no readers left."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def pressed(rows: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``text`` as compressed bytes and its ``size``: an exchange of them takes half the room."""
    others = [f for f in rows.schema.fields if f.name != text]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in others], "size bigint", f"`{text}` binary"])

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b[text].cast(pa.binary())
            packed = pa.array([pa.compress(t.as_buffer(), "zstd", asbytes=True) for t in texts], pa.binary())
            size = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*[b[f.name] for f in others], size, packed], [*[f.name for f in others], "size", text])

    return rows.mapInArrow(press, schema)


def in_parts(batch: pa.RecordBatch, size: np.ndarray, at_once: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts whose rows have about ``at_once`` bytes together, by their sizes; a larger row is a part of its own."""
    if not batch.num_rows:
        return
    part = np.cumsum(size) // at_once
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def unpressed(text: bytes, size: int) -> bytes:
    """The UTF-8 bytes of a text that ``pressed`` has compressed."""
    return pa.decompress(text, size, "zstd", asbytes=True)
