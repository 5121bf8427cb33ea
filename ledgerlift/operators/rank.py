"""Global order: ranks and running totals over a whole table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType

from ledgerlift.functions.normalize import known
from ledgerlift.session import stage


def ordered_totals(
    df: DataFrame, order: list[Column], sums: dict[str, str] | None = None, rank: str = "rank"
) -> DataFrame:
    """Number all rows by ``order`` from 1, and add inclusive running sums.

    ``sums`` maps each new column to the column it adds up (whole numbers or doubles). ``order`` must be
    total for the numbers to be the same on every run; it also decides how the rows are split, so ties in a
    leading column (a score shared by a third of all rows) spread over partitions as long as later columns
    differ.

    The table is range-partitioned, sorted and staged once; that is the only exchange of its rows. Sums run
    along the sorted partitions as they are written. Every partition then only needs the totals of those
    before it, a table with one row per partition.
    """
    sums = sums or {}
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    local = {f"_run_{name}": (column, _sum_type(df, column)) for name, column in sums.items()}
    placed = placed.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_seq"))
    if sums:
        placed = placed.select("*", *[F.col(c).cast(kind).alias(name) for name, (c, kind) in local.items()])
        placed = placed.mapInArrow(_running(list(local)), placed.schema)
    placed = stage(placed, "ordered")

    totals = placed.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.max_by(name, "_seq").alias(name) for name in local]
    )
    # One row per partition, so this unpartitioned window and the broadcast stay tiny.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        *[F.coalesce(F.sum(f"_run_{name}").over(earlier), F.lit(0)).alias(f"_before_{name}") for name in sums],
    )
    out = placed.join(F.broadcast(offsets), "_part")
    place = F.col("_seq") - F.shiftleft(F.col("_part").cast("bigint"), 33) + 1 + F.col("_rows_before")
    return out.select(
        *[F.col(f"`{c}`") for c in df.columns],
        place.alias(rank),
        *[(F.col(f"_run_{name}") + F.col(f"_before_{name}")).alias(name) for name in sums],
    )


def _sum_type(df: DataFrame, column: str) -> str:
    return "double" if isinstance(df.schema[column].dataType, FractionalType) else "bigint"


def _running(names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Replaces columns by their running sums in a partition; nulls add nothing."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = dict.fromkeys(names, 0)
        for b in batches:
            columns = dict(zip(b.schema.names, b.columns, strict=True))
            for name in names:
                values = columns[name].fill_null(0).to_numpy()
                along = np.cumsum(np.r_[values.dtype.type(held[name]), values])
                columns[name] = pa.array(along[1:])
                held[name] = along[-1]
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return stream


def _known(df: DataFrame, column: str) -> Column:
    return known(F.col(column), df.schema[column].dataType)


def global_rank(scored: DataFrame, score: str = "p", id: str = "id") -> DataFrame:
    """Rank by score, best first, ties by id. Missing scores and NaN come last."""
    return ordered_totals(scored, [_known(scored, score).desc_nulls_last(), F.col(id).asc_nulls_last()])


def cumulative_precision(scored: DataFrame, label: str = "y", score: str = "p", id: str = "id") -> DataFrame:
    """Precision among the rows ranked so far, for every row."""
    ranked = ordered_totals(
        scored, [_known(scored, score).desc_nulls_last(), F.col(id).asc_nulls_last()], {"positives": label}
    )
    return ranked.withColumn("precision", F.col("positives").cast("double") / F.col("rank"))
