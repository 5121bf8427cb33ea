"""Table profiling. Each report is one aggregate over all columns, unpivoted afterwards."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.operators.rank import ordered_totals

QUARTILES = (0.25, 0.5, 0.75)


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _long(wide: DataFrame, names: list[str], columns: dict[str, str]) -> DataFrame:
    """One row per profiled column from one wide row; ``columns`` maps output name to name prefix."""
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            *[F.col(f"`{prefix}{i}`").alias(out) for out, prefix in columns.items()],
        )
        for i, name in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*entries)))


def _missing(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return _c(name).isNull() | F.isnan(_c(name))
    return _c(name).isNull()


def _stacked(df: DataFrame, names: list[str], type_: str) -> DataFrame:
    """All values of some columns as rows of ``(i, value)``, with the column's number for its name."""
    renamed = df.select(*[_c(c).cast(type_).alias(str(i)) for i, c in enumerate(names)])
    rows = renamed.unpivot([], renamed.columns, "i", "value")
    return rows.select(F.col("i").cast("int").alias("i"), "value")


def _named(df: DataFrame, names: list[str]) -> DataFrame:
    """Replace the column number ``i`` by the column's name."""
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("i") + 1)
    return df.select(name.alias("column_name"), *[c for c in df.columns if c != "i"])


def numeric_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def null_fraction(df: DataFrame) -> DataFrame:
    """Share of missing values per column."""
    wide = df.agg(*[F.avg(_missing(df, c).cast("int")).alias(f"f{i}") for i, c in enumerate(df.columns)])
    return _long(wide, df.columns, {"null_fraction": "f"})


def shape(df: DataFrame) -> DataFrame:
    """Rows, columns and cells."""
    width = len(df.columns)
    rows = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.select("n_rows", F.lit(width).alias("n_columns"), (F.col("n_rows") * width).alias("n_cells"))


def schema_listing(df: DataFrame) -> DataFrame:
    """Column names and types in order."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, type string")


def distinct_counts(
    df: DataFrame, columns: list[str] | None = None, approximate: bool = False, bitmaps: bool = False
) -> DataFrame:
    """Distinct values per column, null and NaN aside; 0 where there are none.

    Exact counts go through one row per distinct (column, value), so no task holds a whole column; whole
    numbers go as one row per 64 values in line that occur, with a bit for each. All columns are counted in
    one pass over ``df``, which may be a view of joins. With ``bitmaps`` whole numbers that lie densely go
    through larger bitmaps, of which a task sends one per run of values, for two more passes over them: for
    tables that are cheap to read again. ``approximate`` uses sketches and needs no shuffle of values.
    """
    names = columns or df.columns
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(F.when(~_missing(df, c), _c(c))).alias(f"d{i}") for i, c in enumerate(names)])
        return _long(wide, names, {"distinct_values": "d"})
    dense = _dense(df, names) if bitmaps else {}
    counted = [_bitmap_counts(df, names, dense)] if dense else []
    if len(dense) < len(names):
        counted.append(_value_counts(df, names, [i for i in range(len(names)) if i not in dense]))
    found = reduce(DataFrame.unionByName, counted)
    every = df.sparkSession.range(len(names)).select(F.col("id").cast("int").alias("i"))
    out = every.join(F.broadcast(found), "i", "left")  # one row per column
    return _named(out.select("i", F.coalesce("distinct_values", F.lit(0)).alias("distinct_values")), names)


def _value_counts(df: DataFrame, names: list[str], places: list[int]) -> DataFrame:
    """Distinct values of the columns at some places, ``i`` and ``distinct_values``, in one pass.

    Each type has a column of its own in the stack, so values compare as what they are: 0.0 and -0.0 are one
    value, and NaN is missing. Types without an order of their own in a stack (arrays, structs) are compared
    as text.
    """

    def whole(i: int) -> bool:
        return isinstance(df.schema[names[i]].dataType, T.IntegralType)

    def kind(i: int) -> str:
        found = df.schema[names[i]].dataType
        return "bigint" if whole(i) else found.simpleString() if isinstance(found, T.AtomicType) else "string"

    kinds = list(dict.fromkeys(map(kind, places)))
    entries = []
    for i in places:
        value = F.when(~_missing(df, names[i]), _c(names[i])).cast(kind(i))
        bit = F.when(value.isNotNull(), F.lit(1).cast("bigint"))
        if whole(i):
            value, bit = F.shiftright(value, 6), F.call_function("shiftleft", bit, value.bitwiseAND(F.lit(63)).cast("int"))
        own = [(value if k == kind(i) else F.lit(None).cast(k)).alias(f"v{n}") for n, k in enumerate(kinds)]
        entries.append(F.struct(F.lit(i).alias("i"), *own, bit.alias("bits")))
    rows = df.select(F.inline(F.array(*entries))).where("bits is not null")
    held = rows.groupBy("i", *[f"v{n}" for n in range(len(kinds))]).agg(F.bit_or("bits").alias("bits"))
    return held.groupBy("i").agg(F.sum(F.bit_count("bits")).cast("bigint").alias("distinct_values"))


#: Values of the range of a column per row up to which its bitmaps are smaller than its values.
DENSE = 32


def _dense(df: DataFrame, names: list[str]) -> dict[int, int]:
    """Of the columns of whole numbers those whose values lie densely, with their smallest values."""
    whole = [i for i, n in enumerate(names) if isinstance(df.schema[n].dataType, T.IntegralType)]
    if not whole:
        return {}
    row = df.agg(
        *[f(_c(names[i])).cast("decimal(20,0)").alias(f"{a}{i}") for i in whole for a, f in (("low", F.min), ("high", F.max))],
        *[F.count(_c(names[i])).alias(f"n{i}") for i in whole],
    ).first()
    out = {}
    for i in whole:
        low, high, n = (row[f"{a}{i}"] for a in ("low", "high", "n"))
        if n and high - low < min(DENSE * n, 2**62) and -(2**62) < low:
            out[i] = int(low)
    return out


def _bitmap_counts(df: DataFrame, names: list[str], dense: dict[int, int]) -> DataFrame:
    """Distinct values of dense columns: a bitmap per column and run of values, merged before and after it moves."""
    entries = [F.struct(F.lit(i).alias("i"), (_c(names[i]).cast("bigint") - F.lit(low) + 1).alias("v")) for i, low in dense.items()]
    rows = df.select(F.inline(F.array(*entries))).where("v is not null")
    maps = rows.groupBy("i", F.bitmap_bucket_number("v").alias("run")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("bits"))
    return maps.groupBy("i").agg(F.sum(F.bitmap_count("bits")).alias("distinct_values"))


def exact_quantiles(df: DataFrame, columns: list[str], probs=QUARTILES) -> DataFrame:
    """Quantiles with linear interpolation: columns ``column_name, q0, q1, ...``.

    Values are counted, then ordered once for all columns together; a quantile is the first value
    whose running count reaches its place. No task ever holds a whole column.
    """
    values = _stacked(df, columns, "double").where(F.col("value").isNotNull() & ~F.isnan("value"))
    counted = values.groupBy("i", "value").agg(F.count(F.lit(1)).alias("n"))
    running = ordered_totals(counted, [F.col("i").asc(), F.col("value").asc()], {"cum": "n"}, rank="_rank")
    extents = running.groupBy("i").agg(F.sum("n").alias("total"), F.min(F.col("cum") - F.col("n")).alias("start"))
    placed = running.join(F.broadcast(extents), "i")  # one row per column
    aggregates = []
    for k, p in enumerate(probs):
        place = F.lit(float(p)) * (F.col("total") - 1)
        reached = F.col("cum") - F.col("start")
        low = F.min(F.when(reached >= F.floor(place) + 1, F.col("value")))
        high = F.min(F.when(reached >= F.ceil(place) + 1, F.col("value")))
        part = F.first(place - F.floor(place))
        aggregates.append((low + (high - low) * part).alias(f"q{k}"))
    return _named(placed.groupBy("i").agg(*aggregates), columns)


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, exact quartiles and maximum per column."""
    names = columns or numeric_names(df)
    moments = []
    for i, name in enumerate(names):
        value = F.when(~_missing(df, name), _c(name).cast("double"))
        moments += [
            F.count(value).alias(f"count{i}"),
            F.avg(value).alias(f"mean{i}"),
            F.stddev_samp(value).alias(f"std{i}"),
            F.min(value).alias(f"min{i}"),
            F.max(value).alias(f"max{i}"),
        ]
    per_column = _long(df.agg(*moments), names, {"n": "count", "mean": "mean", "std": "std", "min": "min", "max": "max"})
    quartiles = exact_quantiles(df, names)
    joined = per_column.join(F.broadcast(quartiles), "column_name", "left")
    return joined.select(
        "column_name", "n", "mean", "std", "min",
        F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"), "max",
    )


def histogram(df: DataFrame, column: str, buckets: int = 20) -> DataFrame:
    """Rows per equal-width bucket between the minimum and the maximum, empty ones included. NaN is missing."""
    value = F.when(~_missing(df, column), _c(column).cast("double"))
    low, high = df.agg(F.min(value), F.max(value)).first()
    if low is None:
        return df.select(F.lit(0).alias("bucket"), value.alias("low"), value.alias("high"), F.lit(0).cast("bigint").alias("n")).where(F.lit(False))
    width = (high - low) / buckets or 1.0
    bucket = F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(buckets - 1)).cast("int")
    counts = df.where(value.isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    counts = every.join(F.broadcast(counts), "bucket", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    edge = F.lit(low) + F.col("bucket") * F.lit(width)
    return counts.select("bucket", edge.alias("low"), (edge + F.lit(width)).alias("high"), "n")


def outliers(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Every row with ``is_outlier``: outside the quartiles by more than ``factor`` times their range."""
    found = exact_quantiles(df, [column], (0.25, 0.75)).first()
    if found is None:
        return df.withColumn("is_outlier", F.lit(False))
    low, high = found["q0"], found["q1"]
    reach = factor * (high - low)
    value = _c(column).cast("double")
    flag = (value < F.lit(low - reach)) | (value > F.lit(high + reach))
    return df.withColumn("is_outlier", F.coalesce(flag & ~_missing(df, column), F.lit(False)))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, over rows where both are known; null where one does not vary.

    Every task makes the products of whole blocks of rows at once, with masks for what is missing, and
    keeps one set of sums per pair; the sums of the tasks are added up. Values are taken from the
    columns' means, so that large offsets do not cancel.
    """
    values = [F.when(~_missing(df, c), _c(c).cast("double")) for c in columns]
    means = df.agg(*[F.avg(v) for v in values]).first()
    middle = np.array([m or 0.0 for m in means])
    width = len(columns)
    rows = df.select(F.array(*values).alias("x"))
    sums = ("n", "sx", "sy", "sxx", "syy", "sxy")

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((6, width, width))
        for b in batches:
            x = b["x"].flatten()
            known = ~x.is_null().to_numpy(zero_copy_only=False).reshape(-1, width)
            x = np.where(known, x.fill_null(0.0).to_numpy().reshape(-1, width) - middle, 0.0)
            m = known.astype(float)
            held += np.stack([m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x])
        i, j = np.triu_indices(width, 1)
        arrays = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(h[i, j]) for h in held]]
        yield pa.RecordBatch.from_arrays(arrays, ["i", "j", *sums])

    parts = rows.mapInArrow(products, "i int, j int, " + ", ".join(f"{c} double" for c in sums))
    total = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in sums])
    n, sx, sy, sxx, syy, sxy = map(F.col, sums)
    spread = (sxx - sx * sx / n) * (syy - sy * sy / n)
    r = F.when((n > 1) & (spread > 0), (sxy - sx * sy / n) / F.sqrt(spread))
    names = F.array(*[F.lit(c) for c in columns])
    return total.select(F.get(names, "i").alias("a"), F.get(names, "j").alias("b"), r.alias("r"))


def target_balance(df: DataFrame, label: str = "y", by: tuple = ()) -> DataFrame:
    """Rows per class, optionally within each split."""
    return df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))


def sparsity(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Share of values per column that are zero or missing."""
    names = columns or numeric_names(df)
    empty = [F.avg((_missing(df, c) | (_c(c) == 0)).cast("int")).alias(f"s{i}") for i, c in enumerate(names)]
    return _long(df.agg(*empty), names, {"sparsity": "s"})
