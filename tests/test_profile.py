"""Profiles against NumPy and plain counts."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlift.operators import profile, rank


def test_correlations_with_missing_values_and_offsets(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 12)) + 1e7
    x[:, 1] += x[:, 0] - 1e7
    x[:, 5] = 3.0
    x[rng.random(x.shape) < 0.2] = np.nan
    names = [f"c{j}" for j in range(12)]
    rows = [tuple(None if math.isnan(v) and rng.random() < 0.5 else float(v) for v in r) for r in x]
    got = profile.correlations(spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5), names).collect()
    assert len(got) == 66
    for r in got:
        a, b = x[:, names.index(r.a)], x[:, names.index(r.b)]
        both = ~np.isnan(a) & ~np.isnan(b)
        if "c5" in (r.a, r.b):
            assert r.r is None
        else:
            assert r.r == pytest.approx(np.corrcoef(a[both], b[both])[0, 1], abs=1e-6)


def test_many_columns_correlate(spark):
    wide = spark.range(50).select(*[((F.col("id") * (j + 3)) % 17).cast("double").alias(f"c{j}") for j in range(200)])
    assert profile.correlations(wide, wide.columns).count() == 200 * 199 // 2


@pytest.mark.parametrize("n", [0, 1, 2, 7, 5000])
def test_quantiles_are_exact(spark, n):
    rnd = random.Random(n)
    values = [rnd.choice([rnd.random(), 0.25, 3.0]) for _ in range(n)]
    rows = [(v, float(i % 3), None, float("nan")) for i, v in enumerate(values)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(4)
    probs = (0.0, 0.1, 0.5, 0.75, 1.0)
    got = {r[0]: tuple(r)[1:] for r in profile.exact_quantiles(df, ["a", "b", "c", "d"], probs).collect()}
    assert set(got) == ({"a", "b"} if n else set())
    if n:
        assert got["a"] == pytest.approx(np.quantile(values, probs))
        assert got["b"] == pytest.approx(np.quantile([i % 3 for i in range(n)], probs))


def test_distinct_counts_of_dense_and_sparse_numbers(spark):
    rows = [(i % 700 - 350, i * 10**12, i % 5, 2**63 - 1 - (i % 3), None) for i in range(4000)] + [(None,) * 5]
    df = spark.createDataFrame(rows, "dense bigint, sparse bigint, small int, top bigint, none int")
    got = {r.column_name: r.distinct_values for r in profile.distinct_counts(df).collect()}
    assert got == {"dense": 700, "sparse": 4000, "small": 5, "top": 3, "none": 0}
    assert set(profile._dense(df, df.columns)) == {0, 2, 3}


def test_distinct_counts_of_many_types_read_the_rows_once(spark):
    n = F.col("id")
    df = spark.range(2000).select(
        (n * 10**9 - 2**62).alias("sparse"),
        (n % 300 - 150).cast("int").alias("small"),
        F.when(n % 3 == 0, F.lit(float("nan"))).when(n % 3 == 1, F.lit(-0.0)).otherwise(0.0).alias("zero"),
        (n % 70).cast("double").alias("number"),
        F.when(n % 2 == 0, (n % 50).cast("string")).alias("text"),
        F.date_add(F.lit("2024-01-01").cast("date"), (n % 40).cast("int")).alias("day"),
        (n % 9).cast("decimal(20,2)").alias("money"),
        F.array(n % 4).alias("list"),
        (n % 2 == 0).alias("flag"),
    )
    want = {"sparse": 2000, "small": 300, "zero": 1, "number": 70, "text": 25, "day": 40, "money": 9, "list": 4, "flag": 2}
    for bitmaps in (False, True):
        assert {r.column_name: r.distinct_values for r in profile.distinct_counts(df, bitmaps=bitmaps).collect()} == want
    plan = profile.distinct_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 2000") == 1


def test_running_totals_exchange_the_rows_once(spark):
    rows = [(i, (i * 7919) % 101 / 101, i % 3, float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "id bigint, p double, y int, x double").repartition(6)
    got = rank.ordered_totals(df, [F.col("p").desc(), F.col("id").asc()], {"cum": "y", "along": "x"})
    plan = got._jdf.queryExecution().executedPlan().toString()
    # The rows are staged; what is exchanged after that has one row per partition.
    assert "hashpartitioning(_part" in plan and plan.count("SortMergeJoin") == 0
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    cum = along = 0
    found = {r.id: r for r in got.collect()}
    for place, (i, _, y, x) in enumerate(order, 1):
        cum, along = cum + y, along + x
        assert (found[i]["rank"], found[i]["cum"], found[i]["along"]) == (place, cum, pytest.approx(along))
