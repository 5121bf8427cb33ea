import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerlift.operators import evaluate, profile, rank, scale, split

SCORED = "id bigint, y int, p double"


def scored_rows(n=3000, seed=3, tied=0.4):
    """Scores of which a large share are one and the same value."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        p = 0.5 if rng.random() < tied else rng.randrange(1000) / 999
        rows.append((i, int(rng.random() < p), p))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return scored_rows()


@pytest.fixture(scope="module")
def scored(spark, rows):
    return spark.createDataFrame(rows, SCORED).repartition(5)


def test_rank_and_running_sums_with_hot_ties(scored, rows):
    expected = sorted(rows, key=lambda r: (-r[2], r[0]))
    got = rank.cumulative_precision(scored).orderBy("rank").collect()
    assert [r.id for r in got] == [r[0] for r in expected]
    assert [r["rank"] for r in got] == list(range(1, len(rows) + 1))
    hits = 0
    for r, (_, y, _) in zip(got, expected):
        hits += y
        assert r.positives == hits and r.precision == hits / r["rank"]


def test_tied_scores_are_split_over_partitions(spark):
    df = spark.range(200_000).select(F.col("id"), F.lit(0.5).alias("p"))
    placed = df.repartitionByRange(8, F.col("p").desc(), F.col("id").asc())
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * 200_000 / 8


def test_rank_of_nothing(spark):
    assert rank.global_rank(spark.createDataFrame([], SCORED)).collect() == []


def test_precision_at_cutoffs(scored, rows):
    order = [y for _, y, _ in sorted(rows, key=lambda r: (-r[2], r[0]))]
    cutoffs = (0.05, 0.07, 0.29, 0.5, 1.0)
    got = evaluate.precision_at_cutoffs(scored, cutoffs).collect()
    for r, c in zip(got, cutoffs):
        k = max(1, math.ceil(c * len(order)))
        assert (r.cutoff_pct, r.k, r.precision) == (int(c * 100), k, sum(order[:k]) / k)


@pytest.mark.parametrize("n, cutoff, k", [(100, 0.07, 8), (3, 0.05, 1)])
def test_cutoff_sizes_use_doubles(spark, n, cutoff, k):
    df = spark.createDataFrame([(i, 1, i / n) for i in range(n)], SCORED)
    assert evaluate.precision_at_cutoffs(df, (cutoff,)).first().k == k


def test_bins(spark):
    df = spark.createDataFrame([(1, 1, 0.1), (2, 0, 0.3), (3, 1, 1.0), (4, 1, 0.0)], SCORED)
    got = {round(r.bin_lo, 1): r for r in evaluate.calibration(df).collect()}
    assert len(got) == 10 and sum(r.n for r in got.values()) == 4
    assert (got[0.1].n, got[0.1].precision, got[0.3].n, got[0.9].n) == (1, 1.0, 1, 1)
    assert (got[0.4].n, got[0.4].precision) == (0, None)
    assert got[0.4].center_pct == pytest.approx(45)


def brute_auroc(rows):
    pos = [p for _, y, p in rows if y == 1]
    neg = [p for _, y, p in rows if y == 0]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def test_auroc(spark, scored, rows):
    assert evaluate.auroc(scored).first().auroc == pytest.approx(brute_auroc(rows), abs=1e-12)
    flipped = scored.withColumn("p", -F.col("p"))
    assert evaluate.auroc(flipped).first().auroc == pytest.approx(1 - brute_auroc(rows), abs=1e-12)
    same = spark.createDataFrame([(i, i % 2, 0.4) for i in range(10)], SCORED)
    assert evaluate.auroc(same).first().auroc == 0.5
    one_class = spark.createDataFrame([(i, 1, i / 10) for i in range(10)], SCORED)
    assert evaluate.auroc(one_class).first().auroc is None


def test_auroc_per_group(scored, rows):
    got = evaluate.auroc(scored.withColumn("g", F.col("id") % 3), by=("g",)).collect()
    for r in got:
        assert r.auroc == pytest.approx(brute_auroc([x for x in rows if x[0] % 3 == r.g]), abs=1e-12)


def test_nothing_predicted_positive(spark):
    df = spark.createDataFrame([(1, 1, 0.1), (2, 0, 0.2)], SCORED)
    assert evaluate.precision_at_threshold(df).first().precision == 0
    report = {r["class"]: r for r in evaluate.class_report(df).collect()}
    assert (report["1"].precision, report["0"].recall, report["accuracy"].f1_score) == (0, 1.0, 0.5)
    assert report["weighted avg"].support == 2


def test_report_matches_counts(scored, rows):
    report = {r["class"]: r for r in evaluate.class_report(scored).collect()}
    hits = [(y, int(p >= 0.5)) for _, y, p in rows]
    tp, fp, fn = (hits.count(x) for x in ((1, 1), (0, 1), (1, 0)))
    one = report["1"]
    assert (one.precision, one.recall, one.support) == (tp / (tp + fp), tp / (tp + fn), tp + fn)
    assert one.f1_score == pytest.approx(2 * tp / (2 * tp + fp + fn))


def test_predictions(spark):
    df = spark.createDataFrame([(7, 70, 1, 0.5), (8, 80, 0, 0.49)], "user_id bigint, request_id bigint, y int, p double")
    assert [tuple(r) for r in evaluate.predictions(df).collect()] == [(7, 70, 1, 0.5, 1), (8, 80, 0, 0.49, 0)]
    assert evaluate.predictions(df.drop("y")).columns == ["user_id", "request_id", "y_pred", "y_pred_proba"]


# --- splits ---------------------------------------------------------------------------------


def test_split_is_exact_and_repeatable(scored, rows):
    first = {r.id: r.split for r in split.stratified_split(scored).collect()}
    again = {r.id: r.split for r in split.stratified_split(scored.repartition(2)).collect()}
    assert first == again and len(first) == len(rows)
    assert sum(s == "test" for s in first.values()) == math.ceil(0.2 * len(rows))
    for y in (0, 1):
        of_class = [first[i] for i, label, _ in rows if label == y]
        assert abs(of_class.count("test") - 0.2 * len(of_class)) <= 1
    other = {r.id: r.split for r in split.stratified_split(scored, seed=7).collect()}
    assert other != first


def test_folds_are_even(scored, rows):
    got = split.stratified_folds(scored, folds=5).collect()
    sizes = [sum(r.fold == k for r in got) for k in range(5)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    for y in (0, 1):
        sizes = [sum(r.fold == k and r.y == y for r in got) for k in range(5)]
        assert max(sizes) - min(sizes) <= 1


def test_approximate_split_keeps_every_row(scored, rows):
    got = split.sampled_split(scored).groupBy("split").count().collect()
    assert sum(r["count"] for r in got) == len(rows)
    first, again = (sorted(map(tuple, split.sampled_split(df).collect())) for df in (scored, scored.repartition(3)))
    assert first == again


def test_null_labels_and_many_classes(spark):
    df = spark.createDataFrame([(i, i % 3 if i % 3 else None, 0.0) for i in range(90)], "id int, y int, p double")
    got = split.stratified_split(df).groupBy("y", "split").count().collect()
    assert {(r.y, r.split): r["count"] for r in got} == {(y, s): n for y in (None, 1, 2) for s, n in (("train", 24), ("test", 6))}
    assert {r.y: r.weight for r in split.with_class_weights(df).select("y", "weight").distinct().collect()} == {None: 1.0, 1: 1.0, 2: 1.0}
    assert split.stratified_folds(df).count() == 90
    many = spark.range(3000).selectExpr("id", "id % 1500 as y", "0.0 as p")
    assert split.stratified_split(many, test_size=0.5).where("split = 'test'").count() == 1500
    assert split.with_class_weights(many).where("abs(weight - 1) > 1e-12").count() == 0


def test_nan_counts_as_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, 0.0, 1), (2, nan, 0), (3, -0.0, 1), (4, 5.0, 0), (5, None, 1)], "id int, p double, y int")
    assert [r.id for r in rank.global_rank(df).orderBy("rank").collect()][:3] == [4, 1, 3]
    hits = df.select("id", evaluate.predicted().alias("h")).collect()
    assert {r.id: r.h for r in hits} == {1: 0, 2: 0, 3: 0, 4: 1, 5: 0}
    assert {r.column_name: r.distinct_values for r in profile.distinct_counts(df, ["p", "id"]).collect()} == {"p": 2, "id": 5}
    assert {r.column_name: r.distinct_values for r in profile.distinct_counts(df.limit(0)).collect()} == {"id": 0, "p": 0, "y": 0}
    assert {r.column_name: r.distinct_values for r in profile.distinct_counts(df, ["p"], approximate=True).collect()} == {"p": 2}
    assert sum(r.n for r in profile.histogram(df, "p", 4).collect()) == 3
    assert [r.id for r in profile.outliers(df, "p").where("is_outlier").collect()] in ([], [4])
    assert profile.correlations(df, ["p", "id"]).first().r is not None


def test_weights(spark):
    df = spark.createDataFrame([(i, int(i < 2), 0.0) for i in range(8)], SCORED)
    weights = {r.y: r.weight for r in split.class_weights(df).collect()}
    assert weights == {1: 2.0, 0: 8 / 12}
    assert {(r.y, r.weight) for r in split.with_class_weights(df).collect()} == set(weights.items())
    assert split.positive_weight(df).first().positive_weight == 3.0


def test_scaling_leaves_constants_alone(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [tuple(r) for r in scale.scale_by_std(df, ["a", "b"]).collect()] == [(1.0, 5.0), (3.0, 5.0)]


# --- profiling ------------------------------------------------------------------------------


def test_quantiles_interpolate(spark):
    import numpy as np

    rng = random.Random(5)
    values = [(rng.choice([1.0, rng.random() * 9]), rng.random(), None) for _ in range(999)]
    df = spark.createDataFrame(values, "a double, b double, c double")
    got = {r.column_name: r for r in profile.describe(df, ["a", "b", "c"]).collect()}
    for i, name in enumerate("ab"):
        expected = np.percentile([v[i] for v in values], [25, 50, 75])
        assert [got[name].p25, got[name].p50, got[name].p75] == pytest.approx(list(expected))
        assert got[name].std == pytest.approx(np.std([v[i] for v in values], ddof=1))
    assert (got["c"].n, got["c"].p50) == (0, None)


def test_missing_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), None), (None, "y"), (0.0, "z")], "a double, b string")
    assert {r.column_name: r.null_fraction for r in profile.null_fraction(df).collect()} == {"a": 0.5, "b": 0.25}
    assert profile.sparsity(df).first().sparsity == 0.75
    assert {r.column_name: r.distinct_values for r in profile.distinct_counts(df, ["b"]).collect()} == {"b": 3}


def test_histogram_and_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 100]], "a double")
    got = {r.bucket: r.n for r in profile.histogram(df, "a", 10).collect()}
    assert got == {0: 5, **dict.fromkeys(range(1, 9), 0), 9: 1}
    assert [r.a for r in profile.outliers(df, "a").where("is_outlier").collect()] == [100.0]
    same = spark.createDataFrame([(5.0,), (5.0,)], "a double")
    assert sorted(r.n for r in profile.histogram(same, "a").collect()) == [0] * 19 + [2]
