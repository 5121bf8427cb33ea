import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ledgerlift.operators import importance
from ledgerlift.operators import model as M
from ledgerlift.operators import trees as T
from ledgerlift.operators.split import class_weights
from ledgerlift.plans import ranking
from ledgerlift.session import stage


@pytest.fixture(scope="module")
def supervised(spark):
    """A table where ``signal`` decides the label most of the time."""
    rng = random.Random(11)
    rows = []
    for i in range(400):
        signal, noise = rng.random(), rng.random()
        y = int(signal + rng.gauss(0, 0.1) > 0.6)
        rows.append((i, f"r{i}", y, signal * 10, noise, 5.0))
    schema = "user_id bigint, request_id string, target int, signal double, noise double, flat double"
    return stage(spark.createDataFrame(rows, schema), "model-test")


@pytest.fixture(scope="module")
def report(supervised):
    return ranking.train_and_rank(supervised, "target", M.SMALL, cv_folds=2)


def test_stack_finds_the_signal(report, supervised):
    assert report.auroc.first().auroc > 0.9
    assert all(r.auroc > 0.85 for r in report.folds.collect())
    assert report.scored.count() == 80
    assert all(0 <= r.p <= 1 for r in report.scored.collect())
    cutoffs = report.cutoffs.collect()
    assert cutoffs[0].precision >= cutoffs[-1].precision
    assert sum(r.n for r in report.bins.collect()) == 80
    assert [r.model for r in report.meta_weights.collect()] == list(M.LEARNERS)
    assert report.report.count() == 5 and report.precision.count() == 1


def test_scores_are_repeatable_and_keep_every_row(report, supervised):
    once = {r.user_id: r.p for r in report.model.score(supervised).collect()}
    again = {r.user_id: r.p for r in report.model.score(supervised.repartition(3)).collect()}
    assert len(once) == 400 and once == again


def test_native_and_split_importances(spark, report):
    model = report.model
    for name in ("rf", "gbt_depth"):
        rows = {r.feature: r.importance for r in importance.native_importance(spark, model.learners[name], model.features).collect()}
        assert sum(rows.values()) == pytest.approx(1.0) and max(rows, key=rows.get) == "signal" and rows["flat"] == 0
    splits = {r.feature: r for r in importance.split_importance(spark, model.learners["gbt_leaf"], model.features).collect()}
    trees = model.learners["gbt_leaf"].model.trees
    assert sum(r.splits for r in splits.values()) == sum(len(t[0]) // 2 for t in trees)
    assert splits["flat"].splits == 0 and splits["flat"].mean_gain == 0


def test_permutation_importance(report, supervised):
    model = report.model
    rows = ranking.with_row_id(supervised, "target")
    prepared = model.prepare(rows).select(F.col("row_id").alias("id"), F.col("target").alias("y"), "features")
    for name in ("svc", "rf"):
        got = importance.permutation_importance(model.learners[name], prepared, model.features, repeats=3)
        got = {r.feature: r.importance for r in got.collect()}
        assert set(got) == set(model.features)
        assert got["signal"] > 0.2 > abs(got["noise"]) and got["flat"] == 0
    by_chunks = importance.permutation_importance(model.learners["rf"], prepared, model.features, repeats=3, chunk=1)
    assert {r.feature: r.importance for r in by_chunks.collect()} == got


def test_permutation_against_brute_force(spark):
    """A learner that predicts x0 > 0.5, with the moves worked out by hand."""
    n, repeats, seed = 57, 4, 9
    rng = random.Random(2)
    data = [(i, rng.randrange(2), [rng.random(), rng.random()]) for i in range(n)]
    df = spark.createDataFrame(data, "id bigint, y int, x array<double>").select("id", "y", array_to_vector("x").alias("features"))

    rule = T.Tree()
    for side, value in zip(rule.split(0, 0, 0, 1.0), (0.0, 1.0)):
        rule.value[side] = value
    learner = M.Learner("rule", T.Ensemble(T.Recipe("rule", True, 1), 0.0, [rule.arrays()], [np.array([0.5])] * 2))
    got = {r.feature: r.importance for r in importance.permutation_importance(learner, df, ["a", "b"], repeats=repeats, seed=seed).collect()}
    import hashlib

    order = sorted(data, key=lambda r: (hashlib.md5(f"{r[0]}|{seed}".encode()).hexdigest(), r[0]))
    shifts = importance._shifts(n, 2 * repeats, seed)
    base = sum(int(x[0] > 0.5) == y for _, y, x in order) / n
    total = 0
    for a, b in shifts[:repeats]:
        values = [None] * n
        for place, (_, _, x) in enumerate(order):
            values[(a * place + b) % n] = x[0]
        assert sorted(values) == sorted(x[0] for _, _, x in order)
        total += sum(int(v > 0.5) == y for v, (_, y, _) in zip(values, order)) / n
    assert got["a"] == pytest.approx(base - total / repeats) and got["b"] == 0


def test_meta_weighted(spark):
    importances = spark.createDataFrame(
        [("rf", "a", 9.0), ("svc", "a", 1.0), ("svc", "b", 2.0), ("gbt", "b", 10.0), ("off", "a", 99.0)],
        "model string, feature string, importance double",
    )
    weights = spark.createDataFrame([("rf", 5.0), ("svc", -2.0), ("gbt", 0.5), ("off", 0.0)], "model string, weight double")
    got = importance.top_features(importance.meta_weighted(importances, weights), 5)
    assert [tuple(r) for r in got.collect()] == [("b", 9.0), ("a", 2.0)]


def test_meta_importance_plan(supervised):
    combined, per_model, weights = ranking.meta_importance(supervised, "target", M.SMALL, repeats=2, top_k=1)
    assert combined.first().feature == "signal"
    assert {r.model for r in per_model.select("model").distinct().collect()} == {"gbt_depth", "gbt_leaf", "svc"}
    assert weights.count() == 4


def test_single_model_importances(supervised):
    got = ranking.single_model_importances(supervised, "target", M.SMALL, repeats=2).collect()
    assert len(got) == 4 * 3
    for name in M.LEARNERS:
        best = max((r for r in got if r.model == name), key=lambda r: r.importance)
        assert best.feature == "signal"


def test_weights_agree_with_the_class_table(spark):
    df = spark.createDataFrame([(int(i < 3),) for i in range(10)], "y int")
    table = {r.y: r.weight for r in class_weights(df).collect()}
    assert {(r.y, r.w_balanced) for r in M.with_weights(df, "y").collect()} == set(table.items())
