"""Trees, kernel machine and logistic fits against plain ones."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ledgerlift.operators import model as M
from ledgerlift.operators import trees as T


def data(n=300, width=5, seed=0, parts=2):
    rng = np.random.default_rng(seed)
    x = np.round(rng.random((n, width)), 2)
    x[:, width - 1] = 3.0
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(0, 0.2, n) > 0.75).astype(int)
    use = np.ones((n, parts), bool)
    use[::5, 0] = False
    key = T.mixed(np.arange(n).astype(np.uint64), 5)
    edges = [np.unique(x[:, j])[:-1] for j in range(width)]
    return x, y, use, key, edges


def gradient_tree(x, y, use, recipe, weights, start):
    """Every split by trying all; depth-wise or best-first."""
    p = 1 / (1 + np.exp(-start))
    w = np.where(y == 1, weights[1], weights[0])
    g, h = w * (p - y), w * p * (1 - p)

    def quality(rows):
        return g[rows].sum() ** 2 / (h[rows].sum() + recipe.l2)

    def split(rows):
        best = None
        for j in range(x.shape[1]):
            for cut in np.unique(x[rows, j])[:-1]:
                left, right = rows[x[rows, j] <= cut], rows[x[rows, j] > cut]
                if min(len(left), len(right)) < recipe.min_rows or min(h[left].sum(), h[right].sum()) < recipe.min_hessian:
                    continue
                gain = quality(left) + quality(right) - quality(rows)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                    best = (gain, left, right)
        return best

    leaves = [(np.flatnonzero(use), 0)]
    found = {0: split(leaves[0][0])}
    while True:
        ready = [i for i in range(len(leaves)) if found[i] and (recipe.depth is None or leaves[i][1] < recipe.depth)]
        if not ready or (recipe.leaves and len(leaves) >= recipe.leaves):
            break
        i = max(ready, key=lambda i: found[i][0])
        _, left, right = found[i]
        depth = leaves[i][1] + 1
        leaves[i] = (left, depth)
        leaves.append((right, depth))
        found[i], found[len(leaves) - 1] = split(left), split(right)
    out = np.full(len(x), np.nan)
    for rows, _ in leaves:
        out[rows] = -recipe.rate * g[rows].sum() / (h[rows].sum() + recipe.l2)
    return out, len(leaves)


@pytest.mark.parametrize(
    "recipe",
    [
        T.Recipe("d", False, 1, 0.3, depth=3, l2=1.0, min_hessian=1.0, weight="positive"),
        T.Recipe("l", False, 1, 0.3, leaves=7, l2=1.0, min_rows=12, min_hessian=1e-3, from_average=True, weight="balanced"),
    ],
)
def test_first_tree_equals_trying_all_splits(recipe):
    x, y, use, key, edges = data()
    block = T.Block(x, y, use, key, edges)
    start, trees = T.alone(block, T.fit_ensemble(recipe, 0, x.shape[1]))
    n1, n = y[use[:, 0]].sum(), use[:, 0].sum()
    weights = (1.0, (n - n1) / n1) if recipe.weight == "positive" else (n / (2 * (n - n1)), n / (2 * n1))
    expected, leaves = gradient_tree(x, y, use[:, 0], recipe, weights, start)
    got = T.margin_of(block.bins, trees)
    assert np.allclose(got[use[:, 0]], expected[use[:, 0]])
    assert (trees[0][0] == T.LEAF).sum() == leaves


def test_forest_leaves_are_pure_or_small_and_balanced():
    x, y, use, key, edges = data(400)
    block = T.Block(x, y, use, key, edges)
    _, trees = T.alone(block, T.fit_ensemble(T.Recipe("f", True, 20, min_rows=2), 1, x.shape[1]))
    model = T.Ensemble(T.Recipe("f", True, 20, min_rows=2), 0.0, trees, edges)
    assert ((model.probability(x) > 0.5) == y).mean() > 0.9
    assert model.impurity().sum() == pytest.approx(1) and model.impurity()[-1] == 0
    drawn = np.searchsorted(T.POISSON, T.uniform(block.key, 42 * 1_000_003), "right")
    assert 0.9 < drawn.mean() < 1.1
    leaf = T.leaf_of(block.bins, trees[0])
    for node in np.unique(leaf[drawn > 0]):
        assert (leaf[drawn > 0] == node).sum() >= 2


def test_blocks_give_what_one_block_gives():
    x, y, use, key, edges = data(500)
    whole = T.Block(x, y, use, key, edges)
    halves = [T.Block(x[a::2], y[a::2], use[a::2], key[a::2], edges) for a in (0, 1)]

    def total(requests):
        return [r.merge(r.of(halves[0]), r.of(halves[1])) for r in requests]

    small = {"trees": 6, "rate": 0.3, "l2": 1.0}
    recipes = [
        T.Recipe("d", False, depth=4, rows=0.8, features=0.8, weight="positive", **small),
        T.Recipe("l", False, leaves=9, min_rows=5, from_average=True, weight="balanced", **small),
        T.Recipe("f", True, 5, min_rows=2),
    ]
    fits = {(r.name, p): T.fit_ensemble(r, p, x.shape[1], fit="x") for r in recipes for p in (0, 1)}
    fits |= {("svc", p): T.fit_kernel(p, 2.0, 60, 3, 50) for p in (0, 1)}
    found = T.together(total, fits)
    for r in recipes:
        for p in (0, 1):
            start, trees = T.alone(whole, T.fit_ensemble(r, p, x.shape[1]))
            assert start == pytest.approx(found[r.name, p][0])
            assert np.allclose(T.margin_of(whole.bins, trees), T.margin_of(whole.bins, found[r.name, p][1]))
    for p in (0, 1):
        alone = T.alone(whole, T.fit_kernel(p, 2.0, 60, 3, 50))
        assert alone.converged and np.allclose(alone.probability(x), found["svc", p].probability(x), atol=1e-6)


def test_landmarks_of_all_rows_are_the_exact_kernel():
    x, y, use, key, edges = data(200)
    machine = T.alone(T.Block(x, y, use, key, edges), T.fit_kernel(1, 2.0, 1000, 5, 100))
    scale, gamma, *_ = machine.map
    a = x / scale
    kernel = np.exp(-gamma * ((a[:, None] - a[None]) ** 2).sum(axis=2))
    sign = np.where(y == 1, 1.0, -1.0)
    cost = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    # Newton on the squared hinge in the coefficients of the kernel expansion.
    alpha, shift = np.zeros(len(y)), 0.0
    for _ in range(60):
        short = 1 - sign * (kernel @ alpha + shift)
        on = np.where(short > 0, cost, 0.0)
        lhs = np.block([[np.eye(len(y)) + 4 * on[:, None] * kernel, 4 * on[:, None]], [np.ones((1, len(y))), np.zeros((1, 1))]])
        solved = np.linalg.solve(lhs, np.r_[4 * on * sign, 0.0])
        alpha, shift = solved[:-1], solved[-1]
    assert np.abs(kernel @ alpha + shift - machine.margin(x)).max() < 1e-3
    moved = list(machine.predict_moved(x, np.array([0, 3]), np.stack([x[::-1, 0], x[::-1, 3]])))
    for column, got in zip((0, 3), moved, strict=True):
        changed = x.copy()
        changed[:, column] = x[::-1, column]
        assert (got == machine.predict(changed)).all()


def test_logistic_equals_spark_ml(spark):
    rng = np.random.default_rng(4)
    rows = [(int(g), float(a), float(b), float(a + b + rng.normal() > 0), float(rng.random() + 0.5)) for g, a, b in zip(rng.integers(0, 2, 400), rng.normal(size=400), rng.normal(size=400))]
    df = spark.createDataFrame(rows, "stack int, a double, b double, y double, w double")
    found = M.fit_logistic(df, ["a", "b"], "y", "w", "stack", 2)
    for k in (0, 1):
        own = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(df.where(F.col("stack") == k))
        total = own.agg(F.sum("w")).first()[0]
        other = LogisticRegression(featuresCol="v", labelCol="y", weightCol="w", regParam=1 / total, standardization=False, tol=1e-12, maxIter=500).fit(own)
        assert found[k].coefficients == pytest.approx(list(other.coefficients), abs=1e-5)
        assert found[k].intercept == pytest.approx(other.intercept, abs=1e-5)


def test_tasks_and_steps_give_the_same_models(spark):
    x, y, *_ = data(240, parts=1)
    rows = [(f"r{i}", int(y[i]), *map(float, x[i])) for i in range(len(y))]
    names = [f"f{j}" for j in range(x.shape[1])]
    df = spark.createDataFrame(rows, "id string, y int, " + ", ".join(f"{n} double" for n in names))
    sizes = M.Sizes(forest_trees=4, boost_rounds=4, boost_rate=0.3, boost_depth=3, boost_leaves=5, landmarks=40, svc_folds=2, folds=2, max_bins=40, leaf_min_rows=5, trees_a_task=2)
    in_tasks = M.fit_stack(df, names, "y", "id", sizes)
    by_steps = M.fit_stack(df, names, "y", "id", replace(sizes, rows_a_task=10, block_rows=100))
    a, b = ({r.id: r.p for r in m.score(df).collect()} for m in (in_tasks, by_steps))
    assert a == pytest.approx(b, abs=1e-6)
    assert in_tasks.weights() == pytest.approx(by_steps.weights(), abs=1e-4)


def test_near_counts_give_what_all_cells_give():
    x, y, use, key, edges = data(600)
    x = np.c_[x, x[:, 0]]  # a feature that comes twice
    edges = [*edges, edges[0]]
    bins = T.binned(x, edges).astype(np.uint8)
    block = T.Block(None, y, use, key, edges, bins)

    def by_cells(fit):
        answer = None
        while True:
            try:
                answer = fit.send(answer).of(block)
            except StopIteration as end:
                return end.value

    small = {"trees": 8, "rate": 0.3, "l2": 1.0}
    for recipe in (
        T.Recipe("f", True, 6, min_rows=2),
        T.Recipe("d", False, depth=5, min_hessian=1.0, rows=0.8, features=0.8, weight="positive", **small),
        T.Recipe("l", False, leaves=12, min_rows=5, from_average=True, weight="balanced", **small),
    ):
        _, near = T.alone(block, T.fit_ensemble(recipe, 0, x.shape[1]))
        _, cells = by_cells(T.fit_ensemble(recipe, 0, x.shape[1]))
        assert all((a == b).all() for s, t in zip(near, cells, strict=True) for a, b in zip(s, t, strict=True))


def test_kernel_machine_of_several_blocks():
    x, y, use, key, edges = data(300)
    blocks = [T.Block(x[a : a + 100], y[a : a + 100], use[a : a + 100], key[a : a + 100], edges) for a in (0, 100, 200)]
    whole, cut = (T.alone(b, T.fit_kernel(1, 2.0, 60, 3, 50)) for b in (T.Block(x, y, use, key, edges), blocks))
    assert np.allclose(whole.probability(x), cut.probability(x), atol=1e-6)


def test_forests_stay_in_staged_tables(spark, monkeypatch):
    """Fitting and scoring a stack brings no tree of a forest to the driver; rows meet the trees in buckets."""
    x, y, *_ = data(300, parts=1)
    names = [f"f{j}" for j in range(x.shape[1])]
    rows = [(f"r{i}", int(y[i]), *map(float, x[i])) for i in range(len(y))]
    df = spark.createDataFrame(rows, "id string, y int, " + ", ".join(f"{n} double" for n in names))
    sizes = M.Sizes(forest_trees=7, boost_rounds=2, boost_depth=2, boost_leaves=3, landmarks=20, svc_folds=2, folds=2, max_bins=300, leaf_min_rows=5, trees_a_task=3)
    monkeypatch.setattr(M, "SCORED_ROWS", 100)
    monkeypatch.setattr(M.Forest, "gathered", None)
    model = M.fit_stack(df, names, "y", "id", sizes)
    forest = model.learners["rf"].model
    assert isinstance(forest, M.Forest) and (forest.numbers, forest.trees) == (3, 7)
    scored = {r.id: (r.p, r.k) for r in model.learners["rf"].add_prediction(model.learners["rf"].add_score(model.prepare(df), "p"), "k").collect()}
    monkeypatch.undo()
    ensemble = forest.gathered(M.recipes(sizes)["rf"])
    assert len(ensemble.trees) == 7 and len(scored) == 300
    for i, p in enumerate(ensemble.probability(x)):
        assert scored[f"r{i}"] == (pytest.approx(p), int(p >= 0.5))


def test_histograms_count_the_smaller_sides_only(monkeypatch):
    """Trees of many rows are those of few rows; of two siblings one is counted, the other is what is left of the parent."""
    rng = np.random.default_rng(3)
    n = 3000
    x = np.c_[rng.normal(size=(n, 3)), rng.integers(0, 4, (n, 3))]
    y = (x[:, 0] + 0.3 * x[:, 3] + rng.normal(size=n) > 0.5).astype(int)
    edges = [np.unique(np.quantile(x[:, j], np.arange(1, 60) / 60, method="lower")) for j in range(6)]
    key, use = T.mixed(np.arange(n).astype(np.uint64), 5), np.ones((n, 1), bool)
    counted = []
    plain = T.counts
    monkeypatch.setattr(T, "counts", lambda column, rows, *more: counted.append(len(rows)) or plain(column, rows, *more))
    monkeypatch.setattr(T, "BUNDLE", 100)
    small = {"trees": 5, "rate": 0.3, "l2": 1.0}
    for recipe in (
        T.Recipe("d", False, depth=4, min_hessian=1.0, rows=0.8, features=0.8, weight="positive", **small),
        T.Recipe("l", False, leaves=9, min_rows=20, min_hessian=1e-3, from_average=True, weight="balanced", **small),
    ):
        block = T.Block(None, y, use, key, edges, T.binned(x, edges).astype(np.uint8))
        _, expected = T.alone(block, T.fit_ensemble(recipe, 0, 6))
        counted.clear()
        monkeypatch.setattr(T, "MANY", 1)
        block = T.Block(None, y, use, key, edges, block.bins)
        _, trees = T.alone(block, T.fit_ensemble(recipe, 0, 6))
        monkeypatch.setattr(T, "MANY", n + 1)
        for a, b in zip(trees, expected, strict=True):
            assert all((a[i] == b[i]).all() for i in range(4)) and np.allclose(a[4], b[4]) and np.allclose(a[5], b[5])
        # A level has at most half of the rows in its smaller sides; three features of four values are one column.
        depth = recipe.depth or 9
        assert any(c < n / 2 for c in counted) and sum(counted) <= 5 * 6 * n * (1 + (depth - 1) / 2)
        assert [(features, widths) for features, widths, _ in block.bundles] == [([3, 4, 5], [4, 4, 4])]


@pytest.mark.parametrize("dense", [1, 10**9])
def test_forest_trees_at_once_are_those_of_single_requests(monkeypatch, dense):
    """Whether levels are counted in arrays or sorted, and however many bins there are."""
    monkeypatch.setattr(T, "DENSE", dense)
    rng = np.random.default_rng(8)
    n = 900
    x = np.c_[np.round(rng.random((n, 8)), 1), rng.normal(size=(n, 2))]
    y = (x[:, 0] + x[:, 8] + rng.normal(size=n) > 0.5).astype(int)
    key, use = T.mixed(np.arange(n).astype(np.uint64), 5), np.ones((n, 1), bool)
    for cuts in (50, 400):
        edges = [np.unique(np.quantile(x[:, j], np.arange(1, cuts) / cuts, method="lower")) for j in range(10)]
        block = T.Block(x, y, use, key, edges)
        for recipe in (T.Recipe("f", True, 3, min_rows=2), T.Recipe("g", True, 2, min_rows=5, depth=4)):
            answer, fit = None, T.fit_ensemble(recipe, 0, 10)
            while True:
                try:
                    answer = fit.send(answer).of(block)
                except StopIteration as end:
                    _, expected = end.value
                    break
            _, trees = T.alone(block, T.fit_ensemble(recipe, 0, 10))
            assert all((a == b).all() for s, t in zip(trees, expected, strict=True) for a, b in zip(s, t, strict=True))
            for tree in trees:
                assert (T.leaves_of(np.ascontiguousarray(block.bins.T), tree) == T.leaf_of(block.bins, tree)).all()


def test_a_forest_of_no_rows_is_leaves():
    block = T.Block(np.zeros((0, 2)), np.zeros(0), np.zeros((0, 1), bool), np.zeros(0, np.uint64), [np.array([0.5])] * 2)
    _, trees = T.alone(block, T.fit_ensemble(T.Recipe("f", True, 2), 0, 2))
    assert [len(t[0]) for t in trees] == [1, 1]


def test_hinge_sums_are_those_of_each_fold_by_itself(monkeypatch):
    x, y, use, key, edges = data(300)
    marks = x[:20] / 2.0
    root = np.linalg.qr(np.random.default_rng(1).normal(size=(20, 20)))[0][:, :12]
    block, scale, gamma = T.Block(x, y, use, key, edges), np.full(5, 2.0), 0.7
    rng = np.random.default_rng(2)
    weights = tuple((k, rng.normal(size=13)) for k in (0, 1, 2, -1))
    summed = []
    plain = T.squares
    monkeypatch.setattr(T, "squares", lambda z, which: summed.append(int(which.sum())) or plain(z, which))
    got = T.Hinge(0, (scale, gamma, marks, root), (1.5, 0.5), weights, 3).of(block)
    rows = use[:, 0]
    a = x[rows] / scale
    z = np.c_[np.exp(-gamma * ((a[:, None] - marks) ** 2).sum(axis=2)) @ root, np.ones(rows.sum())]
    sign, cost = np.where(y[rows] == 1, 1.0, -1.0), np.where(y[rows] == 1, 0.5, 1.5)
    fold = (T.mixed(block.key[rows], 78) % np.uint64(3)).astype(int)
    for (k, w), found in zip(weights, got, strict=True):
        short = 1 - sign * (z @ w)
        on = (short > 0) & (fold != k)
        zc = z[on] * cost[on, None]
        assert np.allclose(found, np.c_[zc.T @ z[on], -(zc * (sign * short)[on, None]).sum(axis=0)])
    assert sum(summed[:3]) <= rows.sum()  # each row once for all weight vectors; the rest puts right


def test_margins_out_of_fold_are_made_once(monkeypatch):
    x, y, use, key, edges = data(300)
    calls = []
    plain = T.kernel_rows
    monkeypatch.setattr(T, "kernel_rows", lambda *a: calls.append(1) or plain(*a))
    steps = []
    of = T.Platt.of
    monkeypatch.setattr(T.Platt, "of", lambda self, block: steps.append(len(calls)) or of(self, block))
    T.alone(T.Block(x, y, use, key, edges), T.fit_kernel(1, 2.0, 40, 3, 50))
    assert len(steps) > 2 and len(calls) == steps[0] + 1
