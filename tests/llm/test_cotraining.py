"""Co-training: held-out accuracy, what the exchange teaches, and rows it must take."""

import random

import numpy as np
import pytest

from ledgerlift.llm.cotraining import LEAST_CURVATURE, CoTraining, Features, featured, fit, good_documents, uniform, with_quality

SCHEMA = "doc_id bigint, text string, lang string, source string, p double, keep int, `row` string"
LABELS = "doc_id bigint, quality int, toxic int"


def corpus(n, seed=0):
    rnd = random.Random(seed)
    words = [f"word{i}" for i in range(200)]
    rows, truth = [], {}
    for i in range(n):
        good = rnd.random() < 0.8
        text = [rnd.choice(words) for _ in range(rnd.randrange(20, 80))]
        if not good:
            text = [w + rnd.choice(["$$$", "!!", "###"]) for w in text] if i % 2 else [text[0]] * len(text)
        rows.append((i, " ".join(text), "en", f"site{rnd.randrange(5) + (5 if not good and rnd.random() < 0.9 else 0)}", 0.0, 1, "x"))
        truth[i] = int(good)
    return rows, truth


def test_held_out_accuracy(spark):
    rows, truth = corpus(900)
    labels = [(i, truth[i], 0) for i in range(0, 900, 3)]
    got = with_quality(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == 900 and all(0 <= r.p <= 1 for r in got)
    right = [r.keep == bool(truth[r.row.doc_id]) for r in got if r.row.doc_id % 3]
    assert sum(right) / len(right) > 0.97


def test_accuracy_on_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    fitted_on = labels.where("doc_id % 3 <> 0")
    held = {r.doc_id: r.quality for r in labels.where("doc_id % 3 = 0").collect()}
    got = {r.row.doc_id: r.keep for r in with_quality(docs, fitted_on).collect() if r.row.doc_id in held}
    assert sum(got[i] == bool(q) for i, q in held.items()) / len(held) > 0.93


def test_labelled_rows_are_bounded_and_all_others_teach(spark):
    rows, truth = corpus(600)
    df, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(i, q, 0) for i, q in truth.items()], LABELS)
    labelled, others, _ = featured(df, labels, CoTraining(labelled=50))
    assert 20 < labelled.count() <= 50 and labelled.count() + others.count() == 600
    model = fit(df, labels, CoTraining(labelled=200))
    assert model.text is not None and max(model.weights[:2]) > 0


def newton(x, y, penalty):
    w = np.zeros(x.shape[1])
    ridge = np.r_[np.full(len(w) - 1, penalty * len(y)), 1e-9]
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
        w = w - step
    return w


def test_equals_co_training_in_numpy(spark):
    rows, truth = corpus(500, seed=4)
    labels = [(i, truth[i], 0) for i in range(0, 500, 2)]
    how = CoTraining(penalty=1e-2)
    df = spark.createDataFrame(rows, SCHEMA)
    got = with_quality(df.repartition(3), spark.createDataFrame(labels, LABELS), how).collect()
    ids = spark.createDataFrame([(r[0],) for r in rows], "doc_id bigint")
    held = {r.doc_id for r in ids.where(uniform("doc_id", 3) < how.held_out).collect()}
    made = Features()
    both = [made.both(text, source, lang) for _, text, lang, source, *_ in rows]
    views = [np.c_[np.array([b[v] for b in both], np.float32).astype(float), np.ones(len(rows))] for v in (0, 1)]
    known = np.array([r[0] % 2 == 0 and r[0] not in held for r in rows])
    pool = np.array([r[0] % 2 == 1 for r in rows])
    y = np.array([float(truth[r[0]]) for r in rows])
    w = [newton(x[known], y[known], how.penalty) for x in views]
    edge = np.log(how.sure / (1 - how.sure))
    for _ in range(how.rounds):
        odds, new = [x @ v for x, v in zip(views, w)], []
        for k in (0, 1):
            other = odds[1 - k]
            use = known | (pool & (np.abs(other) > edge))
            label = np.where(known, y, other > 0)[use]
            x = views[k][use]
            p = 1 / (1 + np.exp(-x @ w[k]))
            ridge = np.r_[np.full(x.shape[1] - 1, how.penalty * use.sum()), 1e-9]
            h = (x * np.maximum(p * (1 - p), LEAST_CURVATURE)[:, None]).T @ x + np.diag(ridge)
            new.append(w[k] - np.linalg.solve(h, x.T @ (p - label) + ridge * w[k]))
        w = new
    judged = np.array([r[0] % 2 == 0 and r[0] in held for r in rows])
    sides = []
    for x, v in zip(views, w):
        line = newton(np.c_[(x @ v)[judged], np.ones(judged.sum())], y[judged], how.penalty)
        sides.append(max(0.0, line[0]) * (x @ v) + line[1])
    a, b, c = newton(np.c_[sides[0][judged], sides[1][judged], np.ones(judged.sum())], y[judged], how.penalty)
    p = 1 / (1 + np.exp(-(max(0, a) * sides[0] + max(0, b) * sides[1] + c)))
    found = {r.row.doc_id: r.p for r in got}
    assert np.abs(np.array([found[r[0]] for r in rows]) - p).max() < 1e-3


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(1, None, 0), (2, 7, 0), (3, 1, 0), (3, 0, 0)]])
def test_without_both_classes_all_stay(spark, labels):
    rows, _ = corpus(20)
    df = spark.createDataFrame(rows, SCHEMA)
    got = good_documents(df, spark.createDataFrame(labels, LABELS))
    assert got.schema == df.schema and got.count() == 20


def test_rows_it_must_take(spark):
    rows, truth = corpus(200)
    rows += [(None, None, None, None, None, None, None), (500, "", "en", "s", 0.0, 1, ""), (501, "long " * 50000, "en", "s", 0.0, 1, ""), (502, "dup", "en", "s", 0.0, 1, ""), (502, "dup", "en", "s", 0.0, 1, "")]
    labels = spark.createDataFrame([(i, q, 0) for i, q in truth.items()] + [(None, 1, 0)], LABELS)
    assert with_quality(spark.createDataFrame(rows, SCHEMA), labels).count() == 205
    assert with_quality(spark.createDataFrame([], SCHEMA), labels).count() == 0


def test_features_of_odd_texts():
    f = Features()
    a, b = f.both("", None, None)
    assert not a.any() and b.sum() > 0
    f.both("😀 É 9 \ud800", "s", "en")
