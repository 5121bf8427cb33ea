"""Top-k search against all inner products."""

import math
import random

import numpy as np
import pytest

from ledgerlift.llm.topk import Grid, candidates_of, exact_scores, scan, top_k

SCHEMA = "vec_id bigint, embedding array<double>, label int, score string"


def brute(rows, k, every):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in ok:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [32768, 40])
def test_against_all_pairs(spark, blocks):
    rnd = random.Random(blocks)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(rnd.choice([8, 8, 8, 5]))], 1, "x") for i in range(300)]
    rows += [(300 + i, [1.0] * 8, None, None) for i in range(60)]  # ties
    rows += [(1000, None, 1, "y"), (1050, [1.0, None], 1, ""), (1100, [math.nan] * 8, 1, ""), (1150, [math.inf], 1, ""), (None, [1.0], 1, ""), (2000, [], 1, "")]
    got = top_k(spark.createDataFrame(rows, SCHEMA), k=5, every=10, block_vectors=blocks, query_block=7)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 10)


def test_few_and_none(spark):
    assert top_k(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([(0, [1.0], 1, "")], SCHEMA)
    assert top_k(one).count() == 0
    rows = [(0, [1.0], 1, ""), (7, [-1.0], 1, ""), (7, [-1.0], 1, "")]
    assert [tuple(r) for r in top_k(spark.createDataFrame(rows, SCHEMA)).orderBy("rank").collect()] == [(0, 1, 7, -65536), (0, 2, 7, -65536)]


def test_a_third_alike_and_one_row_many_times(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(6)], 1, "x") for i in range(200)]
    rows += [(1000 + i, [2.0] * 6, 1, "x") for i in range(150)] + [(30, [2.0] * 6, 1, "x")] * 40
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted({tuple(r) for r in top_k(df, k=5, every=10, block_vectors=50).collect()})
    assert got == sorted(set(brute(rows, 5, 10)))
    held = candidates_of(df.selectExpr("xxhash64(embedding) AS name", "vec_id AS id", "embedding AS v"), 5)
    assert held.count() <= 200 + 5 + 6


def test_large_numbers_are_exact():
    v = np.array([[2.0**52, 3.0], [2.0**52, 4.0]])
    assert exact_scores(v, np.array([[2.0**52, 1.0]] * 2)) == [2**104 + 3, 2**104 + 4]


def test_bounds_hold_and_spare_reads():
    rng = np.random.default_rng(0)
    vectors, queries = np.floor(256 * rng.normal(size=(4000, 32))), np.floor(256 * rng.normal(size=(5, 32)))
    grid = Grid(vectors.min(axis=0), vectors.max(axis=0))
    cells = grid.cells(vectors)
    middle, slack = grid.bounds(cells, queries)
    assert (np.abs(middle - queries @ vectors.T) <= slack[:, None]).all()
    alone = np.ma.array(np.arange(4000), mask=False)
    left = {row: rows for row, rows, _, _ in scan(cells, alone, np.arange(5), queries, grid, 5)}
    for row, rows in left.items():
        scores = queries[row] @ vectors.T
        scores[row] = -np.inf
        assert set(np.argsort(-scores)[:5]) <= set(rows.tolist()) and row not in rows
    assert sum(map(len, left.values())) < 5 * 100
