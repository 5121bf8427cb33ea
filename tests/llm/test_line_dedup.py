"""Boilerplate lines against exact counts."""

import random

import pytest

from ledgerlift.llm.line_dedup import remove_boilerplate, without_boilerplate

SCHEMA = "doc_id bigint, text string, source string, n_chars bigint, line string, places int, `key` int"


def brute(rows, least):
    sites = {}
    for _, text, source, *_ in rows:
        for line in (text or "").split("\n"):
            if line.strip(" "):
                sites.setdefault(line.strip(" "), set()).add(source)
    bad = {x for x, s in sites.items() if len(s) >= least}
    return ["\n".join(x for x in (text or "").split("\n") if x.strip(" ") not in bad) for _, text, *_ in rows]


def rows_of(n, sites, seed):
    rnd = random.Random(seed)
    common = [f"line {i} é" for i in range(40)]
    rows = []
    for i in range(n):
        lines = [rnd.choice(common[: rnd.randrange(1, 41)]) if rnd.random() < 0.5 else f"own {i} {j}" for j in range(rnd.randrange(8))]
        lines += rnd.choice([[], [""], ["  "], [" line 0 é "], ["own x", ""]])
        rows.append((i, "\n".join(lines), f"s{rnd.randrange(sites)}", 7, "l", 1, 2))
    return rows


@pytest.mark.parametrize("n,sites,least", [(200, 20, 10), (60, 12, 3), (400, 60, 20)])
def test_against_exact_counts(spark, n, sites, least):
    rows = rows_of(n, sites, n)
    got = {r.row.doc_id: r for r in remove_boilerplate(spark.createDataFrame(rows, SCHEMA), least).collect()}
    want = brute(rows, least)
    assert [got[i].text for i in range(n)] == want
    assert any(got[i].n_removed for i in range(n))
    for i, r in got.items():
        assert r.n_lines == len((rows[i][1]).split("\n"))


def test_many_sites_near_and_far_from_the_threshold(spark):
    rows = [(i * 1000 + s, f"spread {i}\nown {i} {s}", f"site{s}", 0, "", 0, 0) for i in (300, 480, 495, 499, 500, 505, 530, 700) for s in range(i)]
    got = {r.row.doc_id: r.text for r in remove_boilerplate(spark.createDataFrame(rows, SCHEMA), 500).collect()}
    assert [got[r[0]] for r in rows] == brute(rows, 500)


def test_rows_it_must_take(spark):
    rows = [(None, None, None, None, None, None, None), (1, "", "a", 0, "", 0, 0), (2, "x\n" * 20000, "a", 0, "", 0, 0)]
    rows += [(3, "x\ny", None, 3, "", 0, 0), (3, "x\ny", None, 3, "", 0, 0), (3, "z", "b", 1, "", 0, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = without_boilerplate(df, 2)
    assert got.columns == df.columns
    assert sorted((r.doc_id or 0, len(r.text), r.n_chars) for r in got.collect()) == [(0, 0, 0), (1, 0, 0), (2, 0, 0), (3, 1, 1), (3, 1, 1), (3, 1, 1)]
    assert remove_boilerplate(spark.createDataFrame([], SCHEMA)).count() == 0
