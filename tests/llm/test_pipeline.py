"""The corpus pipeline: each stage against brute force on its own input."""

import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from ledgerlift.llm.common import stage
from ledgerlift.llm.parity_join import representatives

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, step in corpus_pipeline.STAGES:
        made = stage(step(spark, docs, SF), name)
        out.append((docs, made))
        docs = made
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    columns = stages[0][0].columns
    assert all(made.columns == columns for _, made in stages[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "mixing", "packing"]


def test_quality_keeps_good_documents(spark, stages):
    before, after = (texts(x) for x in stages[0])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good, bad = ([i for i, q in labels.items() if q == v and i in before] for v in (1, 0))
    assert set(after.items()) <= set(before.items())
    assert sum(i in after for i in good) / len(good) > 0.97
    assert sum(i in after for i in bad) / len(bad) < 0.5


def test_lines(stages):
    before, after = stages[1]
    sites = defaultdict(set)
    for r in before.collect():
        for line in (r.text or "").split("\n"):
            if line.strip(" "):
                sites[line.strip(" ")].add(r.source)
    bad = {x for x, s in sites.items() if len(s) >= 10}
    want = {r.doc_id: "\n".join(x for x in (r.text or "").split("\n") if x.strip(" ") not in bad) for r in before.collect()}
    assert texts(after) == want
    assert all(r.n_chars == len(r.text) for r in after.collect())


def sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_duplicates(stages):
    before, after = (texts(x) for x in stages[2])
    shingles = {i: sets(t) for i, t in before.items()}
    parent = {i: i for i in before}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(before):
        for j in sorted(before):
            if j < i and shingles[i] and 100 * len(shingles[i] & shingles[j]) >= 80 * len(shingles[i] | shingles[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert after == {i: t for i, t in before.items() if root(i) == i}
    assert len(after) < len(before)


def test_mixing_repeats_small_sources_only(stages):
    before, after = stages[3]
    rows = Counter(r.doc_id for r in after.collect())
    source = {r.doc_id: r.source for r in before.collect()}
    assert set(rows) == set(source) and max(rows.values()) <= 3
    assert texts(before) == texts(after)


def test_packing_holds_all(stages):
    docs, bins = stages[4]
    n = Counter()
    for r in docs.collect():
        n[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    held, room, inside = Counter(), Counter(), Counter()
    for r in bins.collect():
        held[r.doc_id] += r.n_tokens
        room[r.pack_id] += r.n_tokens
        inside[r.pack_id, r.doc_id] += 1
    assert held == n and max(room.values()) <= 2048 and max(inside.values()) == 1


def test_run(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.select("doc_id", "piece", "n_tokens").collect())) == sorted(map(tuple, stages[4][1].select("doc_id", "piece", "n_tokens").collect()))


def test_representatives_of_odd_rows(spark):
    rows = [(None, None, "s", 1), (None, "a b c d e f", "s", 1), (5, "a b c d e f", "s", 2), (5, "a b c d e f", "s", 2), (4, "A b c d e f", "t", 3), (7, "", "t", 4), (8, "", "t", 4), (None, "alone", "t", 5)]
    got = representatives(spark.createDataFrame(rows, "doc_id bigint, text string, `hash` string, copy int"))
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == [(0, ""), (0, "alone"), (4, "A b c d e f"), (7, ""), (8, "")]
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, SF).count() == 0
