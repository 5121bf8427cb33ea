"""Mixing: targets met, budgets kept, blocks permuted."""

import math
import random
from collections import Counter, defaultdict

import pytest

from ledgerlift.llm.mixing import Mix, budgets, exponent, mix_sources, mixed_documents, source_totals

SCHEMA = "doc_id bigint, text string, source string, block int, tokens string"


def corpus(spark, sizes, seed=1):
    rnd = random.Random(seed)
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i, "w " * rnd.randrange(1, 20), source, 1, "t"))
            i += 1
    return spark.createDataFrame(rows, SCHEMA), rows


def totals_of(rows):
    out = Counter()
    for _, text, source, *_ in rows:
        out[source] += len(text.split())
    return out


def test_exponents(spark):
    df, rows = corpus(spark, {"a": 500, "b": 50, "c": 20})
    from pyspark.sql import functions as F

    t = source_totals(df.select("source", F.size(F.split(F.trim("text"), " ")).cast("bigint").alias("tokens")))
    total = totals_of(rows)
    share = {s: n / sum(total.values()) for s, n in total.items()}

    def entropy(a):
        z = sum(p**a for p in share.values())
        return -sum(p**a / z * math.log(p**a / z) for p in share.values())

    ratio = max(share.values()) / min(share.values())
    a = exponent(t, Mix(most_repeats=3.0))
    assert ratio ** (1 - a) <= 3.0 < ratio ** (1 - (a - 2**-20))
    a = exponent(t, Mix(most_repeats=None, least_entropy=0.9))
    assert entropy(a) >= 0.9 > entropy(a + 2**-20)
    assert exponent(t, Mix(most_repeats=None, least_entropy=0.0)) == 1.0
    assert exponent(t, Mix(most_repeats=None, least_entropy=9.0)) == 0.0
    assert exponent(t, Mix(most_repeats=1e9)) == 0.0 and exponent(t, Mix(most_repeats=1.0)) == pytest.approx(1, abs=1e-5)


def test_whole_corpus_with_repeats(spark):
    df, rows = corpus(spark, {"a": 900, "b": 90, None: 30, "é": 3})
    mix = Mix(most_repeats=4.0, block_tokens=500)
    got = mix_sources(df, mix, per_bucket=16).collect()
    total = totals_of(rows)
    times = Counter(r.row.doc_id for r in got)
    assert set(times) == {r[0] for r in rows}
    held = Counter()
    for r in got:
        held[r.source] += r.tokens
    repeats = {s: held[s] / total[s] for s in total}
    assert repeats["a"] == 1.0 and 3.5 < repeats["é"] <= 4.6
    epochs = defaultdict(set)
    for r in got:
        assert r.epoch not in epochs[r.row.doc_id]
        epochs[r.row.doc_id].add(r.epoch)
    assert all(e == set(range(len(e))) for e in epochs.values())
    blocks = defaultdict(list)
    for r in got:
        blocks[r.block].append(r)
    assert set(blocks) == set(range(len(blocks)))
    share = held["a"] / sum(held.values())
    for members in blocks.values():
        assert sorted(r.place for r in members) == list(range(len(members)))
        assert abs(sum(r.tokens for r in members if r.source == "a") / sum(r.tokens for r in members) - share) < 0.15
        # permuted, not source by source
        runs = sum(x.source != y.source for x, y in zip(sorted(members, key=lambda r: r.place), sorted(members, key=lambda r: r.place)[1:]))
        assert runs > 1
    again = mix_sources(df.repartition(5), mix, per_bucket=16).collect()
    assert sorted((r.row.doc_id, r.epoch, r.block, r.place) for r in got) == sorted((r.row.doc_id, r.epoch, r.block, r.place) for r in again)
    other = mix_sources(df, Mix(most_repeats=4.0, block_tokens=500, seed=1)).collect()
    assert {(r.row.doc_id, r.epoch, r.block) for r in got} != {(r.row.doc_id, r.epoch, r.block) for r in other}


def test_budget(spark):
    df, rows = corpus(spark, {"a": 900, "b": 90})
    mix = Mix(most_repeats=2.0, budget=4000, block_tokens=1000)
    got = mix_sources(df, mix).collect()
    held = Counter()
    for r in got:
        held[r.source] += r.tokens
    assert 4000 <= sum(held.values()) < 4000 + 2 * 20
    assert held["b"] <= 2 * totals_of(rows)["b"] + 20


def test_rows_it_must_take(spark):
    rows = [(None, None, None, None, None), (1, "", "a", 1, "x"), (1, "", "a", 1, "x"), (2, "w " * 5000, "a", 2, "y"), (3, "", "only empty", 3, "z")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixed_documents(df)
    assert got.schema == df.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    assert mixed_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixed_documents(df.where("doc_id = 3")).count() == 1
    with pytest.raises(ValueError):
        Mix(least_entropy=1.0)


def test_ties_and_missing_ids_come_in_one_order(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice([None, None, 1, 2, i]), "w " * rnd.randrange(1, 30) + rnd.choice(["", "x", "y"]), rnd.choice("aab"), i, None) for i in range(300)]
    rows += rows[:20]
    found = []
    for k in range(3):
        rnd.shuffle(rows)
        got = mix_sources(spark.createDataFrame(rows, SCHEMA).repartition(1 + 3 * k), Mix(most_repeats=2.0, block_tokens=700), per_bucket=32).collect()
        found.append(sorted(((tuple(r.row), r.epoch, r.block, r.place) for r in got), key=str))
    assert found[0] == found[1] == found[2] and len(found[0]) >= len(rows)
    from ledgerlift.llm.mixing import row_digest

    none = spark.createDataFrame([(None, f"t{i}", "a", i, None) for i in range(100)], SCHEMA)
    assert none.select(row_digest(none)).distinct().count() == 100
