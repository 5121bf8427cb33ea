"""Fingerprints: edited texts by brute force, likeness, and the radius search against all pairs."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from ledgerlift.llm.simhash import Hasher, edited_fingerprints, likeness, parts_of, ranges, with_fingerprints, with_neighbours, within_radius

SCHEMA = "doc_id bigint, text string, id int, part string, guest int"


def mark(text):
    """Spark's xxhash64 of a text."""
    return (xxhash.xxh64((text or "").encode(), seed=42).intdigest() + 2**63) % 2**64 - 2**63


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -mark(r[1])))
    out, h = [], Hasher()
    for i, (doc, text, *_) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = map(h.fingerprint, (text, edited, after))
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), a.hex(), b.hex(), likeness(a, b), likeness(a, c)))
    return sorted(out, key=str)


@pytest.mark.parametrize("n,parts", [(1, 4), (2, 4), (60, 1), (500, 4), (40, 50)])
def test_edited_texts(spark, n, parts):
    rnd = random.Random(n)
    rows = [(rnd.randrange(10**6) * (-1) ** i, " ".join(rnd.choice(["é", "w1", "😀x", "w2", "w3"]) for _ in range(rnd.randrange(40))), 1, "p", 0) for i in range(n)]
    if n == 60:
        rows += [(None, None, None, None, None), (None, "b c", 1, "", 1), (5, "", 1, "", 1), (5, "tie", 1, "", 1), (5, "tie", 1, "", 1), (10**7, "t", 1, "", 1), (10**7, "s", 1, "", 1), (6, "long " * 30000, 1, "", 1)]
    got = edited_fingerprints(spark.createDataFrame(rows, SCHEMA), parts)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_rows_without_id_are_spread(spark):
    rows = [(i if i % 3 else None, f"text {i}", 1, "", 1) for i in range(6000)]
    assert sorted(map(tuple, edited_fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == brute(rows)
    names = spark.createDataFrame([(-(2**63) if r[0] is None else r[0], mark(r[1])) for r in rows], "id bigint, mark bigint")
    edges, tops = ranges(names, 16)
    part = parts_of(edges, *np.array([tuple(r) for r in names.collect()], np.int64).T)
    size = np.bincount(part)
    assert size.max() < 3 * np.median(size)
    for p, top in tops.items():
        own = [(r.id, r.mark) for r, q in zip(names.collect(), part) if q == p]
        assert max(own) == top


@pytest.mark.parametrize("tile", [3, 1000])
def test_neighbours_of_every_document(spark, tile):
    from ledgerlift.llm import simhash

    rnd = random.Random(5)
    marks = [rnd.getrandbits(128) for _ in range(30)]
    for m in marks[:20]:
        for _ in range(6):
            x = m
            for bit in rnd.sample(range(128), rnd.randrange(1, 5)):
                x ^= 1 << bit
            marks.append(x)
    marks += [0, 1, 2] + marks[:5]
    rows = [(rnd.choice([None, i]), f"{m:032x}", 1) for i, m in enumerate(marks)]
    df = spark.createDataFrame(rows, "doc_id bigint, fingerprint string, key int")
    least = {}
    for i, f, _ in rows:
        least[f] = min(least.get(f, 2**63), 2**63 if i is None else i)

    def expected(f):
        near = [g for g in least if g != f and int(f, 16) and int(g, 16) and (int(f, 16) ^ int(g, 16)).bit_count() <= 3]
        first = min([least[f], *[least[g] for g in near]])
        return len(near), None if first == 2**63 else first

    distinct = df.where("fingerprint <> repeat('0', 32)").groupBy("fingerprint").agg({"doc_id": "min"}).toDF("fingerprint", "least")
    found = {r.fingerprint: r.n_near for r in simhash.neighbours(distinct, 3, tile).collect()}
    assert found == {f: expected(f)[0] for f in least if expected(f)[0]}
    for r in with_neighbours(df).collect():
        n, first = expected(r.fingerprint)
        assert r.n_near == n and r.near_id == (r.doc_id if not int(r.fingerprint, 16) else first)


def test_empty(spark):
    assert with_neighbours(with_fingerprints(spark.createDataFrame([], SCHEMA))).count() == 0
    assert edited_fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0
    assert with_fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0


def test_likeness_follows_the_texts():
    rnd, h = random.Random(2), Hasher()
    words = [f"w{i}" for i in range(3000)]
    half, other = [], []
    for _ in range(60):
        a, b = ([rnd.choice(words) for _ in range(300)] for _ in range(2))
        mixed = a[:150] + b[:150]
        fa, fb, fm = (h.fingerprint(" ".join(t)) for t in (a, b, mixed))
        half.append(likeness(fa, fm))
        other.append(likeness(fa, fb))
    assert 0.6 < sum(half) / 60 < 0.75 and 0.45 < sum(other) / 60 < 0.55
    assert h.fingerprint("A b") == h.fingerprint("a b") and h.fingerprint("") == bytes(16)


@pytest.mark.parametrize("radius", [1, 3, 6])
def test_radius_search_finds_all(spark, radius):
    rnd = random.Random(radius)
    marks = [rnd.getrandbits(128) for _ in range(40)]
    for m in marks[:30]:
        for _ in range(4):
            x = m
            for bit in rnd.sample(range(128), rnd.randrange(1, 9)):
                x ^= 1 << bit
            marks.append(x)
    marks += [marks[0], 0, 1]
    df = spark.createDataFrame([(f"{m:032x}", 1) for m in marks] + [(None, 2)], "fingerprint string, key int")
    got = sorted(map(tuple, within_radius(df, df, radius).collect()))
    unique = set(marks)
    want = sorted((f"{a:032x}", f"{b:032x}", (a ^ b).bit_count()) for a in unique for b in unique if a != b and (a ^ b).bit_count() <= radius)
    assert got == want and want
