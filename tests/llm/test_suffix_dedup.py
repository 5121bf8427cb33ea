"""Removal of repeated strings against a dictionary of all strings."""

import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerlift.llm.suffix_dedup import anchors, big_endian_words, multikey_order, remove_repeats, settled_here, without_marks

SCHEMA = "doc_id bigint, text string, id int, spot string, digest int"


def brute(rows, length):
    least = {}
    datas = [(-(2**63) if i is None else i, (t or "").encode()) for i, t, *_ in rows]
    for i, data in datas:
        for at in range(len(data) - length + 1):
            s = data[at : at + length]
            least[s] = min(i, least.get(s, i))
    out = []
    for (i, data), (doc, *_) in zip(datas, rows):
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            if least[data[at : at + length]] < i:
                gone[at : at + length] = b"\1" * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((doc, len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out, key=str)


def texts(seed, n):
    rnd = random.Random(seed)
    vocabulary = [f"wörd{i}" for i in range(80)] + ["a", "bb", "ccc", "😀"]
    passages = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([5, 9, 12, 30]))) for _ in range(6)]
    out = []
    for _ in range(n):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 8, 40, 120]))]
        for _ in range(rnd.randrange(3)):
            words.insert(rnd.randrange(len(words) + 1), rnd.choice(passages))
        if rnd.random() < 0.2:
            words = rnd.choice(["x" * 60, "ab" * 40, " " * 90, "x" * 49]).split("~") + words[:3]
        if out and rnd.random() < 0.3:
            base = rnd.choice(out)
            at = rnd.randrange(len(base) + 1)
            out.append(base[:at] + rnd.choice(["", "Q", "QQQ"]) + base[at:])
        else:
            out.append(" ".join(words))
    return out


@pytest.mark.parametrize("seed,length,most", [(1, 50, 20000), (2, 50, 8), (3, 24, 100), (4, 78, 1)])
def test_against_all_strings(spark, seed, length, most):
    found = texts(seed, 150)
    ids = random.Random(seed).sample(range(-500, 500), len(found))
    rows = [(i, t, 1, "s", 2) for i, t in zip(ids, found)]
    got = remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(4), length, most)
    assert sorted(((*tuple(r)[:4], bytes(r.kept)) for r in got.collect()), key=str) == brute(rows, length)


def test_rows_it_must_take(spark):
    long = " ".join(f"w{i % 977}x{i}" for i in range(20000))
    rows = [(None, "n" * 70, None, None, None), (1, None, 1, "", 1), (2, "", 1, "", 1), (3, "n" * 60, 1, "", 1), (3, "n" * 60, 1, "", 1)]
    rows += [(4, long, 1, "", 1), (5, long[:5000] + "!" + long[5000:], 1, "", 1), (6, "y" * 55, 1, "", 1), (6, "z" + "y" * 55, 1, "", 1), (7, "s", 1, "", 1)]
    got = remove_repeats(spark.createDataFrame(rows, SCHEMA))
    assert sorted(((*tuple(r)[:4], bytes(r.kept)) for r in got.collect()), key=str) == brute(rows, 50)
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_ids_of_unlike_text_and_many_without_id(spark):
    rnd = random.Random(12)
    a, b = ("".join(rnd.choice("abcdef ") for _ in range(80)) for _ in range(2))
    rows = [(1, a, 1, "", 1), (5, a, 1, "", 1), (5, b, 1, "", 1), (9, b + " and a tail", 1, "", 1), (9, "x" + a, 1, "", 1)]
    found = texts(13, 120)
    rows += [(None if i % 3 else rnd.randrange(20, 40), t, 1, "", 1) for i, t in enumerate(found)]
    rows += [(None, found[0], 1, "", 1)] * 40 + [(30, found[1], 1, "", 1)] * 20
    rows += [(i, " ".join([str(i), a, b, str(i * i)]), 1, "", 1) for i in range(50, 110)]
    rnd.shuffle(rows)
    for most in (1_000_000, 5):
        got = remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3), 50, most)
        assert sorted(((*tuple(r)[:4], bytes(r.kept)) for r in got.collect()), key=str) == brute(rows, 50)


def test_equal_suffixes_of_a_batch_are_settled_there():
    rng = np.random.default_rng(3)
    around = rng.integers(0, 2, (300, 11)).astype(np.uint8)
    around[:, :8] = 7
    own, ids = rng.integers(1, 3, 300), rng.integers(-5, 5, 300)
    done = settled_here(ids, own, around)
    for k in range(300):
        same = (around == around[k]).all(axis=1) & (own == own[k])
        assert done[k] == (ids[same].min() < ids[k])


def test_every_string_has_an_anchor():
    data = np.frombuffer(" ".join(texts(9, 20)).encode(), np.uint8)
    place, _, least = anchors(data, 50)
    assert len(least) == len(data) - 49
    gaps = np.diff(np.r_[-1, place])
    assert gaps.max() <= 35 and place[-1] >= len(data) - 50


def test_multikey_order_is_the_order_of_bytes():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 2, (500, 19)).astype(np.uint8)
    order = multikey_order(big_endian_words(rows))
    assert [rows[i].tobytes() for i in order] == sorted(r.tobytes() for r in rows)


def test_texts_are_cut_together():
    """Arrow lists in, one array of bytes out: no object per mark; runs of neighbours do not run together."""
    texts = [b"ab" * 40, b"", b"c" * 60, b"d" * 55, b"e" * 70]
    kind = pa.list_(pa.struct({"spot": pa.int64(), "offsets": pa.int64()}))
    marks = [[{"spot": 30, "offsets": 1}, {"spot": 21, "offsets": 1 << 1 | 1 << 21}], None, [], None, [{"spot": 0, "offsets": 1}, {"spot": 20, "offsets": 1}]]
    skipped = pa.array([[{"spot": 7, "offsets": 3}], *marks], kind)[1:]
    copy = np.array([False, False, False, True, False])
    gone, runs, kept = without_marks(texts, skipped, copy, 50)
    assert gone.tolist() == [80, 0, 0, 55, 70] and runs.tolist() == [1, 0, 0, 1, 1]
    assert kept.to_pylist() == [b"", b"", b"c" * 60, b"", b""]
    assert without_marks([], pa.array([], kind), np.zeros(0, bool), 50)[2].to_pylist() == []
