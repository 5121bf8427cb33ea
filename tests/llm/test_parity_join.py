"""The parity-sketch join against all pairs."""

import random
import re
import time

import numpy as np
import pytest

from ledgerlift.llm.components import components
from ledgerlift.llm.parity_join import (
    Shingles,
    bands,
    bands_of,
    block_keys,
    keys_of_many,
    linked,
    most_different,
    near_duplicates,
    parity_sketch,
    representatives,
    shared_blocks,
    shingle_sets,
    sketch_bits,
    sketch_distance,
    sketches_of_many,
    texts_of,
    verified,
)

SCHEMA = "doc_id bigint, text string, label bigint, `set` int, n int"


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, *_) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(((doc, len(sets[i]), least.get(root(i))) for i, (doc, *_) in enumerate(rows)), key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)] + ["É", "😀", "A", "a"]
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    texts = []
    for _ in range(n):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([2, 5, 9, 20, 60, 150, 400]))]
        if rnd.random() < 0.3:
            words[rnd.randrange(len(words)) :] = passage
        texts.append(words)
        while rnd.random() < 0.6:
            copy = list(texts[-1])
            for _ in range(max(0, round(len(copy) * rnd.choice([0, 0.01, 0.02, 0.03, 0.05])))):
                at = rnd.randrange(len(copy))
                copy[at : at + rnd.randrange(2)] = [rnd.choice(vocabulary)] * rnd.randrange(2)
            texts.append(copy or ["x"])
    rows = [(i, rnd.choice([" ", "\n", "\t "]).join(t), 1, 2, 3) for i, t in enumerate(texts)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,words,percent,rounds", [(1, 4, 85, 3), (2, 5, 80, 0), (3, 3, 60, 1), (4, 4, 100, 1)])
def test_against_all_pairs(spark, seed, words, percent, rounds):
    rows = corpus(seed, 250)
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA), words, percent, rounds)
    want = brute(rows, words, percent)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert percent == 100 or len({c for *_, c in want}) < len({t for _, t, *_ in rows})


def test_a_chain_and_a_group_of_near_copies(spark):
    base = [f"b{i}" for i in range(200)]
    rows = [(i, " ".join(base[: 200 - i] + [f"x{i}{j}" for j in range(3)]), 0, 0, 0) for i in range(60)]
    rows += [(100 + i, " ".join([*base[:i], f"y{i}", *base[i + 1 :]]), 0, 0, 0) for i in range(120)]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA), 4, 85)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 4, 85)


def test_rows_it_must_take(spark):
    rows = [(None, None, None, None, None), (1, "", 0, 0, 0), (2, " \t\n", 0, 0, 0), (3, "One two", 0, 0, 0), (3, "One two", 0, 0, 0), (4, "one TWO", 0, 0, 0)]
    rows += [(None, "one two", 0, 0, 0), (None, "only here", 0, 0, 0), (9, "É x", 0, 0, 0), (8, "é x", 0, 0, 0), (5, "long " * 50000, 0, 0, 0), (7, "a b c", 0, 0, 0), (6, "a b c", 0, 0, 0)]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA), 4, 85)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 4, 85)
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("rounds", [0, 3])
def test_rows_without_doc_id(spark, rounds):
    """Near copies without a doc_id are linked, and join what is only linked with them."""
    rows = [(None if i % 3 == 1 else i, *r) for i, *r in corpus(11, 150)]
    chain = [f"c{i}" for i in range(100)]
    rows += [(doc, " ".join(chain[at : at + 60]), 0, 0, 0) for doc, at in ((9001, 0), (None, 4), (9003, 8), (None, 4))]
    want = brute(rows, 4, 85)
    assert (9003, 57, 9001) in want
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA), 4, 85, rounds)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_representatives_without_doc_id(spark):
    words = [f"r{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (None, " ".join([*words, "more"])), (None, " ".join(f"alone{i}" for i in range(50)))]
    got = representatives(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r.text[:2] for r in got.collect()) == ["al", "r0"]


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_pairs_always_share_a_block(percent):
    rng = np.random.default_rng(percent)
    for size in [4, 5, 6, 7, 9, 12, 20, 33, 60, 99, 100, 150, 400, 1500]:
        for _ in range(40):
            a = rng.integers(0, 2**63, size).astype(np.uint64)
            most = most_different(size, percent)
            drop = rng.integers(0, most + 1)
            add = rng.integers(0, most - drop + 1)
            b = np.r_[a[drop:], rng.integers(0, 2**63, add).astype(np.uint64)]
            a, b = np.unique(a), np.unique(b)
            bits = [parity_sketch(x, sketch_bits(len(x), percent)) for x in (a, b)]
            assert sketch_distance(*bits) <= drop + add
            if len(b) and linked(a, b, percent) and drop + add:
                keys = [set(np.concatenate([block_keys(x, s) for s in bands_of(len(x), percent)]).tolist()) for x in (a, b)]
                assert keys[0] & keys[1]


def test_bands_touch():
    held = bands(85, 1 << 16)
    assert all(x.last + 1 == y.first for x, y in zip(held, held[1:]))
    assert Shingles(4).of("a b c") .size == 1 and Shingles(4).of("").size == 0


def test_components(spark):
    rnd = random.Random(0)
    edges = [(i, i + 1) for i in range(0, 90)] + [(200, 200 + i) for i in range(1, 50)] + [(500, 501), (501, 500), (None, 3)]
    rnd.shuffle(edges)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert all(got[i] == 0 for i in range(91)) and all(got[200 + i] == 200 for i in range(50)) and got[501] == 500
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_tiles_of_large_blocks(spark, monkeypatch):
    import ledgerlift.llm.parity_join as m

    monkeypatch.setattr(m, "TILE", 16)
    monkeypatch.setattr(m, "WORDS_AT_ONCE", 64)
    rows = corpus(7, 200)
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA), 4, 85, rounds=0)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 4, 85)


def test_sets_of_many_texts_are_those_of_each():
    texts = [t.encode() for _, t, *_ in corpus(5, 80)] + [b"", b" \t", b"one", b"a b c", b"a\0 a", b"A" * 64 + b" x", b"a" * 65 + b"\x0bx y z"]
    found = Shingles(4).of_many(texts)
    for text, s in zip(texts, found, strict=True):
        assert s.tolist() == Shingles(4).of_bytes(text).tolist() == sorted(set(s.tolist()))
        assert len(s) == len(shingles(text.decode(), 4))
    assert len({s[0] for s in Shingles(1).of_many([b"a", b"a\0", b"a\0\0", b"ab", b"a" * 8, b"a" * 9, b"a" * 64, b"a" * 65])}) == 8
    assert Shingles(1).of("w" * 65 + "A").tolist() == Shingles(1).of("W" * 65 + "a").tolist()
    use = [bands_of(len(s), 80) if len(s) else [] for s in found]
    for s, bands_used, keys in zip(found, use, keys_of_many(found, use), strict=True):
        assert keys.tolist() == [k for b in bands_used for k in block_keys(s, b).tolist()]
    sets = [s for s in found if len(s)]
    bits = [sketch_bits(len(s), 80) for s in sets]
    assert sketches_of_many(sets, bits) == [parity_sketch(s, n) for s, n in zip(sets, bits)]


def test_sets_move_as_compressed_texts(spark):
    """Hashes of shingles have no redundancy: moving and staging them took three times the room of the texts."""
    rows = [(i, " ".join(f"word{(i + j) % 900}" for j in range(600))) for i in range(6)]
    docs = spark.createDataFrame([*rows, rows[0]], "doc_id bigint, text string")
    names = [Shingles(4).of(t) for _, t in rows]
    from ledgerlift.llm.parity_join import set_name

    wanted = spark.createDataFrame([(i, set_name(s)) for (i, _), s in zip(rows, names)], "doc_id bigint, `set` bigint")
    wanted = wanted.join(docs.distinct(), "doc_id").selectExpr("doc_id", "xxhash64(text) AS text_hash", "`set`")
    texts = texts_of(docs, wanted)
    held = texts.collect()
    assert len(held) == 6 and sum(len(r.text) for r in held) < 8 * sum(map(len, names)) / 2
    ends = [set_name(names[k]) for k in (0, 1, 0, 5)]
    pairs = spark.createDataFrame([tuple(ends[:2]), tuple(ends[2:])], "a bigint, b bigint")
    # The text of another document under a set's name, as equal hashes of texts would give it.
    wrong = texts.where(f"`set` = {ends[1]}").selectExpr(f"{ends[0]} AS `set`", "size", "text")
    got = {tuple(r) for r in verified(pairs, texts.unionByName(wrong), 4, 99).collect()}
    want = {p for p, (x, y) in zip([tuple(ends[:2]), tuple(ends[2:])], [(0, 1), (0, 5)]) if linked(names[x], names[y], 99)}
    assert got == want and len(want) == 1


def test_staged_tables_leave_no_shuffle_files(spark):
    from ledgerlift.llm.common import CLEANUP, stage

    before = spark.conf.get(CLEANUP, None)
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    rows = spark.range(1000).repartition(5, "id")
    old = {str(f) for f in held.getAllFiles().mkString("|").split("|") if "shuffle" in str(f)}
    staged = stage(rows, "rows")
    for _ in range(50):
        new = {f for f in held.getAllFiles().mkString("|").split("|") if "shuffle" in f} - old
        if not new:
            break
        time.sleep(0.1)
    assert not new and spark.conf.get(CLEANUP, None) == before
    assert staged.count() == 1000


def test_blocks_of_the_same_sets_are_one_with_a_weight(spark):
    rnd = random.Random(8)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(400)]
    other = [f"v{rnd.randrange(10**6)}" for _ in range(400)]
    texts = [" ".join(words), " ".join([*words[:-1], "end"]), " ".join(other), " ".join(["start", *other])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    _, packs, drop = shingle_sets(docs, 5, 80)
    rows = shared_blocks(packs).collect()
    drop()
    expected = []
    for pair in (texts[:2], texts[2:]):
        sets = [Shingles(5).of(t) for t in pair]
        keys = [set(np.concatenate([block_keys(s, b) for b in bands_of(len(s), 80)]).tolist()) for s in sets]
        expected += [len(keys[0] & keys[1])] * 2
    assert min(expected) > 1 and sorted(expected) == sorted(r.weight for r in rows)
    assert len({r.block for r in rows}) == 2 and len({r.set for r in rows}) == 4
