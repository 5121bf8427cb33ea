"""Packing against a scan over all bins, and its conflicts."""

import random
from collections import Counter, defaultdict

import pytest

from ledgerlift.llm.packing import best_fit, pack, with_copies
from ledgerlift.llm.parity_join import with_components

SCHEMA = "doc_id bigint, text string, source string, shard int, cluster string"


def scan(items, capacity, per_source):
    """Best fit by looking at every bin; of equally tight bins the first."""
    bins, out = [], []
    for item in sorted(items, key=lambda i: (-i[0], i[1], i[2] is not None, i[2] or "", i[3] is not None, i[3] or 0, i[4])):
        size, cluster, source = item[:3]
        fits = [(b["left"], n) for n, b in enumerate(bins) if b["left"] >= size and cluster not in b["clusters"] and b["sources"][source] < per_source]
        if fits:
            n = min(fits)[1]
        else:
            n = len(bins)
            bins.append({"left": capacity, "clusters": set(), "sources": Counter()})
        b = bins[n]
        out.append((*item, n, capacity - b["left"]))
        b["left"] -= size
        b["clusters"].add(cluster)
        b["sources"][source] += 1
    return out


@pytest.mark.parametrize("seed", range(8))
def test_equals_a_scan_over_all_bins(seed):
    rnd = random.Random(seed)
    items = [(rnd.choice([0, 1, 5, 9, 20, rnd.randrange(1, 50)]), str(rnd.choice([1, 2, 1000 + i])), rnd.choice(["a", "a", "b", None]), i, 0, 0) for i in range(400)]
    assert best_fit(items, 50, 1 + seed % 3) == scan(items, 50, 1 + seed % 3)


def test_whole_documents_and_conflicts(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join("w" for _ in range(rnd.choice([3, 10, 64, 65, 500]))) + (f" {i}" if i % 3 else ""), rnd.choice("aab"), 1, "x") for i in range(300)]
    rows += [(None, None, None, None, None), (400, "", "a", 1, "x"), (401, " é", "a", 1, "x"), (402, "same", "a", 1, "x"), (402, "same", "a", 1, "x")]
    got = pack(spark.createDataFrame(rows, SCHEMA), capacity=64, per_source=2, shard_docs=40).collect()
    texts, source = Counter(), {}
    for i, text, s, *_ in rows:
        texts[i] += len((text or "").split())
        source[i] = s
    held = Counter()
    bins = defaultdict(list)
    for r in got:
        held[r.doc_id] += r.n_tokens
        bins[r.pack_id].append(r)
    assert held == texts and len({(r.doc_id, r.piece, r.pack_id) for r in got}) == len(got)
    text_of = {i: t for i, t, *_ in rows}
    for members in bins.values():
        assert sum(r.n_tokens for r in members) <= 64
        assert max(Counter(source[r.doc_id] for r in members).values()) <= 2
        assert max(Counter(text_of[r.doc_id] for r in members).values()) == 1
        end = 0
        for r in sorted(members, key=lambda r: (r.place, r.n_tokens)):
            assert r.place == end
            end += r.n_tokens


def test_named_clusters_and_empty(spark):
    rows = [(i, f"a {i}", f"s{i}", 0, "same") for i in range(5)]
    assert len({r.pack_id for r in pack(spark.createDataFrame(rows, SCHEMA), cluster="cluster").collect()}) == 5
    assert len({r.pack_id for r in pack(spark.createDataFrame(rows, SCHEMA)).collect()}) == 1
    assert pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_many_copies_do_not_take_quadratic_time():
    items = [(10, "same", "a", i, 0, 0) for i in range(20000)]
    assert len({p[-2] for p in best_fit(items, 100, 4)}) == 20000


def test_rows_that_are_alike_are_spread(spark):
    rows = [(1, "the same text", "a", 1, "x")] * 3000 + [(None, None, None, None, None)] * 2000 + [(i, f"w{i} " * (i % 50), "b", 1, "x") for i in range(5000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = pack(df, shard_docs=100).collect()
    assert len(got) == len(rows) and sum(r.n_tokens for r in got) == sum(len((r[1] or "").split()) for r in rows)
    shards = Counter(r.pack_id >> 32 for r in got)
    assert max(shards.values()) < 3 * sorted(shards.values())[len(shards) // 2]
    again = pack(df.repartition(2), shard_docs=100).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    numbered = with_copies(df.select("doc_id", "text"))
    assert sorted(r.copy for r in numbered.where("doc_id is null").collect()) == list(range(2000))


def test_near_copies_are_kept_apart(spark):
    rnd = random.Random(2)
    base = [f"w{rnd.randrange(500)}" for _ in range(120)]
    rows = [(i, " ".join([*base[:i], "changed", *base[i + 1 :]]), f"s{i}", 1, "x") for i in range(6)]
    rows += [(100 + i, f"short {i}", "t", 1, "x") for i in range(4)] + [(None, rows[0][1], "n", 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = pack(df, clusters=with_components(df, 5, 80)).collect()
    bins = {r.pack_id for r in got if r.doc_id is None or r.doc_id < 100}
    assert len(bins) == 7 and len(got) == len(rows)
