"""The prefix trie against sets of members of every prefix."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ledgerlift.llm.prefix_trie import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, key string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = (*turns.get(c - c % 100, [])[:h], *own[h:])
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = own + sum(saved[x] for x in children[node])
    for node, held in members.items():
        ends = ",".join(str(c) for c in held if len(whole[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        out.append((held[0], len(node), parent, len(held), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def compared(spark, rows, **options):
    got = prefix_trie(spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA), **options).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=repr) == brute(rows)


def conversations(rnd, n, depth, words):
    rows = []
    for c in rnd.sample(range(5 * n), n):
        for turn in range(rnd.randrange(1, depth + 1)):
            rows.append((c, rnd.choice([turn, turn, None]) if c % 7 == 0 else turn, rnd.choice(["user", None]), rnd.choice(words)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_prefixes(spark, seed):
    rnd = random.Random(seed)
    rows = conversations(rnd, 150, 9, ["a", "bb", "é\U0001f600", None, ""])
    rows += [(rnd.choice([0, 100, 200]), t, "user", "hello") for t in range(6)]
    rows += [(None, 1, "user", "nobody"), (3, 2, "x", "tie"), (3, 2, "x", "tie"), (3, 2, "w", "tie")]
    rnd.shuffle(rows)
    compared(spark, rows)


def test_panels_and_conversations_longer_than_a_partition(spark):
    rnd = random.Random(9)
    long = [(7, t, "user", rnd.choice("ab")) for t in range(300)]
    rows = long + [(207, *r[1:]) for r in long[:250]] + [(c, t, "user", x) for c in (8, 9) for t, x in enumerate("abababababab")]
    rows += [(c, *r[1:]) for c in range(1000, 1060) for r in long[:13]]
    rows += conversations(rnd, 40, 20, ["a", "b"])
    compared(spark, rows, width=6)


def test_one_conversation_alike_for_a_third_and_one_hot(spark):
    rows = [(c, t, "user", "same") for c in range(300) for t in range(4)]
    rows += [(100_000, t, "user", str(t % 5)) for t in range(1200)]
    compared(spark, rows)


def test_small_tables(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    compared(spark, [(c, 0, None, None) for c in (1, 5, 105)])  # some are without turns once rebuilt
    compared(spark, [(42, None, "user", "x" * 100_000)])
