"""The filter audit against filters applied one after another."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from ledgerlift.llm.filter_audit import COUNTS, audit

DOCS = "doc_id bigint, text string, source string, part string, n bigint, mask int"
LABELS = "doc_id bigint, quality int, toxic int"


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, t in labels if t == 1 and i is not None}
    facts = []
    for i, text, source in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows),
        }
        facts.append((source or "", {f for f in fails if fails[f]}, i in good, i in bad))
    out, shapley = {}, Counter()
    for part in {f[0] for f in facts}:
        own = [f for f in facts if f[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                failing = sum(f in x[1] for x in own)
                shapley[part, f] += len(gone)
                alone = sum(x[1] == {f} for x in own)
                out[part, order, step] = [len(left), len(gone), failing - len(gone), alone, sum(x[2] for x in gone), sum(x[3] for x in gone)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def compared(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], DOCS)
    got = audit(docs, spark.createDataFrame(labels, LABELS)).collect()
    found = {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in got}
    assert len(found) == len(got)
    assert found == brute(rows, labels)


def some_text(rnd):
    n = rnd.choice([0, 3, 199, 200, 201, 400])
    vocabulary = rnd.choice([n // 2 - 1, n // 2, n, 5])
    text = rnd.choice([" ", "\n", "  "]).join(f"w{rnd.randrange(max(1, vocabulary))}" for _ in range(n))
    return text + rnd.choice(["", "", "é" * 40, " #", " |", "ABC" * rnd.choice([1, 9]), "\xa0 "])


@pytest.mark.parametrize("seed", range(3))
def test_equals_filters_in_turn(spark, seed):
    rnd = random.Random(seed)
    texts = [some_text(rnd) for _ in range(25)]
    rows = [(rnd.randrange(80), rnd.choice(texts), rnd.choice(["a", "a", "b", None, ""])) for _ in range(120)]
    rows += [(None, rnd.choice([None, *texts[:3]]), rnd.choice(["a", None])) for _ in range(40)]
    rows += [rows[0]] * 30 + [(i, None, "a") for i in range(90, 95)] + [(99, "word " * 60_000, "long")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in [*range(0, 100, 2), 4, 4, None, 500]]
    compared(spark, rows, labels)


def test_empty_tables(spark):
    compared(spark, [], [(1, 1, 1)])
    compared(spark, [(1, None, None)], [])
