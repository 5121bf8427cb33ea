"""Personal data against Python's own regular expressions."""

import hashlib
import random
import re

import pytest
from pyspark.sql import types as T

from ledgerlift.llm.pii import SSN, find_pii, mod97, pii_digest
from pyspark.sql import functions as F

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SCHEMA = "doc_id bigint, text string"


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if 2 * x > 9 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def passes(kind, s):
    n = sum(c in "0123456789" for c in s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        return 12 <= n <= 19 and luhn(s)
    return kind == "email" or 9 <= n <= 15


def brute(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            if passes(kind, m[0]):
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def check(spark, texts):
    got = {r.doc_id: r for r in pii_digest(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()}
    for i, text in enumerate(texts):
        want = brute(text)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (text, want, got[i].spans)
        for kind in PATTERNS:
            assert got[i][f"n_{kind}"] == sum(w.startswith(kind + ":") for w in want)
        assert set(want) <= set(got[i].spans.split(",")) or not want


def test_edges(spark):
    check(
        spark,
        [
            None,
            "",
            "a@b.c_x@d.e",
            "x@y z@w.q.r.s-t..u@v.w",
            "1.2.3.999.5.6.7.8 01.002.0003.255 256.1.1.1 1.2.3.4.5.6.7.8 00000256.1.1.1",
            "4111 1111-1111 1111 and 4111111111111111 and 4111  1111 1111 1111 5500-0000-0000-0004",
            "+1 (366) 555-9807, +12, +1 ( ) 2, ++44 20 7946 0958-, +1234567890123456",
            "é😀 bosbt.42@mail8.example.com 😀 +49 30 123456 1.1.1.1",
            "1" * 30 + " " + "4111111111111111 4111111111111111",
            "a." * 3000 + "@" + "b." * 9000 + "c",
            "x" * 50000,
            "1.1.1.1 " * 4000,
        ],
    )


def test_random(spark):
    rnd = random.Random(3)
    pieces = list("0123456789") * 2 + list("ab@@..-- ++()é😀_%\n") + ["4111111111111111", "1.2.3.4", "a@b.co", "+1 366 555 9807"]
    check(spark, ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(120))) for _ in range(1500)])


def test_added_kinds_and_context(spark):
    rows = [
        (0, "IBAN GB82 WEST 1234 5698 7654 32 ok"),
        (1, "GB83WEST12345698765432"),
        (2, "my ssn is 123-45-6789"),
        (3, "code 123-45-6789"),
        (4, "call +1 366 555 9807"),
        (5, "order version +1 366 555 9807"),
    ]
    got = {r.doc_id: r.spans for r in find_pii(spark.createDataFrame(rows, SCHEMA)).collect()}
    kinds = {i: [s.kind for s in x] for i, x in got.items()}
    assert "iban" in kinds[0] and "iban" not in kinds[1]
    assert kinds[2] == ["ssn"] and kinds[3] == []
    assert got[4][0].score > got[5][0].score and kinds[5] == ["phone"]


def test_context_reaches_over_other_matches(spark):
    """The score is that of the 40 code points on either side, whatever matches stand in them."""
    numbers = ["123-45-6789", "234-56-7891", "345-67-8912"]
    rnd = random.Random(5)
    parts = [*numbers, "ssn", "é😀", " page ", ", ", " ", "x" * 15, "y" * 60]
    texts = ["SSN: " + ", ".join(numbers), ", ".join(numbers) + " is my ssn", "ssn " + "z" * 41 + " 123-45-6789"]
    texts += [" ".join(rnd.choice(parts) for _ in range(rnd.randrange(30))) for _ in range(300)]
    got = {r.doc_id: r.spans for r in find_pii(spark.createDataFrame(list(enumerate(texts)), SCHEMA), least=0.0).collect()}
    for i, text in enumerate(texts):
        want = []
        for m in re.finditer(SSN, text):
            around = (text[max(0, m.start() - 40) : m.start()] + "\n" + text[m.end() : m.end() + 40]).lower()
            score = 0.4 + 0.15 * bool(re.search(r"\b(?:ssn|social security|taxpayer)\b", around, re.ASCII))
            score -= 0.25 * bool(re.search(r"\b(?:version|order|invoice|isbn|sku|item|page)\b", around, re.ASCII))
            want.append((m.start(), m.end(), pytest.approx(score)))
        assert [(s.start, s.end, s.score) for s in got[i] if s.kind == "ssn"] == want, text
    kept = find_pii(spark.createDataFrame(list(enumerate(texts[:3])), SCHEMA)).collect()
    assert [len(r.spans) for r in sorted(kept, key=lambda r: r.doc_id)] == [3, 3, 0]
    phones = "phone " + "+1 2 " * 6 + "+1 366 555 9807"
    assert find_pii(spark.createDataFrame([(1, phones)], SCHEMA)).first().spans[0].score == pytest.approx(0.85)


@pytest.mark.parametrize("iban,ok", [("DE89370400440532013000", True), ("DE89370400440532013001", False), ("GB82WEST12345698765432", True)])
def test_mod97(spark, iban, ok):
    assert spark.range(1).select(mod97(F.lit(iban))).first()[0] is ok


def test_rows_it_must_take(spark):
    schema = T.StructType.fromDDL("doc_id bigint, text string, spans string, found_ip int, id int, place string")
    rows = [(None, None, None, None, None, None), (1, "a@b.c", "x", 1, 1, "y"), (1, "a@b.c", "x", 1, 1, "y")]
    got = pii_digest(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, r.n_email) for r in got) == [(0, 0), (1, 1), (1, 1)]
    assert pii_digest(spark.createDataFrame([], schema)).count() == 0
