"""Audit of filters that are applied one after another, for every order of them.

A document is five bits: which filters it fails. All orders are answered from the counts of these masks:
the step at which an order removes a mask is the smallest place that one of its failing filters has, the
min-plus product of the mask matrix (0 where a filter fails, else infinite) and the matrix of inverse
permutations. Counts are scattered by that step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import whole_text

FILTERS = "ABCDE"
#: Thresholds of the filters: words, share of different words, share of capitals (both in per cent).
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
#: Bytes of UTF-8 that go on with a code point.
CONTINUES = bytes(range(0x80, 0xC0))
RESULT = ", ".join(["part string", "filter_order string", "step int", *[f"{c} bigint" for c in COUNTS]])


def mask_of(text: bytes) -> int:
    """Bits 0 to 3: whether the whole text fails A, B, C or D."""
    words = text.split()  # at ASCII white space
    capitals = len(text) - len(text.translate(None, CAPITALS))
    points = len(text.translate(None, CONTINUES))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
        | (100 * capitals > MOST_CAPITALS * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (filters A to D), and a 128-bit digest of the whole text, per document."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        whole_text().alias("text"),
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b["text"].cast(pa.binary()).to_pylist()
            digests = b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in texts)
            halves = np.frombuffer(digests, "<i8").reshape(-1, 2)
            masks = pa.array(map(mask_of, texts), pa.int32(), size=len(texts))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["part"], masks, pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                ["doc_id", "part", "mask", "high", "low"],
            )

    return rows.mapInArrow(judge, "doc_id bigint, part string, mask int, high bigint, low bigint")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (all five filters), good, toxic and the number n of such documents.

    A document fails E if a smaller doc_id has its text. Rows are counted before anything is joined, and
    of a text only the rows with its smallest doc_id pass, so neither copies nor repeated rows are
    gathered: a text that a third of all documents have is one partial count per task.
    """
    rows = failures(docs).groupBy("doc_id", "part", "mask", "high", "low").agg(F.count(F.lit(1)).alias("n"))
    flags = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    flags = flags.agg(*[F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c) for c in ("quality", "toxic")])
    named = rows.where("doc_id is not null").join(flags, "doc_id", "left")
    flagged = [F.coalesce(c, F.lit(False)).alias(n) for c, n in ((F.col("quality"), "good"), (F.col("toxic"), "bad"))]
    kind = ("part", "mask", "good", "bad")
    of_text = named.select("doc_id", "part", "mask", "high", "low", "n", *flagged).groupBy("high", "low", *kind)
    of_text = of_text.agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("at_least")
    )
    least = of_text.groupBy("high", "low").agg(F.min("least").alias("first"))
    passing = F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
    split = F.explode(F.array(F.struct(F.lit(0).alias("e"), passing.alias("n")), F.struct(F.lit(16).alias("e"), (F.col("n") - passing).alias("n"))))
    of_ids = of_text.join(least, ["high", "low"]).select(*kind, split.alias("s"))
    of_ids = of_ids.select("part", (F.col("mask") + F.col("s.e")).alias("mask"), "good", "bad", "s.n").where("n > 0")
    # Rows without doc_id have no labels and are not compared.
    others = rows.where("doc_id is null").select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("bad"), "n")
    return of_ids.unionByName(others).groupBy(*kind).agg(F.sum("n").alias("n"))


def removal_steps() -> tuple[list[str], np.ndarray, np.ndarray]:
    """All orders, the place of every filter in each (orders x filters), and the removal step of every
    mask in each (masks x orders, one more than the number of filters for the mask that is never removed)."""
    orders = list(permutations(range(len(FILTERS))))
    place = np.empty((len(orders), len(FILTERS)), np.int64)
    for i, order in enumerate(orders):
        place[i, list(order)] = np.arange(1, len(FILTERS) + 1)
    fails = np.arange(1 << len(FILTERS))[:, None] >> np.arange(len(FILTERS)) & 1
    never = len(FILTERS) + 1
    cost = np.where(fails == 1, 0, never)
    step = np.minimum((cost[:, None, :] + place[None, :, :]).min(axis=2), never)
    return ["".join(FILTERS[f] for f in order) for order in orders], place, step


def audit_of(mask: np.ndarray, good: np.ndarray, bad: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of one part, each orders x steps."""
    names, place, step = removal_steps()
    orders, filters = place.shape
    weight = np.zeros((3, 1 << filters), np.int64)
    for row, use in enumerate((np.ones(len(n), bool), good, bad)):
        np.add.at(weight[row], mask[use], n[use])
    # Scatter: the weight of each mask to (order, step at which it goes).
    at = np.arange(orders)[None, :] * (filters + 1) + step - 1
    lost = np.zeros((3, orders * (filters + 1)), np.int64)
    for row in range(3):
        np.add.at(lost[row], at.ravel(), np.repeat(weight[row], orders))
    removed, good_lost, toxic_lost = lost.reshape(3, orders, filters + 1)[:, :, :filters]
    here = np.argsort(place, axis=1)  # the filter of each step
    fails = np.arange(1 << filters)[:, None] >> np.arange(filters) & 1
    failing = weight[0] @ fails
    alone = weight[0][1 << np.arange(filters)]
    total = np.zeros(filters, np.int64)
    np.add.at(total, here.ravel(), removed.ravel())
    return {
        "kept": weight[0].sum() - np.cumsum(removed, axis=1),
        "removed": removed,
        "redundant": failing[here] - removed,
        "unique_fails": alone[here],
        "good_lost": good_lost,
        "toxic_lost": toxic_lost,
        "shapley": total[here],
    }


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, zeros included: ``part``, ``filter_order``, ``step``
    and the counts of ``COUNTS``.

    ``kept`` are left after the step, ``removed`` go at it, ``redundant`` fail its filter but went before,
    ``unique_fails`` fail no other filter, ``good_lost`` and ``toxic_lost`` are the removed with such a
    label, ``shapley`` sums what the filter removes over all orders. A part is a value of ``source``; null
    and the empty string are one part.

    A null text is empty and fails A; very long ones are judged whole; a row without doc_id has no label
    and is not compared with others by E, nor are rows of one doc_id with each other; of several labels of
    one doc_id each counts; null labels are none. Repeated rows count as often as they occur. An empty
    table has no parts. Other columns are not looked at. A part is at most 128 counts, whatever its size.
    """
    names = removal_steps()[0]

    def one_part(table: pa.Table) -> pa.Table:
        columns = {c: table[c].to_numpy() for c in ("mask", "good", "bad", "n")}
        counts = audit_of(*columns.values())
        steps = len(FILTERS)
        rows = len(names) * steps
        return pa.table(
            {
                "part": pa.array([table["part"][0].as_py()] * rows, pa.string()),
                "filter_order": pa.array(np.repeat(names, steps).tolist(), pa.string()),
                "step": pa.array(np.tile(np.arange(1, steps + 1), len(names)), pa.int32()),
                **{c: pa.array(counts[c].ravel(), pa.int64()) for c in COUNTS},
            }
        )

    return mask_counts(docs, labels).groupBy("part").applyInArrow(one_part, RESULT)
