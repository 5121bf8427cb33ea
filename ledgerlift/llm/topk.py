"""Exact top-k search by inner product with vector-approximation files.

The approximation file has one byte per component of every vector: the cell that its value lies in. Queries
scan the cells alone, block by block, for bounds of their scores. The k-th best lower bound over all blocks
says which vectors can still be among the best; exact vectors are then read in the order of their bounds:
first the k best, and, as far as their k-th exact score leaves them open, the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.llm.common import shuffle_width, stage

CELLS = 256
QUERIES_AT_ONCE = 64
SAFE = 2.0**62
OPEN = "query bigint, name bigint, lower double, upper double"


def floors(lists: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of floor(256 x); components that a shorter one lacks are 0."""
    ends = lists.offsets.to_numpy()
    lengths = np.diff(ends)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = np.floor(256.0 * lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]])
    return out


def exact_scores(left: np.ndarray, right: np.ndarray) -> list[int]:
    """Inner products of rows of whole numbers held as double, as exact integers."""
    bound = np.abs(left).sum(axis=1).max(initial=0.0) * np.abs(right).max(initial=0.0)
    if bound < SAFE:
        return np.einsum("ij,ij->i", left.astype(np.int64), right.astype(np.int64)).tolist()
    return [sum(int(x) * int(y) for x, y in zip(a, b, strict=True)) for a, b in zip(left, right, strict=True)]


class Grid:
    """The cells of every component: equally wide between its extremes over the table."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.low, self.high = low, high
        self.width = (high - low) / CELLS

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        safe = np.where(self.width > 0, self.width, 1.0)
        return np.clip((vectors - self.low) / safe, 0, CELLS - 1).astype(np.uint8)

    def bounds(self, cells: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The scores of the cells' middles (query x vector), and how far a true score may be from them."""
        middle = cells.astype(np.float64) @ (queries * self.width).T
        middle += (self.low + self.width / 2) @ queries.T
        # Half a cell, and room for rounding.
        largest = np.maximum(np.abs(self.low), np.abs(self.high))
        slack = np.abs(queries) @ (self.width / 2 * (1 + 1e-9) + largest * 1e-9) + 1e-6
        return middle.T, slack


def extremes(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and the largest floor(256 x) of each component, 0 where some vector lacks it."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.zeros(0), np.zeros(0)
        seen = False
        for b in batches:
            if not b.num_rows:
                continue
            width = max(len(low), int(np.diff(b["v"].offsets.to_numpy()).max()))
            part = floors(b["v"], width)
            # What a side lacks is 0 there.
            low, high = (np.r_[x, np.zeros(width - len(x))] for x in (low, high))
            low = np.minimum(low, part.min(axis=0)) if seen else part.min(axis=0)
            high = np.maximum(high, part.max(axis=0)) if seen else part.max(axis=0)
            seen = True
        n = len(low)
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(n), pa.int32()), "low": pa.array(low), "high": pa.array(high), "of": pa.array([n] * n, pa.int32())})

    parts = rows.select("v").mapInArrow(own, "i int, low double, high double, of int")
    # A task whose vectors are all shorter tells nothing of the others' components: there it has zeros.
    found = parts.groupBy("i").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    shortest = rows.agg(F.min(F.size("v"))).first()[0] or 0
    low, high = np.zeros(len(found)), np.zeros(len(found))
    for r in found:
        lacking = r.i >= shortest
        low[r.i], high[r.i] = (min(r.low, 0.0), max(r.high, 0.0)) if lacking else (r.low, r.high)
    return low, high


def scan(cells: np.ndarray, alone: np.ma.MaskedArray, ids: np.ndarray, queries: np.ndarray, grid: Grid, k: int) -> Iterator[tuple]:
    """(query's row, rows of a block that its bounds leave open for it, lower and upper bounds).

    ``alone`` is the id of a vector that has no other, else masked: it is no candidate of its own query.
    """
    for first in range(0, len(queries), QUERIES_AT_ONCE):
        middles, slacks = grid.bounds(cells, queries[first : first + QUERIES_AT_ONCE])
        for row, (middle, slack) in enumerate(zip(middles, slacks, strict=True), first):
            middle = np.where((alone.data == ids[row]) & ~np.ma.getmaskarray(alone), -np.inf, middle)
            kth = np.partition(middle, -k)[-k] if len(middle) > k else -np.inf
            left = np.flatnonzero((middle + slack >= kth - slack) & (middle > -np.inf))
            yield row, left, middle[left] - slack, middle[left] + slack


def candidates_of(rows: DataFrame, k: int) -> DataFrame:
    """Of the rows of equal vectors those that can be among k results: k of an id, k + 1 ids. Limited before they move."""
    of_row = Window.partitionBy("name", "id").orderBy("name")
    rows = rows.withColumn("copy", F.row_number().over(of_row)).where(F.col("copy") <= k)
    of_vector = Window.partitionBy("name").orderBy("id")
    return rows.withColumn("place", F.dense_rank().over(of_vector)).where(F.col("place") <= k + 1).select("name", "id", "v")


def top_k(
    table: DataFrame, k: int = 5, every: int = 50, block_vectors: int = 32768, query_block: int = 8192
) -> DataFrame:
    """The k highest integer inner products of each query: query_id, rank (from 1), vec_id, score.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all rows of another vec_id.
    Equal vectors are one entry of the approximation file, however many rows have them. It is dealt into
    blocks, queries into blocks of ``query_block``; a pair of blocks only brings cells and queries together.

    Vectors that are null, or hold a null or a number that is not finite, take no part, nor do null ids.
    Components that the shorter of two vectors lacks count as 0; very long vectors are taken whole. Ties go
    to the smaller vec_id. Equal rows are candidates of their own but one query. Queries without candidates
    have no rows; an empty table has none. Other columns are not looked at.
    """
    values = F.col("embedding").cast("array<double>")
    rows = table.select(F.col("vec_id").cast("bigint").alias("id"), values.alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull())
    # NaN sorts above infinity.
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))))
    rows = rows.select(F.xxhash64("v").alias("name"), "id", "v")
    vectors = stage(candidates_of(rows, k), "vectors")
    wanted = rows.where(F.col("id") % every == 0).select(F.xxhash64("name", "id").alias("query"), "id", "v")
    queries = stage(wanted.dropDuplicates(["query"]), "queries")

    low, high = extremes(vectors)
    grid, width = Grid(low, high), len(low)
    ids = F.when(F.min("id") == F.max("id"), F.min("id")).alias("alone")
    distinct = vectors.groupBy("name").agg(ids, F.first("v").alias("v"))

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = [c.tobytes() for c in grid.cells(floors(b["v"], width))]
            yield pa.RecordBatch.from_arrays([b["name"], b["alone"], pa.array(cells, pa.binary())], ["name", "alone", "cells"])

    file = stage(distinct.mapInArrow(approximate, "name bigint, alone bigint, cells binary"), "approximation")
    n, m = file.count(), queries.count()
    groups, parts = max(1, -(-n // block_vectors)), max(1, -(-m // query_block))
    # Small tables still spread over the session's partitions.
    groups = max(groups, min(shuffle_width(table.sparkSession), -(-n // 1024)))

    def cell(group, part):
        return (group * parts + part).alias("cell")

    left = file.select("*", F.pmod("name", F.lit(groups)).alias("g"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("p"))
    right = queries.select("*", F.pmod("query", F.lit(parts)).alias("p"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"))
    left, right = left.select("name", "alone", "cells", cell(F.col("g"), F.col("p"))), right.select("query", "id", "v", cell(F.col("g"), F.col("p")))

    def search(block: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if block.num_rows and asked.num_rows:
            cells = np.frombuffer(b"".join(block["cells"].to_pylist()), np.uint8).reshape(block.num_rows, width)
            alone = block["alone"].combine_chunks()
            alone = np.ma.array(alone.fill_null(0).to_numpy(), mask=alone.is_null().to_numpy(zero_copy_only=False))
            names, keys = block["name"].to_numpy(), asked["query"].to_numpy()
            asked_for = floors(asked["v"].combine_chunks(), width)
            for row, rows, lower, upper in scan(cells, alone, asked["id"].to_numpy(), asked_for, grid, k):
                found.append((np.full(len(rows), keys[row]), names[rows], lower, upper))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0)] * 4
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table({c.split()[0]: pa.array(x.astype(t.to_pandas_dtype()), t) for c, x, t in zip(OPEN.split(", "), columns, kinds, strict=True)})

    still = stage(left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(search, OPEN), "open")

    # The k-th lower bound over all blocks; each of these vectors has at least one row that counts.
    order = Window.partitionBy("query").orderBy(F.desc("lower"), "name")
    kth = still.withColumn("n", F.row_number().over(order)).where(F.col("n") == k).select("query", F.col("lower").alias("kth"))
    still = still.join(kth, "query", "left").where(F.col("kth").isNull() | (F.col("upper") >= F.col("kth"))).select("query", "name", "upper")
    first = Window.partitionBy("query").orderBy(F.desc("upper"), "name")
    still = stage(still.withColumn("turn", F.row_number().over(first)), "turns")

    def scored(pairs: DataFrame) -> DataFrame:
        """query, query_id, vec_id and the exact score of (query, name)."""
        both = pairs.join(vectors.select("name", F.col("id").alias("vec_id"), F.col("v").alias("a")), "name")
        both = both.join(queries.select("query", F.col("id").alias("query_id"), F.col("v").alias("b")), "query").where("query_id <> vec_id")

        def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, 1024):
                    part = b.slice(at, 1024)
                    scores = exact_scores(floors(part["a"], width), floors(part["b"], width))
                    arrays = [part["query"], part["query_id"], part["vec_id"], pa.array(scores, pa.int64())]
                    yield pa.RecordBatch.from_arrays(arrays, ["query", "query_id", "vec_id", "score"])

        columns = both.select("query", "query_id", "vec_id", "a", "b")
        return columns.mapInArrow(products, "query bigint, query_id bigint, vec_id bigint, score bigint")

    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    near = stage(ranked(scored(still.where(F.col("turn") <= k).select("query", "name"))), "nearest")
    certain = near.where(F.col("rank") == k).select("query", F.col("score").alias("reached"))
    rest = still.where(F.col("turn") > k).join(certain, "query", "left")
    rest = rest.where(F.col("reached").isNull() | (F.col("upper") >= F.col("reached"))).select("query", "name")
    out = ranked(near.drop("rank").unionByName(scored(rest)))
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
