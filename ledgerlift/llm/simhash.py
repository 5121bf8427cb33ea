"""SimHash fingerprints, and the search for all fingerprints within a Hamming radius.

A fingerprint has 128 bits. Terms are runs of words; each adds its weight to the bits that are set in its
hash and takes it from the others, and the signs are the fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import shuffle_width, stage, whole_text

BITS = 128
WORDS_A_TERM = 2
REMEMBERED = 1 << 16
#: Rows a range that its edges are drawn from.
SAMPLED = 32
NONE, NONE_BELOW = np.int64(2**63 - 1), -(2**63)
#: Terms whose votes are summed at once: bounds the memory of a very long text.
TERMS_AT_ONCE = 4096
KINDS = {
    "doc_id": pa.int64(),
    "n_chars": pa.int64(),
    "edited_sha256": pa.string(),
    "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(),
    "near_edited": pa.float64(),
    "near_next": pa.float64(),
}
SQL_NAMES = {pa.int64(): "bigint", pa.string(): "string", pa.float64(): "double"}


class Hasher:
    """Fingerprints of texts; remembers the hashes of words."""

    def __init__(self):
        self.words: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        known = self.words.get(word)
        if known is None:
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            known = self.words[word] = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        return known

    def fingerprint(self, text: str) -> bytes:
        """16 bytes; a text without words has all bits 0."""
        words = text.lower().split()
        if not words:
            return bytes(BITS // 8)
        digests = np.frombuffer(b"".join(map(self.word, words)), np.uint64).reshape(-1, 2)
        # A term is a pair of neighbours; a text of one word has that word.
        terms = digests[0:1] if len(words) == 1 else digests[:-1] * np.uint64(0x9E3779B97F4A7C15) + digests[1:]
        terms = terms ^ (terms >> np.uint64(31))
        terms = terms * np.uint64(0xBF58476D1CE4E5B9)
        terms = terms ^ (terms >> np.uint64(29))
        order = np.lexsort((terms[:, 1], terms[:, 0]))
        terms = terms[order]
        starts = np.flatnonzero(np.r_[True, (terms[1:] != terms[:-1]).any(axis=1)])
        weights = np.sqrt(np.diff(np.r_[starts, len(terms)])).astype(np.float32)
        unique = terms[starts]
        votes = np.zeros(BITS)
        for at in range(0, len(unique), TERMS_AT_ONCE):
            bits = np.unpackbits(unique[at : at + TERMS_AT_ONCE].view(np.uint8), axis=1)
            votes += weights[at : at + TERMS_AT_ONCE] @ bits
        return np.packbits(votes * 2 > weights.sum(dtype=np.float64)).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """The share of equal bits."""
    return 1 - (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() / BITS


def with_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and ``fingerprint`` (32 hex digits) of every whole text.

    A null text is an empty one, and has the fingerprint 0; equal texts have equal fingerprints; repeated
    rows and null ids are kept; an empty table gives an empty one; other columns are not looked at.
    """
    rows = docs.select(F.col(id).cast("bigint").alias("id"), whole_text(text).alias("text"))

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            out = [hasher.fingerprint(t).hex() for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(out, pa.string())], ["id", "fingerprint"])

    return rows.mapInArrow(prints, "id bigint, fingerprint string").withColumnRenamed("id", id)


def blocks_of(fingerprint: Column, radius: int) -> list[tuple[str, Column]]:
    """The keys of the permuted tables: each table leads with all but ``radius`` of radius + 2 blocks.

    Two fingerprints within the radius differ in at most ``radius`` blocks, so they agree on the leading
    blocks of at least one table.
    """
    digits = BITS // 4
    blocks = radius + 2
    if blocks > digits:
        raise ValueError("the radius is too large for blocks of whole digits")
    cuts = [digits * i // blocks for i in range(blocks + 1)]
    return [
        (
            "-".join(map(str, kept)),
            F.concat(*[F.substring(fingerprint, cuts[i] + 1, cuts[i + 1] - cuts[i]) for i in kept]),
        )
        for kept in combinations(range(blocks), 2)
    ]


def distance(a: str, b: str) -> Column:
    """The Hamming distance of two columns of fingerprints."""
    out = F.lit(0)
    for at in range(1, BITS // 4 + 1, 8):
        halves = [F.conv(F.substring(c, at, 8), 16, 10).cast("bigint") for c in (a, b)]
        out = out + F.bit_count(halves[0].bitwiseXOR(halves[1]))
    return out


def within_radius(queries: DataFrame, index: DataFrame, radius: int = 3, fingerprint: str = "fingerprint") -> DataFrame:
    """All pairs of different fingerprints within ``radius`` bits: query, found, distance.

    Works on distinct fingerprints, so copies count once: join the result with the tables for the
    documents behind them. Null fingerprints take no part. Tables of any other columns will do.
    """

    def tables(df: DataFrame, name: str) -> DataFrame:
        distinct = df.select(F.col(fingerprint).alias(name)).where(F.col(name).isNotNull()).distinct()
        keys = F.array(*[F.concat(F.lit(f"{t}:"), k) for t, k in blocks_of(F.col(name), radius)])
        return distinct.select(name, F.explode(keys).alias("key"))

    pairs = tables(queries, "query").join(tables(index, "found"), "key").where("query <> found")
    near = pairs.select("query", "found", distance("query", "found").alias("distance"))
    return near.where(F.col("distance") <= radius).distinct()


def parts_of(edges: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The range of each (id, mark): the number of edges, rows of both in order, that lie below it."""
    low, high = (np.searchsorted(edges[:, 0], ids, side) for side in ("left", "right"))
    part = low
    # An id that fills several ranges is cut by its marks.
    for a, b in np.unique(np.stack([low, high], axis=1)[high > low], axis=0).tolist():
        at = (low == a) & (high == b)
        part[at] = a + np.searchsorted(edges[a:b, 1], marks[at], "left")
    return part


def ranges(rows: DataFrame, parts: int) -> tuple[np.ndarray, dict[int, tuple[int, int]]]:
    """Edges that cut (id, mark) into about equal ranges, and the largest of each range that is not empty.

    The edges come from a sample of about SAMPLED rows a range; they decide the balance only. What reaches the
    driver is as long as the number of ranges, which is a setting and does not grow with the table.
    """
    share = min(1.0, SAMPLED * parts / max(1, rows.count()))
    drawn = rows.where(F.pmod(F.xxhash64("mark", "id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    drawn = np.array([(r.id, r.mark) for r in drawn.collect()], np.int64).reshape(-1, 2)
    drawn = drawn[np.lexsort((drawn[:, 1], drawn[:, 0]))]
    edges = np.unique(drawn[np.arange(1, parts) * len(drawn) // parts], axis=0) if len(drawn) else drawn

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: dict[int, tuple[int, int]] = {}
        for b in batches:
            ids, marks = b["id"].to_numpy(), b["mark"].to_numpy()
            part = parts_of(edges, ids, marks)
            order = np.lexsort((marks, ids, part))
            last = order[np.flatnonzero(np.r_[part[order][1:] != part[order][:-1], True][: len(order)])]
            for i in last.tolist():
                top = (int(ids[i]), int(marks[i]))
                tops[int(part[i])] = max(top, tops.get(int(part[i]), top))
        columns = [[p, *top] for p, top in tops.items()]
        kinds = (pa.int32(), pa.int64(), pa.int64())
        arrays = [pa.array(c, k) for c, k in zip(zip(*columns, strict=True) if columns else [[]] * 3, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["part", "id", "mark"])

    tops = rows.mapInArrow(largest, "part int, id bigint, mark bigint")
    tops = tops.groupBy("part").agg(F.max(F.struct("id", "mark")).alias("top"))
    return edges, {r.part: (r.top.id, r.top.mark) for r in tops.collect()}


def tiled(rows: DataFrame, tile: int) -> DataFrame:
    """Rows of a key, with the pairs of tiles of the key that they take part in (``low``, ``high``); keys of one row go."""
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = sizes.select("key", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    own = rows.join(sizes, "key").withColumn("tile", F.pmod(F.xxhash64("fingerprint"), F.col("tiles")).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return other.select(*rows.columns, "tile", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"))


def neighbours(prints: DataFrame, radius: int = 3, tile: int = 2048) -> DataFrame:
    """Of distinct fingerprints (``fingerprint``, ``least`` its smallest doc_id) that have others within
    ``radius`` bits: ``n_near``, how many they are, and ``near_id``, the smallest doc_id of them.

    The permuted block tables bring fingerprints together; a key with many of them is cut into tiles, and
    each pair of tiles is compared by itself. A pair counts in the first table that has it, so only sums
    leave a task, never pairs.
    """
    digits = BITS // 4
    cuts = [digits * i // (radius + 2) for i in range(radius + 3)]
    kept = list(combinations(range(radius + 2), 2))
    masks = []
    for i in range(radius + 2):
        mask = ((1 << 4 * (cuts[i + 1] - cuts[i])) - 1) << 4 * (digits - cuts[i + 1])
        masks.append((np.uint64(mask >> 64), np.uint64(mask & (2**64 - 1))))
    keys = F.array(*[F.concat(F.lit(f"{t}:"), k) for t, (_, k) in enumerate(blocks_of(F.col("fingerprint"), radius))])
    rows = prints.select("fingerprint", "least", F.explode(keys).alias("key"))
    width = shuffle_width(prints.sparkSession)
    placed = tiled(rows, tile).repartition(width, "key", "low", "high").sortWithinPartitions("key", "low", "high")

    def counted(table: int, group: dict) -> tuple:
        words = np.array([[int(f[:16], 16), int(f[16:], 16)] for f in group["fingerprint"]], np.uint64)
        least = np.array([NONE if x is None else x for x in group["least"]], np.int64)
        tile, low, high = np.array(group["tile"]), group["low"][0], group["high"][0]
        left = np.flatnonzero(tile == low)
        right = left if low == high else np.flatnonzero(tile == high)
        n, near = np.zeros(len(tile), np.int64), np.full(len(tile), NONE)
        for at in range(0, len(left), 256):
            i = left[at : at + 256]
            x = words[i][:, None] ^ words[right][None]
            ok = (np.bitwise_count(x).sum(axis=2) <= radius) & (i[:, None] != right[None])
            a, b = np.nonzero(ok)
            apart = x[a, b]
            same = np.stack([((apart & np.array(m)) == 0).all(axis=1) for m in masks], axis=1) if len(a) else np.zeros((0, 0), bool)
            # The first table whose two blocks are equal.
            first = np.argmax(np.stack([same[:, p] & same[:, q] for p, q in kept], axis=1), axis=1) if len(a) else a
            a, b = a[first == table], b[first == table]
            for mine, other in [(i[a], right[b])] if low == high else [(i[a], right[b]), (right[b], i[a])]:
                np.add.at(n, mine, 1)
                np.minimum.at(near, mine, least[other])
        return n, near

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        name = None

        def told() -> pa.RecordBatch:
            n, near = counted(int(name[0].split(":")[0]), held)
            hit = n > 0
            prints = [f for f, h in zip(held["fingerprint"], hit, strict=True) if h]
            ids = pa.array(near[hit], pa.int64(), mask=near[hit] == NONE)
            return pa.RecordBatch.from_arrays([pa.array(prints, pa.string()), pa.array(n[hit]), ids], ["fingerprint", "n", "near_id"])

        for b in batches:
            columns = {c: b[c].to_pylist() for c in ("key", "low", "high", "tile", "fingerprint", "least")}
            for row in zip(*columns.values(), strict=True):
                if row[:3] != name:
                    if held:
                        yield told()
                    held, name = {c: [] for c in columns}, row[:3]
                for c, v in zip(columns, row, strict=True):
                    held[c].append(v)
        if held:
            yield told()

    found = placed.mapInArrow(stream, "fingerprint string, n bigint, near_id bigint")
    return found.groupBy("fingerprint").agg(F.sum("n").alias("n_near"), F.min("near_id").alias("near_id"))


def with_neighbours(prints: DataFrame, radius: int = 3) -> DataFrame:
    """All columns of a table with doc_id and fingerprint, and what the radius search finds for each row:
    ``n_near``, the number of other fingerprints within ``radius`` bits, and ``near_id``, the smallest doc_id
    of its own fingerprint and of these (null if none has an id).

    Texts without any word (fingerprint 0) are near to nothing. Copies count once; rows without doc_id are
    found but name nothing.
    """
    prints = stage(prints, "fingerprints")
    zero = "0" * (BITS // 4)
    distinct = prints.where(F.col("fingerprint") != zero).groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    found = neighbours(distinct, radius).withColumnRenamed("near_id", "other")
    known = distinct.join(found, "fingerprint", "left")
    known = known.select("fingerprint", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.least("least", "other").alias("near_id"))
    out = prints.join(known, "fingerprint", "left").fillna(0, "n_near")
    return out.select(*prints.columns, "n_near", F.coalesce("near_id", F.when(F.col("fingerprint") == zero, F.col("doc_id"))).alias("near_id"))


def edited_fingerprints(docs: DataFrame, parts_a_task: int = 4) -> DataFrame:
    """Fingerprints of every whole text and of its edited text.

    In the edited text the last half of the code points (rounded down) is replaced by the first as many
    (or all) of the next document by descending doc_id; the last document is followed by the first.
    Documents are dealt into ranges of doc_id and a hash of the text, and the first document of a range also
    goes, as a guest, to the range before it: texts are shuffled once, and every range streams in order.

    A null text is an empty one; a very long one is taken whole. Rows that share a doc_id follow each other
    by that hash, null ids come last, in as many ranges as they need; a document alone follows itself;
    repeated rows follow each other, the last of them by the next document. An empty table gives an empty
    one. Other columns are not looked at.
    """
    least = F.lit(NONE_BELOW).cast("bigint")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    rows = rows.withColumn("id", F.coalesce("doc_id", least)).withColumn("mark", F.xxhash64("text"))
    width = shuffle_width(docs.sparkSession)
    edges, tops = ranges(rows.select("id", "mark"), width * parts_a_task)
    order = sorted(tops, reverse=True)
    # Whose first document follows the last one of each range.
    leads = {tops[p]: order[i - 1] for i, p in enumerate(order)}

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series, marks: pd.Series) -> pd.Series:
        part = parts_of(edges, ids.to_numpy(), marks.to_numpy())
        return pd.Series([[int(p), leads.get((int(i), int(m)), -1)] for p, i, m in zip(part, ids, marks, strict=True)])

    dealt = (
        rows.withColumn("parts", places("id", "mark"))
        .select("doc_id", "id", "mark", "text", F.posexplode("parts").alias("guest", "part"))
        .where("part >= 0")
        .repartition(width, "part")
        .sortWithinPartitions("part", "guest", F.desc("id"), F.desc("mark"))
        .select("doc_id", "text", "guest")
    )

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held = Hasher(), None
        for b in batches:
            out = []
            for doc, text, guest in zip(*(b[c].to_pylist() for c in ("doc_id", "text", "guest")), strict=True):
                if guest and held is None:
                    continue  # one guest ends a range
                own = hasher.fingerprint(text)
                if held is not None:
                    before, whole, mark = held
                    half = len(whole) // 2
                    edited = whole[: len(whole) - half] + text[:half]
                    changed = hasher.fingerprint(edited)
                    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    near = likeness(mark, changed), likeness(mark, own)
                    out.append((before, len(whole), digest, mark.hex(), changed.hex(), *near))
                held = None if guest else (doc, text, own)
            columns = list(zip(*out, strict=True)) or [[]] * len(KINDS)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS.values(), strict=True)], list(KINDS))

    return dealt.mapInArrow(follow, ", ".join(f"{n} {SQL_NAMES[k]}" for n, k in KINDS.items()))
