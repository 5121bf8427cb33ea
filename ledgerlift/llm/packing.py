"""Best-fit packing of documents into sequences of a fixed number of tokens, under conflicts."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import whole_text

PACKED = "doc_id bigint, piece int, first_token bigint, n_tokens bigint, pack_id bigint, place bigint"
BIN_BITS = 32
COPIES_AT_ONCE = 1024


def word_count(text: Column) -> Column:
    """Tokens of a text: its words between ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


class Bins:
    """Open bins in order of residual, each with bitmaps of its sources and duplicate clusters.

    A source conflicts when a bin already holds ``per_source`` of its documents: level j of the source
    bitmaps has the bits of the sources seen more than j times. A cluster conflicts when its bit is set.
    """

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.order: list[int] = []  # residual << BIN_BITS | bin, sorted
        self.sources: list[list[int]] = []
        self.clusters: list[int] = []

    def fit(self, size: int, source: int, cluster: int, start: int) -> tuple[int, int, int]:
        """Put an item into the tightest compatible bin: (bin, place in it, where the search ended).

        The search runs up from the smallest residual that takes the item, or from ``start``: what an
        equal item has found in conflict stays in conflict, since bins only fill up.
        """
        at = bisect_left(self.order, max(size << BIN_BITS, start))
        while at < len(self.order):
            key = self.order[at]
            bin = key & ((1 << BIN_BITS) - 1)
            if not self.clusters[bin] & cluster and not self.sources[bin][-1] & source:
                del self.order[at]
                residual = key >> BIN_BITS
                self.put(bin, residual - size, source, cluster)
                return bin, self.capacity - residual, key
            at += 1
        end = self.order[-1] + 1 if self.order else 0
        bin = len(self.clusters)
        self.sources.append([0] * self.per_source)
        self.clusters.append(0)
        self.put(bin, self.capacity - size, source, cluster)
        return bin, 0, max(end, start)

    def put(self, bin: int, residual: int, source: int, cluster: int) -> None:
        self.clusters[bin] |= cluster
        levels = self.sources[bin]
        for j, level in enumerate(levels):
            if not level & source:
                levels[j] = level | source
                break
        insort(self.order, residual << BIN_BITS | bin)


def best_fit(items: list[tuple], capacity: int, per_source: int) -> list[tuple]:
    """Pack (size, cluster, source, id, piece, first) items, largest first: rows of item and (bin, place).

    Equal items follow each other, so that a group of copies walks over the bins once.
    """
    bins = Bins(capacity, per_source)
    repeated = {c for c, n in Counter(i[1] for i in items).items() if n > 1}
    bit: dict = {}
    out, last, start = [], None, 0
    for item in sorted(items, key=lambda i: (-i[0], i[1], i[2] is not None, i[2] or "", i[3] is not None, i[3] or 0, i[4])):
        size, cluster, source = item[:3]
        # Only clusters that occur again here can conflict; the others need no bit.
        cluster_bit = 1 << bit.setdefault(("c", cluster), len(bit)) if cluster in repeated else 0
        source_bit = 1 << bit.setdefault(("s", source), len(bit))
        same = (size, cluster_bit, source_bit)
        # A new bin of an equal item lies above the end of its search, and holds the item's cluster.
        bin, place, end = bins.fit(size, source_bit, cluster_bit, start if same == last and cluster_bit else 0)
        last, start = same, end
        out.append((*item, bin, place))
    return out


def with_copies(rows: DataFrame) -> DataFrame:
    """The rows, those that are alike numbered from 0 in ``copy``; counted before they move, so none gathers them."""
    counted = rows.groupBy(*rows.columns).agg((F.count(F.lit(1)) - 1).alias("_last"))
    runs = counted.withColumn("_run", F.explode(F.sequence(F.lit(0), F.floor(F.col("_last") / COPIES_AT_ONCE))))
    first = F.col("_run") * COPIES_AT_ONCE
    out = runs.withColumn("copy", F.explode(F.sequence(first, F.least("_last", first + COPIES_AT_ONCE - 1))))
    return out.drop("_last", "_run")


def pack(
    docs: DataFrame, capacity: int = 2048, per_source: int = 4, shard_docs: int = 2048, cluster: str | None = None,
    clusters: DataFrame | None = None,
) -> DataFrame:
    """Pack documents into bins of ``capacity`` tokens: one row per piece of a document.

    ``pack_id`` names the bin, ``place`` the piece's first token in it, ``first_token`` that in the
    document. No bin holds two pieces of one duplicate cluster nor more than ``per_source`` pieces of one
    source. ``cluster`` names the clusters' column, or ``clusters`` is a table of doc_id, text_hash and
    component_id as ``parity_join.with_components`` makes it; documents without either are in one cluster
    if their texts are equal. A document longer than a bin is cut into full pieces, each a bin of its own,
    and a rest that is packed like any other.

    Documents are dealt to shards of about ``shard_docs`` by a hash of their row and, of rows that are alike,
    their number, whatever their source or cluster, so no shard grows with a hot one; each shard is packed by
    itself, without its texts. Copies in different shards are in different bins anyway.

    A null or empty text has no tokens and takes a place without room; a null source is a source of its
    own; a null doc_id stays null; repeated rows are copies of each other; items of equal size follow each
    other by cluster, source and doc_id, so the result does not depend on the order of the input; an empty
    table packs to an empty one; columns that are not used may have any name.
    """
    if capacity < 1 or per_source < 1:
        raise ValueError("capacity and per_source must be at least 1")
    shards = max(1, -(-docs.count() // shard_docs))
    text = whole_text()
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(text).alias("tokens"),
        (F.col(cluster).cast("string") if cluster else F.lit(None).cast("string")).alias("cluster"),
        F.xxhash64(text).alias("text_hash"),
    )
    rows = with_copies(rows)
    if clusters is not None:
        found = clusters.where("component_id is not null").groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
        found = found.agg(F.min("component_id").alias("component_id"))
        rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left")
        rows = rows.withColumn("cluster", F.concat(F.lit("c"), F.col("component_id").cast("string")))
    rows = rows.select(
        "doc_id",
        "source",
        "tokens",
        F.coalesce("cluster", F.concat(F.lit("t"), F.col("text_hash").cast("string"))).alias("cluster"),
        F.pmod(F.xxhash64("doc_id", "text_hash", "copy"), F.lit(shards)).alias("shard"),
    )

    def one_shard(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        items, full = [], []
        columns = [table[c].to_pylist() for c in ("doc_id", "source", "tokens", "cluster")]
        for doc, source, tokens, group in zip(*columns, strict=True):
            pieces = max(0, (tokens - 1) // capacity)
            full += [(doc, p, p * capacity, capacity) for p in range(pieces)]
            items.append((tokens - pieces * capacity, group or "", source, doc, pieces, pieces * capacity))
        packed = best_fit(items, capacity, per_source)
        bins = 1 + max((p[-2] for p in packed), default=-1)
        base = shard << BIN_BITS
        out = [(i[3], i[4], i[5], i[0], base | i[6], i[7]) for i in packed]
        out += [(*f, base | bins + n, 0) for n, f in enumerate(full)]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        names = ("doc_id", "piece", "first_token", "n_tokens", "pack_id", "place")
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, zip(*out, strict=True), kinds, strict=True)})

    return rows.groupBy("shard").applyInArrow(one_shard, PACKED)
