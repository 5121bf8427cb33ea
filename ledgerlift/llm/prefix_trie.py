"""The prefix trie of conversations, from range-partitioned panels of turns.

A conversation is a row of turn ids, cut into panels of a fixed width; a panel also has the key of the turns
before it. Panels are range-partitioned and sorted by key, turns and conversation. A batch of them is a
padded matrix: it is sorted with lexsort, a cell that differs from the row above changes all cells to its
right (an accumulated or), and a change in a column starts a node there, whose members reduceat sums up.
Nodes that a batch or a shard cuts through come out in parts with the same key, and are put together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import shuffle_width, stage

#: Shared turns are at most SHARED of the conversation that a family starts with.
SHARED, FAMILY = 5, 100
PAD = np.iinfo(np.int64).min
U = np.uint64
#: The key of turns t1, t2, ... is the sum of ti * STEP^i modulo 2^64; STEP is odd and so has an inverse.
STEP = 0x9E3779B97F4A7C15
MODULUS = 1 << 64
NODE = ("depth", "key")
PARTS = (
    "depth bigint, key bigint, parent bigint, conv_id bigint, n bigint, chars bigint, path bigint, "
    "shared bigint, leaves bigint, first_shared bigint, ends_from bigint, ends string"
)


def power(exponent: int) -> np.uint64:
    return U(pow(STEP, exponent, MODULUS))


def powers(n: int) -> np.ndarray:
    """STEP^0 to STEP^n."""
    return np.cumprod(np.r_[U(1), np.full(n, U(STEP))], dtype=U)


def number(part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to sorted turns, within each conversation of this partition: place, key and code points so far."""
    held, place, key, cum = None, 0, U(0), 0
    for b in batches:
        if not b.num_rows:
            continue
        conv, turn, chars = (b[c].to_numpy() for c in ("conv_id", "t", "chars"))
        starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
        size = np.diff(np.r_[starts, len(conv)])
        goes_on = held is not None and conv[0] == held
        base = np.zeros(len(starts), np.int64)
        base_key, base_cum = np.zeros(len(starts), U), np.zeros(len(starts), np.int64)
        if goes_on:
            base[0], base_key[0], base_cum[0] = place, key, cum
        offset = np.arange(len(conv)) - np.repeat(starts, size) + 1
        scale = np.ones(len(starts), U)
        scale[0] = power(int(base[0]))
        terms = turn.astype(U) * powers(int(size.max()))[offset] * np.repeat(scale, size)
        sums, lengths = np.cumsum(terms, dtype=U), np.cumsum(chars)
        keys = sums - np.repeat(sums[starts] - terms[starts] - base_key, size)
        cums = lengths - np.repeat(lengths[starts] - chars[starts] - base_cum, size)
        places = offset + np.repeat(base, size)
        held, place, key, cum = conv[-1], int(places[-1]), keys[-1], int(cums[-1])
        columns = [conv, np.full(len(conv), part), places, turn, chars, keys.view(np.int64), cums]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["conv_id", "part", "place", "t", "chars", "key", "cum"])


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), t (the turn's id), chars, key and cum (both up to this turn) of every turn.

    Turns are sorted over all partitions, so a conversation may be longer than any of them: where it goes
    on from one into the next, the place, key and length so far are added, one entry per partition.
    """
    spark = conversations.sparkSession
    width = shuffle_width(spark)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", *text)
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    sorted_rows = rows.repartitionByRange(width, *order).sortWithinPartitions(*order)
    ids = sorted_rows.select(
        "conv_id",
        F.greatest(F.xxhash64("role", "text"), F.lit(int(PAD) + 1)).alias("t"),
        F.char_length("text").cast("bigint").alias("chars"),
    )
    schema = "conv_id bigint, part bigint, place bigint, t bigint, chars bigint, key bigint, cum bigint"
    turns = stage(ids.mapInArrow(lambda batches: number(TaskContext.get().partitionId(), batches), schema), "turns")

    ends = turns.groupBy("part").agg(F.min("conv_id").alias("first"), F.max("conv_id").alias("last")).collect()
    over = {r.first for r in ends} & {r.last for r in ends}
    cut = turns.where(F.col("conv_id").isin(*over)) if over else turns.limit(0)
    last = cut.groupBy("conv_id", "part").agg(*[F.max_by(c, "place").alias(c) for c in ("key", "cum")], F.max("place").alias("n"))
    # By partition, for the conversation that it begins with: what earlier partitions hold of it.
    before: dict[int, tuple[int, int, int, int]] = {}
    state, conv = (0, 0, 0), None
    for r in sorted(last.collect(), key=lambda r: (r.conv_id, r.part)):
        if r.conv_id != conv:
            state, conv = (0, 0, 0), r.conv_id
        elif state[0]:
            before[r.part] = (conv, *state)
        n, key, cum = state
        state = (n + r.n, (key + r.key * pow(STEP, n, MODULUS)) % MODULUS, cum + r.cum)

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            conv, part, place, key, cum = (b[c].to_numpy() for c in ("conv_id", "part", "place", "key", "cum"))
            place, key, cum = place.copy(), key.astype(U), cum.copy()
            for p in np.unique(part).tolist():
                if p in before:
                    name, n, own, length = before[p]
                    at = (part == p) & (conv == name)
                    place[at] += n
                    key[at] = key[at] * power(n) + U(own)
                    cum[at] += length
            arrays = [b["conv_id"], pa.array(place), b["t"], b["chars"], pa.array(key.view(np.int64)), pa.array(cum)]
            yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "place", "t", "chars", "key", "cum"])

    return turns.mapInArrow(shift, "conv_id bigint, place bigint, t bigint, chars bigint, key bigint, cum bigint")


def rebuilt(turns: DataFrame) -> DataFrame:
    """One row per conversation: how it is put together from the first turns of its family and its own.

    ``head`` holds the first turns of the family's first conversation, as many as the checksum says,
    ``cut`` the own turns that they stand in for.
    """
    first = F.when(F.col("place") <= SHARED, F.struct("place", "t", "chars", "key", "cum"))
    convs = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("own"), F.max("cum").alias("own_cum"), F.sort_array(F.collect_list(first)).alias("own_head")
    )
    convs = stage(convs, "conversations")
    family = convs.select(F.col("conv_id").alias("family"), F.col("own_head").alias("family_head"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(SHARED + 1)).cast("int")
    rows = convs.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY).join(family, "family", "left")
    rows = rows.withColumn("h", h).withColumn("cut", F.least("h", "own").cast("int"))
    rows = rows.withColumn("head", F.coalesce(F.slice("family_head", F.lit(1), F.col("h")), F.slice("own_head", 1, 0)))

    def last(list: str, n: Column, field: str) -> Column:
        return F.when(n > 0, F.get(F.col(list), n - 1)[field]).otherwise(F.lit(0))

    shared = F.size("head")
    return rows.select(
        "conv_id",
        "head",
        "cut",
        shared.alias("shared_turns"),
        (shared + F.col("own") - F.col("cut")).alias("turns"),
        *[last("head", shared, c).alias(f"head_{c}") for c in ("key", "cum")],
        *[last("own_head", F.col("cut"), c).alias(f"cut_{c}") for c in ("key", "cum")],
        (last("head", shared, "cum") + F.col("own_cum") - last("own_head", F.col("cut"), "cum")).alias("total"),
    )


def panels(turns: DataFrame, plan: DataFrame, width: int) -> DataFrame:
    """conv_id, panel, before (key), chars_before, ids, sizes (code points) and last, one row per panel.

    Every conversation has panel 0, also one without turns. A panel gathers ``width`` turns at most.
    """
    none = F.lit(None)
    constants = ("shared_turns", "cut", "head_key", "head_cum", "cut_key", "cut_cum")
    own = turns.join(plan.drop("head", "total"), "conv_id").where("place > cut")
    own = own.withColumn("depth", F.col("shared_turns") + F.col("place") - F.col("cut"))
    start = F.when(
        (F.col("depth") > 1) & ((F.col("depth") - 1) % width == 0), F.struct("place", "t", "chars", "key", "cum", *constants)
    )
    own = own.select("conv_id", "turns", "depth", F.struct("depth", "t", "chars").alias("turn"), start.alias("start"))
    empty = own.schema["start"].dataType
    head = plan.select("conv_id", "turns", F.explode_outer("head").alias("x"))
    head = head.withColumn("depth", F.coalesce("x.place", F.lit(1)))
    turn = F.when(F.col("x").isNotNull(), F.struct("depth", F.col("x.t").alias("t"), F.col("x.chars").alias("chars")))
    head = head.select("conv_id", "turns", "depth", turn.alias("turn"), none.cast(empty).alias("start"))
    rows = own.unionByName(head).withColumn("panel", ((F.col("depth") - 1) / width).cast("bigint"))
    held = rows.groupBy("conv_id", "panel").agg(
        F.sort_array(F.collect_list("turn")).alias("held"), F.first("start", True).alias("start"), F.first("turns").alias("turns")
    )
    flat = held.select(
        "conv_id",
        "panel",
        *[F.col(f"start.{c}").alias(c) for c in ("place", "t", "chars", "key", "cum", *constants)],
        F.transform("held", lambda x: x["t"]).alias("ids"),
        F.transform("held", lambda x: x["chars"]).alias("sizes"),
        (F.col("turns") <= (F.col("panel") + 1) * width).alias("last"),
    )

    def before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = {n: b[n].fill_null(0).to_numpy(zero_copy_only=False) for n in ("place", "t", "chars", "key", "cum", *constants)}
            k = {n: c[n].astype(U) for n in ("t", "key", "head_key", "cut_key")}
            ahead = k["key"] - k["t"] * np.array([power(int(p)) for p in c["place"]], U) - k["cut_key"]
            moved = np.array([power(int(s) - int(x)) for s, x in zip(c["shared_turns"], c["cut"], strict=True)], U)
            later = b["panel"].to_numpy() > 0
            key = np.where(later, k["head_key"] + ahead * moved, U(0))
            length = np.where(later, c["head_cum"] + c["cum"] - c["chars"] - c["cut_cum"], 0)
            arrays = [b["conv_id"], b["panel"], pa.array(key.view(np.int64)), pa.array(length), b["ids"], b["sizes"], b["last"]]
            yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "panel", "before", "chars_before", "ids", "sizes", "last"])

    schema = "conv_id bigint, panel bigint, before bigint, chars_before bigint, ids array<bigint>, sizes array<bigint>, last boolean"
    return flat.mapInArrow(before, schema)


def padded(lists: pa.Array, width: int, fill: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists of numbers as rows of a matrix, and their lengths."""
    ends = lists.offsets.to_numpy()
    size = np.diff(ends)
    out = np.full((len(size), width), fill, np.int64)
    out[np.arange(width) < size[:, None]] = lists.values.to_numpy()[ends[0] : ends[-1]]
    return out, size


def nodes_of(b: pa.RecordBatch, width: int) -> pa.RecordBatch:
    """The nodes (or parts of nodes) of a batch of panels, and who ends at each."""
    conv, panel, before, chars_before, shared, leaves = (
        b[c].to_numpy() for c in ("conv_id", "panel", "before", "chars_before", "shared", "leaves")
    )
    last = b["last"].to_numpy(zero_copy_only=False)
    w = max(1, int(np.diff(b["ids"].offsets.to_numpy()).max(initial=0)))
    ids, size = padded(b["ids"], w, PAD)
    chars, _ = padded(b["sizes"], w, 0)
    order = np.lexsort((conv, *ids.T[::-1], before, panel))
    conv, panel, before, chars_before, shared, leaves, last, ids, size, chars = (
        x[order] for x in (conv, panel, before, chars_before, shared, leaves, last, ids, size, chars)
    )
    # Column 0 is what stands before the panel; a change there or to the left starts a node.
    lead = np.r_[True, (panel[1:] != panel[:-1]) | (before[1:] != before[:-1])]
    change = np.concatenate([lead[:, None], np.r_[np.ones((1, w), bool), ids[1:] != ids[:-1]]], axis=1)
    change = np.logical_or.accumulate(change, axis=1)
    scale = {int(p): power(int(p) * width) for p in np.unique(panel)}
    terms = ids.astype(U) * powers(w)[1:] * np.array([scale[int(p)] for p in panel], U)[:, None]
    keys = np.concatenate([before.astype(U)[:, None], before.astype(U)[:, None] + np.cumsum(terms, axis=1, dtype=U)], axis=1)
    keys = keys.view(np.int64)
    path = chars_before[:, None] + np.cumsum(chars, axis=1)
    found: list[tuple] = []
    for j in range(w + 1):
        # Panel 0 also has the root; later panels begin with a node that the panel before has.
        rows = np.flatnonzero(panel == 0) if j == 0 else np.flatnonzero(size >= j)
        if not len(rows):
            continue
        starts = np.flatnonzero(change[rows, j])
        first = rows[starts]
        least = np.minimum.reduceat(conv[rows], starts)
        n = np.diff(np.r_[starts, len(rows)])
        group = np.repeat(np.arange(len(starts)), n)
        at_least = np.zeros(len(starts), np.int64)
        of_least = conv[rows] == least[group]
        at_least[group[of_least]] = shared[rows][of_least]
        own = chars[first, j - 1] if j else np.zeros(len(first), np.int64)
        depth = panel[first] * width + j
        parent = keys[first, j - 1] if j else np.zeros(len(first), np.int64)
        ahead = path[first, j - 1] - own if j else np.zeros(len(first), np.int64)
        sums = [np.add.reduceat(x[rows], starts) for x in (shared, leaves)]
        found.append((depth, keys[first, j], parent, least, n, own, ahead, *sums, at_least))
    columns = [np.concatenate(c) for c in zip(*found, strict=True)]
    # Those that end at a node follow each other, by conversation.
    rows = np.flatnonzero(last)
    stop = panel[rows] * width + size[rows]
    name = keys[rows, size[rows]]
    starts = np.flatnonzero(np.r_[True, (stop[1:] != stop[:-1]) | (name[1:] != name[:-1])][: len(rows)])
    told = [",".join(map(str, x.tolist())) for x in np.split(conv[rows], starts[1:])] if len(rows) else []
    none = np.zeros((len(columns), len(starts)), np.int64)
    none[0], none[1], none[3] = stop[starts], name[starts], conv[rows][starts]
    columns = [np.r_[c, x] for c, x in zip(columns, none, strict=True)]
    nodes = len(columns[0]) - len(starts)
    root = columns[0] == 0
    arrays = [pa.array(c, pa.int64(), mask=root if i == 2 else None) for i, c in enumerate(columns)]
    arrays.append(pa.array([None] * nodes + conv[rows][starts].tolist(), pa.int64()))
    arrays.append(pa.array([None] * nodes + told, pa.string()))
    return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in PARTS.split(", ")])


def node_parts(cut: DataFrame, width: int) -> DataFrame:
    """Parts of nodes, and parts of the lists of those that end there (n is 0), from weighted panels."""
    order = ("panel", "before", "ids", "conv_id")
    shards = cut.repartitionByRange(shuffle_width(cut.sparkSession), *order).sortWithinPartitions(*order)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield nodes_of(b, width)

    return shards.mapInArrow(stream, PARTS)


def ends_digests(parts: DataFrame) -> DataFrame:
    """Per node the digest of the comma-joined conversations that end there; the parts stream in order."""
    told = parts.where("ends is not null").select(*NODE, "ends_from", "ends")
    told = told.repartition(shuffle_width(parts.sparkSession), *NODE).sortWithinPartitions(*NODE, "ends_from")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sha, out = None, None, []

        def batch() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], [*NODE, "ends_sha256"])

        for b in batches:
            for depth, key, ends in zip(*(b[c].to_pylist() for c in (*NODE, "ends")), strict=True):
                if (depth, key) == held:
                    sha.update(f",{ends}".encode())
                    continue
                if held is not None:
                    out.append((*held, sha.hexdigest()))
                held, sha = (depth, key), hashlib.sha256(ends.encode())
            if out:
                yield batch()
                out = []
        if held is not None:
            out.append((*held, sha.hexdigest()))
            yield batch()

    return told.mapInArrow(digest, "depth bigint, key bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame, width: int = 32) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations, the root included.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (over the subtree, (n_convs - 1) times the code points of the last text) and
    ``ends_sha256`` (of the members that end at the node).

    Two passes over the panels: the first finds the nodes, and so how many code points each conversation
    shares with smaller ones; what a subtree saves is the sum of these over its members, less what lies
    above it. Only neighbouring nodes are joined, whatever the depth. A panel has ``width`` turns, more than
    conversations of a family share.

    Turns with equal numbers come in order of role and text; repeated turns are turns; null turns come
    first; a null role or text is empty; rows without conv_id take no part; a conversation of any length
    is cut into panels; an empty table has no nodes; other columns are not looked at. Two different turns
    have one id, or two nodes one key, with a chance of n^2 / 2^65.
    """
    if width <= SHARED:
        raise ValueError(f"width must be above {SHARED}")
    turns = numbered_turns(conversations)
    plan = stage(rebuilt(turns), "rebuilt")
    cut = stage(panels(turns, plan, width), "panels")
    zero = F.lit(0).cast("bigint")
    parts = node_parts(cut.withColumns({"shared": zero, "leaves": zero}), width).where("n > 0")
    nodes = parts.groupBy(*NODE).agg(
        F.sum("n").alias("n"),
        F.min("conv_id").alias("conv_id"),
        *[F.first(c).alias(c) for c in ("parent", "chars", "path")],
    )
    nodes = stage(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("key"))
    nodes = nodes.join(children.agg(F.count(F.lit(1)).alias("n_children")), [*NODE], "left")
    nodes = stage(nodes.fillna(0, "n_children"), "nodes")

    alone = nodes.groupBy("conv_id").agg(F.sum("chars").alias("alone"), F.count_if(F.col("n_children") == 0).alias("leaves"))
    weights = plan.select("conv_id", "total").join(alone, "conv_id", "left").fillna(0, ["alone", "leaves"])
    weights = weights.select("conv_id", (F.col("total") - F.col("alone")).alias("shared"), "leaves")
    parts = stage(node_parts(cut.join(weights, "conv_id"), width), "parts")
    sums = parts.where("n > 0").groupBy(*NODE).agg(
        *[F.sum(c).alias(c) for c in ("shared", "leaves")], F.min_by("first_shared", "conv_id").alias("first_shared")
    )
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(sums, [*NODE]).join(above, ["depth", "parent"], "left").join(ends_digests(parts), [*NODE], "left")
    saved = F.col("shared") - F.col("first_shared") - (F.col("n") - 1) * F.col("path")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        "n_children",
        F.col("leaves").alias("n_leaves"),
        saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
