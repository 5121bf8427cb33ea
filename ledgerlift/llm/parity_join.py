"""Near-duplicate documents by the Jaccard similarity of their word shingles: a parity-sketch join.

The shingles of a set are dealt into blocks, and each block is the XOR of its shingles' hashes. Two sets
differ in no more blocks than they differ in shingles, and sets that are similar enough differ in few
shingles, so one block of several shingles must be equal: sets are joined on their blocks, per band of
sizes. Bit sketches (the parity of the shingles that fall on each bit) then bound the difference from
below by their Hamming distance, and what is left is verified on the whole sets.

Copies collapse into one set first. Of the sets that share a block, one is compared with the others, and
sets that are then known to be connected are not compared again. What is still apart after some rounds is
compared pair by pair, first by the sketches, in tiles of bounded size. So a group of near copies costs
about one verification per member and round, and yet no link between two components is lost. Blocks that
have the same sets, as near copies have many, are one block with a weight.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameReader, Window
from pyspark.sql import functions as F

from ledgerlift.llm.common import (
    CLEANUP, delete, in_parts, pressed, setting, shuffle_width, small_batches, stage, stage_at, staging_path, unpressed, whole_text,
)
from ledgerlift.llm.components import components

REMEMBERED = 1 << 16
GROWTH = 1.35
#: Sets of one block that a task compares with as many others; larger blocks are cut into such tiles.
TILE = 4096
#: Pairs of each set that are verified first, where sketches leave many.
NEAREST = 2
#: Sets of a block that stays for another round though none of them was connected in the last one.
CROWD = 256
#: Sketch words that are compared at once.
WORDS_AT_ONCE = 1 << 21
#: A set finds fewer equal blocks than it needs with the chance of so many standard deviations.
SIGMAS = 6.0
FACTS = "doc_id bigint, text_hash bigint, n_shingles bigint, set bigint, sketch binary"
PACKS = "part int, names binary, tokens binary, places binary"
#: Bits of a block's key besides those that choose its part, keys that a task packs at once, and parts of
#: a task that reads them: a part's keys are held in memory. Two blocks of one key only cost a comparison.
KEY_BITS, KEYS_AT_ONCE, PARTS_A_TASK = 32, 1 << 20, 4
#: Bytes of texts that a task holds as Python objects at once.
TEXTS_AT_ONCE = 1 << 19

K1, K2, K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
LOW = np.uint64(0xFFFFFFFF)
#: Bytes of words, masks of the first bytes of eight, and the words that are hashed one by one.
IN_WORD = np.array([chr(i) not in " \t\n\v\f\r" for i in range(256)])
HELD = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
LONG_WORD = 64
S27, S30, S31, S32 = (np.uint64(n) for n in (27, 30, 31, 32))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> S30)
    x *= K2
    x ^= x >> S27
    x *= K3
    x ^= x >> S31
    return x


def firsts(values: np.ndarray) -> np.ndarray:
    """Which of the sorted values differ from the one before."""
    out = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=out[1:])
    return out


def word_hashes(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each word: its bytes by eights, the last ones with zeros, and its length; of long ones a digest."""
    padded = data + bytes(8)
    eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    out = sizes.astype(np.uint64) * K2
    short = sizes <= LONG_WORD
    rows = np.flatnonzero(short)
    for at in range(0, LONG_WORD, 8):
        rows = rows[sizes[rows] > at]
        if not len(rows):
            break
        held = eights[starts[rows] + at] & HELD[np.minimum(sizes[rows] - at, 8)]
        out[rows] = mixed(out[rows] * K1 + held)
    for k in np.flatnonzero(~short).tolist():
        word = data[starts[k] : starts[k] + sizes[k]]
        out[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest())
    return out


class Shingles:
    """Sets of word shingles as sorted 64-bit hashes."""

    def __init__(self, words: int):
        self.n = words

    def of(self, text: str) -> np.ndarray:
        """A-Z in lower case; words end at ASCII white space; a shorter text is one shingle."""
        return self.of_bytes(text.encode("utf-8", "surrogatepass"))

    def of_bytes(self, text: bytes) -> np.ndarray:
        return self.of_many([text])[0]

    def of_many(self, texts: list[bytes]) -> list[np.ndarray]:
        """The sets of some texts at once: a step over a short array takes as long as one over many of them."""
        data = b" ".join(texts).lower()
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = IN_WORD[np.frombuffer(data, np.uint8)]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        begin, size = edges[::2], edges[1::2] - edges[::2]
        hashes = word_hashes(data, begin, size)
        last = np.cumsum([len(text) + 1 for text in texts], dtype=np.int64)
        sizes = np.diff(np.searchsorted(begin, last), prepend=0)
        starts = np.cumsum(sizes) - sizes
        width = np.minimum(sizes, self.n)
        count = np.where(sizes > 0, sizes - width + 1, 0)
        # Windows that run into the next text are computed and left out.
        out = np.full(max(0, len(hashes) - self.n + 1), self.n, np.uint64)
        for i in range(self.n):
            out = mixed(out * K1 + hashes[i : i + len(out)])
        ends = np.cumsum(count)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - count), count)
        whole = np.repeat(sizes >= self.n, count)
        found = np.zeros(len(place), np.uint64)
        found[whole] = out[place[whole]]
        for k in np.flatnonzero((sizes > 0) & (sizes < self.n)).tolist():
            value = np.full(1, sizes[k], np.uint64)
            for i in range(starts[k], starts[k] + sizes[k]):
                value = mixed(value * K1 + hashes[i : i + 1])
            found[ends[k] - 1] = value[0]
        new = np.ones(len(found), bool)
        bounds = list(zip((ends - count).tolist(), ends.tolist(), strict=True))
        for x, y in bounds:
            found[x:y].sort()
        np.not_equal(found[1:], found[:-1], out=new[1:])
        new[(ends - count)[count > 0]] = True
        return [found[x:y][new[x:y]] for x, y in bounds]


def set_name(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), signed=True)


@dataclass(frozen=True)
class Band:
    """Sets of ``first`` to ``last`` shingles that may be the smaller of a pair, and how they are dealt."""

    number: int
    first: int
    last: int
    most: int  # shingles in which a pair can differ at most
    blocks: int
    full: int  # shingles that a block must have to be joined on


def most_different(small: int, percent: int) -> int:
    """In how many shingles a set of ``small`` and a larger one can differ and still be linked."""
    large = 100 * small // percent
    return (small + large) * (100 - percent) // (100 + percent)


def blocks_needed(size: int, most: int, full: int) -> int | None:
    """The fewest blocks of which more than ``most`` have ``full`` shingles, but for bad luck of SIGMAS."""
    blocks = most + 1
    while blocks <= 4 * size:
        x = size / blocks
        share = 1 - math.exp(-x) * (1 if full == 1 else 1 + x)
        spread = math.sqrt(blocks * share * (1 - share))
        if blocks * share - SIGMAS * spread >= most + 1:
            return blocks
        blocks = max(blocks + 1, int(blocks * 1.02))
    return None


@lru_cache(maxsize=16)
def bands(percent: int, largest: int) -> tuple[Band, ...]:
    """Bands of sizes up to ``largest``; smaller sets than the first band's are only linked when equal."""
    if percent == 100:
        return ()  # only equal sets are linked
    first = next(n for n in range(1, 1000) if most_different(n, percent) > 0)
    out: list[Band] = []
    while first <= largest:
        last = max(first, int(first * GROWTH) - 1)
        most = most_different(last, percent)
        # Two shingles to a block keep lines that many documents share from joining them; where sets are
        # too small for it one will do, and the smallest get so many blocks that nearly each is alone.
        full = 2
        blocks = blocks_needed(first, most, 2) if first >= 100 else None
        if blocks is None:
            full, blocks = 1, blocks_needed(first, most, 1) or 64 * first
        out.append(Band(len(out), first, last, most, blocks, full))
        first = last + 1
    return tuple(out)


def bands_of(size: int, percent: int) -> list[Band]:
    """The band of a set, and the one below if it holds sets small enough that may be linked with it."""
    held = bands(percent, 1 << max(8, size.bit_length()))
    return [b for b in held if b.first <= size and -(-percent * size // 100) <= b.last]


def block_keys(shingles: np.ndarray, band: Band) -> np.ndarray:
    """A key for each block with enough shingles: band, block and XOR of the hashes in one number."""
    return keys_of_many([shingles], [[band]])[0]


def keys_of_many(sets: list[np.ndarray], use: list[list[Band]]) -> list[np.ndarray]:
    """The ``block_keys`` of each set in all its bands, for some sets at once."""
    dealt = [(k, band) for k, held in enumerate(use) if len(sets[k]) for band in held]
    if not dealt:
        return [np.zeros(0, np.uint64) for _ in sets]
    owner = np.array([k for k, _ in dealt])
    number, blocks, full = (np.array([getattr(band, c) for _, band in dealt], np.uint64) for c in ("number", "blocks", "full"))
    salts = [(number + np.uint64(1)) * k for k in (K1, K2)]
    first = np.cumsum(blocks) - blocks  # blocks of all are numbered on
    shingles = np.concatenate([sets[k] for k, _ in dealt])
    each = np.repeat(np.arange(len(dealt)), [len(sets[k]) for k, _ in dealt])
    spot = mixed(shingles + salts[0][each]) >> S32
    block = ((spot * blocks[each]) >> S32) + first[each]
    # Block and place in one number: sorting numbers is faster than ordering them.
    placed = (block << S32) | np.arange(len(block), dtype=np.uint64)
    placed.sort()
    block, place = placed >> S32, (placed & LOW).astype(np.int64)
    starts = np.flatnonzero(firsts(block))
    size = np.diff(starts, append=len(block)).astype(np.uint64)
    parity = np.bitwise_xor.reduceat(shingles[place], starts)
    each = each[place[starts]]
    held = size >= full[each]
    parity, each, block = parity[held], each[held], block[starts[held]]
    keys = mixed(mixed(parity + salts[1][each]) + (block - first[each]) * K1)
    cuts = np.searchsorted(owner[each], np.arange(len(sets) + 1)).tolist()
    return [keys[x:y] for x, y in zip(cuts, cuts[1:])]


def sketch_bits(size: int, percent: int) -> int:
    return 1 << max(6, min(16, (8 * most_different(size, percent)).bit_length()))


def parity_sketch(shingles: np.ndarray, bits: int) -> bytes:
    """Bit i is the parity of the number of shingles that fall on it; halving XORs the two halves."""
    return sketches_of_many([shingles], [bits])[0]


def sketches_of_many(sets: list[np.ndarray], bits: list[int]) -> list[bytes]:
    """The ``parity_sketch`` of each set, for some sets at once."""
    if not sets:
        return []
    ends = np.cumsum(bits)
    sizes = [len(s) for s in sets]
    spots = mixed(np.concatenate(sets) ^ K3) & np.repeat(np.array(bits, np.uint64) - np.uint64(1), sizes)
    spots = spots.astype(np.int64) + np.repeat(ends - bits, sizes)
    packed = np.packbits(np.bincount(spots, minlength=ends[-1]) & 1 == 1).tobytes()
    return [packed[(end - size) // 8 : end // 8] for end, size in zip(ends.tolist(), bits, strict=True)]


def sketch_distance(a: bytes, b: bytes) -> int:
    """The Hamming distance of two sketches at the size of the smaller: at most what the sets differ in."""
    if len(a) < len(b):
        a, b = b, a
    x = int.from_bytes(a)
    size = len(a)
    while size > len(b):
        size //= 2
        x = (x >> 8 * size) ^ (x & ((1 << 8 * size) - 1))
    return (x ^ int.from_bytes(b)).bit_count()


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = np.concatenate([a, b])
    both.sort(kind="stable")  # merges the two
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= percent * (len(both) - shared)


def packed_keys(keys: np.ndarray, place: np.ndarray, names: np.ndarray, parts: int) -> dict[str, list]:
    """Keys of blocks, and the places of their sets in ``names``, as one row of packed numbers per part."""
    part = (keys % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)
    order = np.argsort(part, kind="stable")
    token = (keys[order] >> np.uint64(64 - KEY_BITS)).astype("<u4")
    place, part = place[order], part[order]
    out: dict[str, list] = {"part": [], "names": [], "tokens": [], "places": []}
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]][: len(part)])
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)], strict=True):
        own, at = np.unique(place[a:b], return_inverse=True)
        out["part"].append(int(part[a]))
        out["names"].append(names[own].tobytes())
        out["tokens"].append(token[a:b].tobytes())
        out["places"].append(at.astype("<u2" if len(own) <= 1 << 16 else "<u4").tobytes())
    return out


def unpacked_keys(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and sets of packed rows."""
    tokens, sets = [], []
    for r in rows:
        tokens.append(np.frombuffer(r["tokens"], "<u4").astype(np.int64))
        names = np.frombuffer(r["names"], np.int64)
        sets.append(names[np.frombuffer(r["places"], "<u2" if len(names) <= 1 << 16 else "<u4")])
    return np.concatenate(tokens), np.concatenate(sets)


def shingle_sets(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame, Callable[[], None]]:
    """Two staged tables made in one pass over the texts, and a function that deletes the second.

    The first has one row per document: the number of its shingles, its set's id and the set's bit sketch.
    The second has the keys of the sets' blocks, packed into rows of one part each. A task that sees a set
    again leaves both out, so that copies do not multiply them.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    rows = rows.withColumns({"text_hash": F.xxhash64("text"), "size": F.octet_length("text")})
    parts = PARTS_A_TASK * shuffle_width(docs.sparkSession)
    facts, packs = ([c.split()[0] for c in x.split(", ")] for x in (FACTS, PACKS))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def whole(columns: dict[str, list | pa.Array], n: int) -> pa.RecordBatch:
        """A row is of one table; the columns of the other are null."""
        arrays = [columns[c] if c in columns else pa.nulls(n, k) for c, k in zip([*facts, *packs], kinds, strict=True)]
        arrays = [a if isinstance(a, pa.Array) else pa.array(a, k) for a, k in zip(arrays, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(["part" in columns] * n, pa.bool_()), *arrays], ["packed", *facts, *packs])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = Shingles(words), set()
        held: list[np.ndarray] = []
        names: list[int] = []

        def pack() -> pa.RecordBatch:
            place = np.repeat(np.arange(len(held)), [len(k) for k in held])
            out = packed_keys(np.concatenate(held), place, np.array(names, np.int64), parts)
            return whole(out, len(out["part"]))

        waiting = 0
        for b in (part for all in batches for part in in_parts(all, all["size"].to_numpy(), TEXTS_AT_ONCE)):
            found = shingles.of_many(b["text"].cast(pa.binary()).to_pylist())
            size = [len(s) for s in found]
            number: list[int | None] = []
            use: list[list[Band]] = []
            for s in found:
                name = set_name(s)
                number.append(name if len(s) else None)
                fresh = name not in seen
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(name)
                use.append(bands_of(len(s), percent) if fresh and len(s) else [])
            drawn = [k for k, held_in in enumerate(use) if held_in]
            sketch: list[bytes | None] = [None] * len(found)
            bits = [sketch_bits(size[k], percent) for k in drawn]
            for k, drawing in zip(drawn, sketches_of_many([found[k] for k in drawn], bits), strict=True):
                sketch[k] = drawing
            for name, keys in zip(number, keys_of_many(found, use), strict=True):
                if len(keys):
                    held.append(keys)
                    names.append(name)
                    waiting += len(keys)
                if waiting >= KEYS_AT_ONCE:
                    yield pack()
                    held.clear(), names.clear()
                    waiting = 0
            columns = [b["doc_id"], b["text_hash"], size, number, sketch]
            yield whole(dict(zip(facts, columns, strict=True)), b.num_rows)
        if held:
            yield pack()

    path = staging_path(docs.sparkSession, "shingles")
    with setting(docs.sparkSession, CLEANUP, "true"):
        rows.mapInArrow(sets, f"packed boolean, {FACTS}, {PACKS}").write.partitionBy("packed").parquet(path)
    read = docs.sparkSession.read
    tables = [_kind(read, path, kind, schema) for kind, schema in (("false", FACTS), ("true", PACKS))]
    return *tables, lambda: delete(docs.sparkSession, f"{path}/packed=true")


def _kind(read: DataFrameReader, path: str, kind: str, schema: str) -> DataFrame:
    """The rows of one kind; a table without any has no folder."""
    return read.schema(f"{schema}, packed boolean").parquet(path).where(f"packed = {kind}").drop("packed")


def shared_blocks(packs: DataFrame) -> DataFrame:
    """(block, set, weight) for blocks of at least two sets; weight is the number of blocks with the same sets.

    ``block`` is a hash of the block's sets: blocks of the same sets connect nothing that one of them does not.
    """
    rows = packs.repartition(shuffle_width(packs.sparkSession), "part").sortWithinPartitions("part")

    def shared(held: list[dict]) -> pa.RecordBatch:
        token, item = unpacked_keys(held)
        order = np.argsort(token)
        token = token[order]
        same = token[1:] == token[:-1]
        several = np.r_[False, same] | np.r_[same, False]
        token, item = token[several], item[order[several]]
        order = np.lexsort((item, token))
        token, item = token[order], item[order]
        new = np.r_[True, (token[1:] != token[:-1]) | (item[1:] != item[:-1])][: len(token)]
        token, item = token[new], item[new]
        starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]][: len(token)])
        size = np.diff(np.r_[starts, len(token)])
        starts, size = starts[size > 1], size[size > 1]
        block, one, weight = np.unique(block_names(item, starts, size), return_index=True, return_counts=True)
        starts, size = starts[one], size[one]
        ends = np.cumsum(size)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - size), size)
        return pa.RecordBatch.from_pydict(
            {"block": np.repeat(block, size), "set": item[place], "weight": np.repeat(weight.astype(np.int64), size)}
        )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for b in batches:
            for row in b.to_pylist():
                if held and held[0]["part"] != row["part"]:
                    yield shared(held)
                    held = []
                held.append(row)
        if held:
            yield shared(held)

    found = rows.mapInArrow(stream, "block bigint, set bigint, weight bigint")
    return found.groupBy("block", "set").agg(F.sum("weight").alias("weight"))


def block_names(item: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of the distinct sets of each block: ``size`` items from ``starts`` on."""
    if not len(starts):
        return np.zeros(0, np.int64)
    sums = np.r_[np.uint64(0), np.cumsum(mixed(item.astype(np.int64).view(np.uint64) + K1))]
    return mixed(sums[starts + size] - sums[starts] + size.astype(np.uint64) * K3).view(np.int64)


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set, size, text compressed) of the wanted (doc_id, text_hash, set); the doc_id may be null.

    Compressed texts are a third of their shingles' hashes, which have no redundancy. A set has a second
    row if another text of its document has the same hash; ``verified`` leaves that one out.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), whole_text().alias("text"))
    rows = pressed(rows.withColumn("hash", F.xxhash64("text")))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
    # Rows without doc_id, or that repeat theirs, may be many copies of one text.
    return rows.join(wanted, same).select("set", "size", "text").distinct()


def tiled(rows: DataFrame) -> DataFrame:
    """Rows of blocks with the pair of tiles they take part in: ``low`` and ``high``, and their own ``tile``."""
    sizes = rows.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    own = rows.join(sizes, "block").withColumn("tile", F.pmod(F.xxhash64("set"), F.col("tiles")).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return other.select(
        *rows.columns, "tile", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high")
    )


def close_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets that share a block, have different labels, and are near by size and sketch, with
    ``apart``, in how many bits their sketches differ.

    ``rows`` has block, set, label, n and sketch. Every pair of tiles of a block is compared in one task.
    """
    width = shuffle_width(rows.sparkSession)
    placed = tiled(rows).repartition(width, "block", "low", "high").sortWithinPartitions("block", "low", "high")

    def folded(sketches: list[bytes]) -> np.ndarray:
        size = min(map(len, sketches))
        out = np.empty((len(sketches), size // 8), np.uint64)
        for i, x in enumerate(sketches):
            halves = np.frombuffer(x, np.uint64).reshape(-1, size // 8)
            out[i] = np.bitwise_xor.reduce(halves)
        return out

    def near(group: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        label, n, tile, low, high, name = (group[c] for c in ("label", "n", "tile", "low", "high", "set"))
        words = folded(group["sketch"])
        left = np.flatnonzero(tile == low[0])
        right = left if low[0] == high[0] else np.flatnonzero(tile == high[0])
        found = []
        step = max(1, WORDS_AT_ONCE // max(1, len(right) * words.shape[1]))
        for at in range(0, len(left), step):
            i = left[at : at + step, None]
            both = n[i] + n[right]
            apart = np.bitwise_count(words[i] ^ words[right]).sum(axis=2, dtype=np.int64)
            ok = (label[i] != label[right]) & (apart <= both * (100 - percent) // (100 + percent))
            ok &= 100 * np.minimum(n[i], n[right]) >= percent * np.maximum(n[i], n[right])
            if left is right:
                ok &= i < right
            x, y = np.nonzero(ok)
            found.append((name[i[x, 0]], name[right[y]], apart[x, y]))
        x, y, d = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (name[:0], name[:0], name[:0])
        return np.minimum(x, y), np.maximum(x, y), d

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        name = None

        def pairs(group: dict) -> Iterator[pa.RecordBatch]:
            whole = {c: np.concatenate(v) if c != "sketch" else sum(v, []) for c, v in group.items()}
            found = np.stack(near(whole), axis=1)
            if len(found):
                # A pair shares many blocks: what this task has given out lately is not given out again.
                told = set(map(tuple, found.tolist())) - given
                if len(given) > REMEMBERED:
                    given.clear()
                given.update(told)
                columns = zip(*told, strict=True) if told else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "apart"])

        given: set[tuple[int, int, int]] = set()

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {c: batch[c].to_numpy() for c in ("block", "low", "high", "tile", "set", "label", "n")}
            sketch = batch["sketch"].to_pylist()
            key = np.stack([columns[c] for c in ("block", "low", "high")])
            starts = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)])
            for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                here = tuple(key[:, start].tolist())
                if here != name:
                    if held:
                        yield from pairs(held)
                    held, name = {c: [] for c in (*columns, "sketch")}, here
                for c, v in columns.items():
                    held[c].append(v[start:end])
                held["sketch"].append(sketch[start:end])
        if held:
            yield from pairs(held)

    # Sketches of different sizes are compared at the smaller one, so tiles may differ in what they see.
    found = placed.mapInArrow(stream, "a bigint, b bigint, apart bigint")
    return found.groupBy("a", "b").agg(F.max("apart").alias("apart"))


def near_pairs(pairs: DataFrame, info: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of sets that may be linked, by their sizes and sketches, as ``close_pairs`` judges."""

    def side(name: str) -> DataFrame:
        return info.select(F.col("set").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n", "sketch")])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = np.stack([b["n_a"].to_numpy(), b["n_b"].to_numpy()])
            most = n.sum(axis=0) * (100 - percent) // (100 + percent)
            apart = map(sketch_distance, b["sketch_a"].to_pylist(), b["sketch_b"].to_pylist())
            keep = 100 * n.min(axis=0) >= percent * n.max(axis=0)
            keep &= np.fromiter(apart, np.int64, b.num_rows) <= most
            yield b.select(["a", "b"]).filter(pa.array(keep))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(check, "a bigint, b bigint")


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of sets that are linked, by the whole sets, which are made again from the texts."""

    def side(name: str) -> DataFrame:
        return texts.select(F.col("set").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("size", "text")])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)

        def sizes(b: pa.RecordBatch) -> np.ndarray:
            return b["size_a"].to_numpy() + b["size_b"].to_numpy()

        for b in (part for all in batches for part in in_parts(all, sizes(all), TEXTS_AT_ONCE)):
            # A hub has many pairs: its set is made once.
            texts: dict[tuple[int, bytes], int] = {}
            for x in "ab":
                for name, size, text in zip(*(b[c].to_pylist() for c in (x, f"size_{x}", f"text_{x}")), strict=True):
                    texts.setdefault((name, text), size)
            made = shingles.of_many([unpressed(text, size) for (_, text), size in texts.items()])
            sets = {name: s for (name, _), s in zip(texts, made, strict=True) if set_name(s) == name}
            ends = zip(b["a"].to_pylist(), b["b"].to_pylist(), strict=True)
            keep = [x in sets and y in sets and linked(sets[x], sets[y], percent) for x, y in ends]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(check, "a bigint, b bigint")


def linked_sets(docs: DataFrame, sets: DataFrame, shared: DataFrame, names: DataFrame, words: int, percent: int, rounds: int) -> DataFrame | None:
    """(set, label) for all sets that share a block with another, or None if there are none."""
    if shared.isEmpty():
        return None
    some = stage(shared.select("set").distinct(), "shared")
    info = sets.where("sketch is not null").groupBy("set").agg(F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    info = stage(info.join(some, "set"), "info")
    texts, texts_path = stage_at(texts_of(docs, names.join(some, "set")), "texts")
    labels = some.select("set", F.col("set").alias("label"))

    def split(rows: DataFrame) -> DataFrame:
        """Blocks whose sets are not all connected yet, with the new labels."""
        rows = rows.join(labels, "set")
        ends = rows.groupBy("block").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        return rows.join(ends.select("block"), "block")

    def still_moving(rows: DataFrame) -> DataFrame:
        """The split blocks of which a set got another label, or that are large: the others wait for ``close_pairs``."""
        rows = split(rows.withColumnRenamed("label", "was"))
        moved = rows.groupBy("block").agg(F.max(F.col("label") != F.col("was")).alias("moved"), F.count(F.lit(1)).alias("size"))
        return rows.drop("was").join(moved.where(F.col("moved") | (F.col("size") > CROWD)).select("block"), "block")

    def with_hubs(rows: DataFrame, used: DataFrame | None) -> DataFrame:
        """(a, b): each set and, of the hubs it meets, the one it shares most blocks with.

        The hub of a block is the set that meets most others in all its blocks, which is the one the rest
        of a group of near copies are nearest to; hubs of earlier turns are passed over.
        """
        size = rows.groupBy("block").agg(F.count(F.lit(1)).alias("size"))
        met = rows.join(size, "block").groupBy("set").agg(F.sum(F.col("size") * F.col("weight")).alias("met"))
        ranked = rows.join(met if used is None else met.join(used, "set", "left_anti"), "set")
        hubs = ranked.groupBy("block").agg(F.max_by(F.struct("set", "label"), F.struct("met", "set")).alias("hub"))
        pairs = rows.join(hubs, "block").where("label <> hub.label").select("set", F.col("hub.set").alias("hub"), "weight")
        counted = pairs.groupBy("set", "hub").agg(F.sum("weight").alias("n"))
        return counted.groupBy("set").agg(F.max_by("hub", F.struct("n", "hub")).alias("b")).withColumnRenamed("set", "a")

    def merged(pairs: DataFrame) -> DataFrame:
        links = stage(verified(pairs, texts, words, percent), "links")
        a, b = (labels.select(F.col("set").alias(x), F.col("label").alias(f"label_{x}")) for x in "ab")
        ends = links.join(a, "a").join(b, "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
        groups = components(ends.where("a <> b").distinct()).select(F.col("node").alias("label"), F.col("label").alias("to"))
        return stage(labels.join(groups, "label", "left").select("set", F.coalesce("to", "label").alias("label")), "merged")

    used = None
    rows = shared.withColumn("label", F.col("set"))
    for turn in range(rounds):
        if turn:
            rows = stage(still_moving(rows), "moving")
            if rows.isEmpty():
                break
        pairs = stage(with_hubs(rows, used), "hubs")
        hubs = pairs.select(F.col("b").alias("set")).distinct()
        used = hubs if used is None else used.unionByName(hubs).distinct()
        labels = merged(near_pairs(pairs, info, percent))
    rows = split(shared).drop("weight")
    pairs = stage(close_pairs(rows.join(info, "set"), percent), "close")
    most = NEAREST
    while True:
        # The nearest pairs of every set come first: what they connect needs no others.
        a, b = (labels.select(F.col("set").alias(x), F.col("label").alias(f"label_{x}")) for x in "ab")
        apart = pairs.join(a, "a").join(b, "b").where("label_a <> label_b").select("a", "b", "apart")
        turns = [F.row_number().over(Window.partitionBy(x).orderBy("apart", y)).alias(f"turn_{x}") for x, y in ("ab", "ba")]
        apart = stage(apart.select("*", *turns), "open")
        if apart.isEmpty():
            break
        now = (F.col("turn_a") <= most) | (F.col("turn_b") <= most)
        labels = merged(apart.where(now).select("a", "b"))
        pairs, most = apart.where(~now).select("a", "b", "apart"), 4 * most
    # The labels are staged, or those of the sets themselves: the texts have no readers left.
    delete(docs.sparkSession, texts_path)
    return labels


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, rounds: int = 3) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, as ``with_components`` finds them."""
    return with_components(docs, words, percent, rounds).select("doc_id", "n_shingles", "component_id")


def with_components(docs: DataFrame, words: int, percent: int, rounds: int = 3) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, component_id.

    Two documents are linked when the intersection of their sets of ``words``-word shingles is at least
    ``percent`` % of the union; component_id is the smallest doc_id that links lead to, the document's own
    included. A text of fewer words is one shingle; a text without words (or null) has none and is linked
    with nothing. Repeated rows are linked like any copies; a row without doc_id is linked but names no
    component, and has none if nothing else is in it. An empty table gives an empty one; other columns are
    not looked at.

    Blocks may miss a link with a chance below 1e-8 per set (``SIGMAS``), two different sets, or the sets of
    two different blocks, may share an id with n^2 / 2^65; all are accidents of 64-bit hashes, not of the data.
    """
    if not 0 < percent <= 100 or words < 1:
        raise ValueError("percent must be in 1..100 and words at least 1")
    with small_batches(docs.sparkSession):
        return _with_components(docs, words, percent, rounds)


def _with_components(docs: DataFrame, words: int, percent: int, rounds: int) -> DataFrame:
    sets, packs, drop_packs = shingle_sets(docs, words, percent)
    shared = stage(shared_blocks(packs), "blocks")
    drop_packs()
    # The row that stands for a set: that of the smallest doc_id, or any if none has one.
    row = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("row")
    names = sets.where("set is not null").groupBy("set").agg(row).select("set", "row.doc_id", "row.text_hash")
    names = stage(names, "names")
    labels = linked_sets(docs, sets, shared, names, words, percent, rounds)
    owned = names.select("set", F.col("doc_id").alias("component_id"))
    if labels is not None:
        least = names.join(labels, "set").groupBy("label").agg(F.min("doc_id").alias("least"))
        wide = labels.join(least, "label").select("set", "least")
        owned = owned.join(wide, "set", "left").select("set", F.coalesce("least", "component_id").alias("component_id"))
    out = sets.select("doc_id", "text_hash", "n_shingles", "set").join(owned, "set", "left")
    own = F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_hash", "n_shingles", own.alias("component_id"))


def representatives(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, in the columns it came with: the one of the smallest doc_id.

    Documents without any word are linked with nothing and stay. Of rows that repeat a doc_id and its text
    one stays. A row without doc_id stays unless it is linked with one that has an id.
    """
    lowest = F.lit(-(2**63)).cast("bigint")
    found = with_components(docs, words, percent).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = found.select(F.coalesce("doc_id", lowest).alias("id"), F.col("text_hash").alias("hash")).distinct()
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("bigint"), lowest).alias("id"),
        F.xxhash64(whole_text()).alias("hash"),
    )
    again = Window.partitionBy("id", "hash").orderBy("id")
    kept = rows.join(chosen, ["id", "hash"]).withColumn("copy", F.row_number().over(again)).where("copy = 1")
    return kept.select("row.*")
