"""Repeated byte strings across documents, by range-partitioned suffixes.

A string of LENGTH bytes that occurs twice holds, at the same offset in both places, the gram of its bytes
with the smallest hash. Only suffixes that start at such an anchor are compared, about one position in 18.
Those whose anchor occurs in one document alone are left out; the others are range-partitioned by their
leading bytes with sampled splitters, and each range sorts its suffixes (and, backwards, what stands
before them) by multikey quicksort. Equal runs of the two orders are the equal strings around an anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import in_parts, pressed, shuffle_width, stage, unpressed, whole_text

GRAM = 16
#: Documents that the splitters are drawn from, and suffixes of each. They decide the balance, not the result.
SAMPLE_DOCS, SAMPLE_SUFFIXES = 2000, 64
#: Suffixes of one anchor that a task compares at once; beyond it they are compared string by string.
MOST_SUFFIXES = 500_000
RANGES_A_TASK = 4
#: Bytes of texts whose suffixes a task makes at once.
TEXTS_AT_ONCE = 1 << 23
#: Bytes of texts that a task cuts at once.
CUT_AT_ONCE = 1 << 19
#: Bits of an anchor's hash that say whether documents share it, besides those that choose its part.
TOKEN_BITS = 40
PACKED = ("part", "names", "tokens", "docs", "several", "told_tokens", "told_docs")

U = np.uint64
K1, K2, K3 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * K2
    x = (x ^ (x >> U(27))) * K3
    return x ^ (x >> U(31))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on."""
    eight = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))
    words = np.ascontiguousarray(eight).view(U).ravel()
    n = len(data) - GRAM + 1
    return mixed(mixed(words[:n] * K1) + words[8 : 8 + n])


def window_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose gram is the smallest of some string of ``length`` bytes, all hashes, each string's smallest."""
    none = np.zeros(0, U)
    if len(data) < length:
        return np.zeros(0, np.int64), none, none
    hashes = gram_hashes(data)
    width = length - GRAM + 1
    least = window_min(hashes, width)
    # A gram is some string's smallest if it equals the largest of those strings' smallest.
    edge = np.full(width - 1, ~U(0))
    largest = ~window_min(np.r_[edge, ~least, edge], width)
    return np.flatnonzero(largest == hashes), hashes, least


def big_endian_words(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of numbers that sort like them; padded with zeros at the end."""
    width = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((len(rows), width), np.uint8)
    padded[:, : rows.shape[1]] = rows
    return padded.view(">u8").astype(U)


def multikey_order(words: np.ndarray) -> np.ndarray:
    """The order of rows of words: sorted by the first, equal runs by the next, and so on."""
    order = np.argsort(words[:, 0], kind="stable")
    same = np.r_[False, words[order[1:], 0] == words[order[:-1], 0]] if len(order) else np.zeros(0, bool)
    for w in range(1, words.shape[1]):
        run = np.cumsum(~same)
        tied = np.flatnonzero(same | np.r_[same[1:], False])
        if not len(tied):
            break
        part = order[tied]
        # Places of a run stay within it: sort by (run, word).
        inner = np.lexsort((words[part, w], run[tied]))
        order[tied] = part[inner]
        same[1:] &= words[order[1:], w] == words[order[:-1], w]
    return order


def common_prefix(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many bytes each row of the order shares with the one before (0 for the first)."""
    a, b = rows[order[1:]], rows[order[:-1]]
    differs = a != b
    size = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    return np.r_[0, size]


def runs(shared: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """For each row the number of its run of rows that share ``least`` bytes."""
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(shared < least)
    return number


def repeated_strings(before: np.ndarray, after: np.ndarray, own: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """Per suffix the offsets (bits) of its strings that also occur around a suffix of a smaller id.

    ``before`` holds the bytes before each anchor, nearest first, ``after`` those from it on, ``own`` the
    offsets of the strings whose anchor it is: bit d for the string that starts d bytes before it.
    """
    out = np.zeros(len(ids), np.int64)
    right, left = (multikey_order(big_endian_words(x)) for x in (after, before))
    right_shared, left_shared = common_prefix(after, right), common_prefix(before, left)
    for d in range(length - GRAM + 1):
        rows = np.flatnonzero(own >> d & 1)
        if len(rows) < 2:
            continue
        key = runs(right_shared, right, length - d)[rows] * (len(ids) + 1) + runs(left_shared, left, d)[rows]
        order = np.lexsort((ids[rows], key))
        first = np.r_[True, key[order[1:]] != key[order[:-1]]]
        least = ids[rows][order][np.flatnonzero(first)[np.cumsum(first) - 1]]
        later = ids[rows][order] > least
        out[rows[order[later]]] |= 1 << d
    return out


def suffix_rows(data: np.ndarray, place: np.ndarray, hashes: np.ndarray, least: np.ndarray, length: int) -> tuple:
    """Of anchors: the bytes around each as fixed rows (before it, from it on) and its own offsets as bits."""
    width = length - GRAM + 1
    start = place[:, None] - np.arange(width)
    there = (start >= 0) & (start < len(least))
    owned = there & (least[np.where(there, start, 0)] == hashes[place][:, None])
    own = (owned.astype(np.int64) << np.arange(width)).sum(axis=1)
    padded = np.r_[np.zeros(width - 1, np.uint8), data, np.zeros(length, np.uint8)]
    at = np.arange(width - 1 + length)
    around = padded[place[:, None] + at]
    # Bytes outside its own strings are never compared; as zeros they pack well.
    far, near = (np.log2(x).astype(np.int64)[:, None] for x in (own.astype(np.float64), (own & -own).astype(np.float64)))
    around[(at < width - 1 - far) | (at >= width - 1 - near + length)] = 0
    return around, own


def strings_of(around: np.ndarray, own: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, list[bytes]]]:
    """(offset, rows, digests) of each suffix's own strings."""
    width = length - GRAM + 1
    for d in range(width):
        rows = np.flatnonzero(own >> d & 1)
        cut = around[rows, width - 1 - d : width - 1 - d + length]
        yield d, rows, [hashlib.blake2b(r.tobytes(), digest_size=16).digest() for r in cut]


def removed(size: int, spots: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """Changes of depth, from place to place, of the strings that start ``offset`` bits before their anchors."""
    edge = np.zeros(size + 1, np.int32)
    row, d = np.nonzero(offsets[:, None] >> np.arange(length - GRAM + 1) & 1)
    start = spots[row] - d
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length, -1)
    return edge


def without_marks(texts: list[bytes], marks: pa.ListArray, copy: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of some texts the bytes removed, the maximal runs of them, and what is left; of copies all is removed."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    base = ends - sizes
    # The texts lie one after the other; no string leaves its own.
    held = marks.flatten()
    spots, offsets = (x.to_numpy() for x in held.flatten())
    number = pc.fill_null(pc.list_value_length(marks), 0).to_numpy()
    edge = removed(len(data), spots + np.repeat(base, number), offsets, length)
    np.add.at(edge, base[copy], 1)
    np.add.at(edge, ends[copy], -1)
    gone = np.cumsum(edge, dtype=np.int32)[:-1] > 0
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    starts = base[sizes > 0]
    begins[starts] = gone[starts]
    n_removed, n_spans = (np.diff(np.r_[0, np.cumsum(x)][np.r_[0, ends]]) for x in (gone, begins))
    left = np.r_[0, np.cumsum(sizes - n_removed)].astype(np.int32)
    kept = pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(left), pa.py_buffer(data[~gone].tobytes())])
    return n_removed, n_spans, kept


def buffer(text: str | bytes) -> np.ndarray:
    return np.frombuffer(text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass"), np.uint8)


def fixed_rows(column: pa.Array, size: int) -> np.ndarray:
    """A column of equally long byte strings as rows of bytes, without copying."""
    column = column.cast(pa.binary())
    start = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    flat = np.frombuffer(column.buffers()[2], np.uint8)[start : start + len(column) * size]
    return flat.reshape(len(column), size)


def five_bytes(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : TOKEN_BITS // 8].tobytes()


def from_five_bytes(data: bytes) -> np.ndarray:
    short = np.frombuffer(data, np.uint8).reshape(-1, TOKEN_BITS // 8)
    out = np.zeros((len(short), 8), np.uint8)
    out[:, : TOKEN_BITS // 8] = short
    return out.view("<u8").ravel().astype(np.int64)


def packed_anchors(hashes: np.ndarray, docs: np.ndarray, names: np.ndarray, parts: int) -> pa.RecordBatch:
    """Anchors of a batch of documents, packed into one row per part (hash modulo ``parts``).

    ``docs`` are the documents' places in ``names``, rows of doc_id and hash of the text. A part gets every
    anchor once: its token, a document that has it, and whether another doc_id of the batch has it too.
    All documents of anchors that several in the batch have are told apart, as ``told`` tokens and documents,
    so one that a third of all documents hold is one entry per batch to sort. Tokens are the upper bits of
    the hash; two anchors of one token only cost a needless comparison.
    """
    order = np.argsort(hashes)
    hashes, docs = hashes[order], docs[order]
    ids = names[docs, 0]
    starts = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)])
    size = np.diff(np.r_[starts, len(hashes)])
    if len(starts):
        several = np.minimum.reduceat(ids, starts) != np.maximum.reduceat(ids, starts)
    else:
        several = np.zeros(0, bool)
    # Documents of one doc_id may differ in their texts, so all documents of an anchor are told.
    told = np.repeat(size > 1, size)
    out: dict[str, list] = {name: [] for name in PACKED}
    part, told_part = (hashes[starts] % U(parts)).astype(np.int64), (hashes[told] % U(parts)).astype(np.int64)
    by_part, by_told = np.argsort(part, kind="stable"), np.argsort(told_part, kind="stable")
    cuts, told_cuts = (np.searchsorted(x, np.arange(parts + 1)) for x in (part[by_part], told_part[by_told]))
    tokens, token_docs = hashes[starts] >> U(64 - TOKEN_BITS), docs[starts]
    told_tokens, told_docs = hashes[told] >> U(64 - TOKEN_BITS), docs[told]
    for p in range(parts):
        mine, also = by_part[cuts[p] : cuts[p + 1]], by_told[told_cuts[p] : told_cuts[p + 1]]
        if not len(mine):
            continue
        own, place = np.unique(np.r_[token_docs[mine], told_docs[also]], return_inverse=True)
        place = place.astype("<u2" if len(own) <= 1 << 16 else "<u4")
        out["part"].append(p)
        out["names"].append(names[own].tobytes())
        out["tokens"].append(five_bytes(tokens[mine]))
        out["docs"].append(place[: len(mine)].tobytes())
        out["several"].append(np.packbits(several[mine]).tobytes())
        out["told_tokens"].append(five_bytes(told_tokens[also]))
        out["told_docs"].append(place[len(mine) :].tobytes())
    return pa.RecordBatch.from_pydict({n: pa.array(v, pa.int32() if n == "part" else pa.binary()) for n, v in out.items()})


def shared_tokens(rows: list[dict]) -> pa.RecordBatch:
    """(id, hash, token) of all anchors of one part that at least two doc_ids hold."""
    token, doc, several, known = [], [], [], []
    for r in rows:
        names = np.frombuffer(r["names"], np.int64).reshape(-1, 2)
        kind = "<u2" if len(names) <= 1 << 16 else "<u4"
        token.append(from_five_bytes(r["tokens"]))
        doc.append(names[np.frombuffer(r["docs"], kind)])
        several.append(np.unpackbits(np.frombuffer(r["several"], np.uint8), count=len(token[-1])).astype(bool))
        known.append((names[np.frombuffer(r["told_docs"], kind)], from_five_bytes(r["told_tokens"])))
    token, doc, several = (np.concatenate(x) for x in (token, doc, several))
    order = np.argsort(token)
    token, doc, several = token[order], doc[order], several[order]
    starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
    ids = doc[:, 0]
    shared = np.minimum.reduceat(ids, starts) != np.maximum.reduceat(ids, starts)
    shared |= np.logical_or.reduceat(several, starts)
    out = np.repeat(shared, np.diff(np.r_[starts, len(token)]))
    held = token[starts][shared]
    names, tokens = [doc[out]], [token[out]]
    for docs, own in known:
        at = np.minimum(np.searchsorted(held, own), max(0, len(held) - 1))
        wanted = held[at] == own if len(held) else np.zeros(len(own), bool)
        names.append(docs[wanted])
        tokens.append(own[wanted])
    names, tokens = np.concatenate(names), np.concatenate(tokens)
    return pa.RecordBatch.from_pydict({"id": names[:, 0], "hash": names[:, 1], "token": tokens})


def settled_here(ids: np.ndarray, own: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Suffixes of which a smaller id has an equal one in these rows, so that all their strings go.

    They need not be compared any more: whatever a third of all documents say costs one row per batch.
    """
    width = -(-around.shape[1] // 8)
    words = np.zeros((len(ids), 8 * width), np.uint8)
    words[:, : around.shape[1]] = around
    words = words.view("<u8")
    name = mixed(own.astype(U) * K1)
    for w in range(width):
        name = mixed((name ^ words[:, w]) * K1)
    order = np.lexsort((ids, name))
    name = name[order]
    first = np.maximum.accumulate(np.where(np.r_[True, name[1:] != name[:-1]], np.arange(len(name)), 0))
    same = (words[order] == words[order[first]]).all(axis=1) & (own[order] == own[order[first]])
    out = np.zeros(len(ids), bool)
    out[order] = same & (ids[order] > ids[order[first]])
    return out


def splitters(rows: DataFrame, n: int, length: int) -> np.ndarray:
    """Leading words of suffixes that cut a bounded sample of them into ``n`` about equal parts."""
    total = max(1, rows.count())

    def leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b["text"].to_pylist():
                data = buffer(text)
                place = anchors(data, length)[0]
                place = place[:: max(1, len(place) // SAMPLE_SUFFIXES)][:SAMPLE_SUFFIXES]
                out += [int.from_bytes(data[p : p + 8].tobytes()) - 2**63 for p in place]
            yield pa.RecordBatch.from_pydict({"lead": pa.array(out, pa.int64())})

    sample = rows.sample(min(1.0, SAMPLE_DOCS / total), seed=7)
    found = sample.select("text").mapInArrow(leads, "lead bigint").toPandas()["lead"].to_numpy()
    found = np.sort((found.astype(np.int64) ^ np.int64(-(2**63))).view(U))
    return found[np.arange(1, n) * len(found) // n] if len(found) else np.zeros(0, U)


def remove_repeats(docs: DataFrame, length: int = 50, most: int = MOST_SUFFIXES) -> DataFrame:
    """Every document's bytes less those covered by a ``length``-byte string that a smaller doc_id holds too.

    Columns: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the bytes left). Overlaps
    count, strings are judged on the whole input texts, and never cross documents.

    A whole text that a smaller doc_id has too is settled first, so copies cost nothing further. Texts are
    shuffled twice, compressed. A suffix that a smaller doc_id of its batch has, with all that its strings span, is settled
    before the exchange. Different suffixes of an anchor that more than ``most`` have are not gathered in a
    task: their strings are compared by a join on 128-bit digests, which the adaptive join splits where hot.

    A null text is an empty one; a null doc_id counts as the smallest; rows that share a doc_id are not
    compared with each other, and each is judged by its own text; a very long text is judged whole; texts
    shorter than ``length`` stay whole; repeated rows have the same result; an empty table gives an empty
    one; other columns are not looked at.
    """
    if not GRAM < length <= GRAM + 62:
        raise ValueError(f"length must be in {GRAM + 1}..{GRAM + 62}")
    lowest = F.lit(-(2**63)).cast("bigint")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), lowest).alias("id"), whole_text().alias("text"))
    # Rows of one doc_id are told apart by their texts; rows without doc_id may be a third of the table.
    rows = rows.withColumn("hash", F.xxhash64("text"))
    width = shuffle_width(docs.sparkSession)
    n_ranges = width * RANGES_A_TASK
    cuts = splitters(rows, n_ranges, length)
    span = length - GRAM + 1

    named = rows.where(F.octet_length("text") >= length).select("id", "hash", F.sha2("text", 256).alias("digest"))
    first = named.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    copies = named.join(first.select("digest", "first"), "digest").where("id > first")
    copies = stage(copies.select("id", "hash").distinct(), "copies")

    def own_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, seen = [], None
            for i, h, size, text in zip(*(b[c].to_pylist() for c in ("id", "hash", "size", "text")), strict=True):
                # Rows come in order of their names: of repeated ones one will do.
                place, hashes, _ = anchors(buffer(unpressed(text, size) if seen != (i, h) else b""), length)
                found.append(np.unique(hashes[place]))
                seen = (i, h)
            if found:
                at = np.repeat(np.arange(len(found)), [len(f) for f in found])
                names = np.stack([b["id"].to_numpy(), b["hash"].to_numpy()], axis=1)
                yield packed_anchors(np.concatenate(found), at, names, width)

    def shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for b in batches:
            for row in b.to_pylist():
                if held and held[0]["part"] != row["part"]:
                    yield shared_tokens(held)
                    held = []
                held.append(row)
        if held:
            yield shared_tokens(held)

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in in_parts(whole, whole["size"].to_numpy(), TEXTS_AT_ONCE)):
            parts, seen = [], None
            columns = (*(b[c].to_pylist() for c in ("id", "hash", "size", "text")), b["shared"])
            for i, h, size, text, wanted in zip(*columns, strict=True):
                if seen == (i, h):
                    continue
                seen = (i, h)
                data = buffer(unpressed(text, size))
                place, hashes, least = anchors(data, length)
                token = (hashes[place] >> U(64 - TOKEN_BITS)).astype(np.int64)
                place = place[np.isin(token, wanted.values.to_numpy())]
                if not len(place):
                    continue
                around, own = suffix_rows(data, place, hashes, least, length)
                lead = np.ascontiguousarray(around[:, span - 1 : span + 7]).view(">u8").ravel().astype(U)
                low, high = np.searchsorted(cuts, lead, "left"), np.searchsorted(cuts, lead, "right")
                anchor = hashes[place]
                # A leading word that fills several ranges is spread over them by its anchor.
                part = low + (anchor % (high - low + 1).astype(U)).astype(np.int64)
                parts.append((part.astype(np.int32), np.full(len(place), i), np.full(len(place), h), place, own, around))
            if parts:
                columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
                around = columns.pop()
                done = settled_here(columns[1], columns[4], around)
                # What is settled only passes through, spread by its place; the rest is compared.
                columns[0][done] = (mixed(columns[2][done].astype(U) + columns[3][done].astype(U)) % U(n_ranges)).astype(np.int32)
                order = np.r_[np.flatnonzero(done), np.flatnonzero(~done)]
                n, size = int(done.sum()), around.shape[1]
                flat = around[order[n:]].tobytes()
                ends = np.r_[np.zeros(n, np.int32), np.arange(len(order) - n + 1, dtype=np.int32) * size]
                held = pa.BinaryArray.from_buffers(pa.binary(), len(order), [None, pa.py_buffer(ends), pa.py_buffer(flat)])
                arrays = [*(pa.array(c[order]) for c in columns), held]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "id", "hash", "spot", "own", "around"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by range and anchor: whole anchors are gathered up to ``most`` rows, then compared.

        Rows without bytes around them are settled already.
        """
        held: list[tuple] = []
        size = 0
        hot = None  # the anchor that has turned out to have too many suffixes

        def out(ids, hashes, spot, offsets, digest=None):
            return pa.RecordBatch.from_pydict(
                {
                    "id": pa.array(ids, pa.int64()),
                    "hash": pa.array(hashes, pa.int64()),
                    "spot": pa.array(spot, pa.int64()),
                    "offsets": pa.array(offsets, pa.int64()),
                    "digest": pa.array(digest if digest is not None else [None] * len(ids), pa.binary()),
                }
            )

        def settle(rows: list[tuple]) -> pa.RecordBatch:
            _, ids, hashes, spot, own, around = (np.concatenate(c) for c in zip(*rows, strict=True))
            before, after = around[:, : span - 1][:, ::-1], around[:, span - 1 :]
            bits = repeated_strings(before, after, own, ids, length)
            hit = bits != 0
            return out(ids[hit], hashes[hit], spot[hit], bits[hit])

        def undecided(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            for _, ids, hashes, spot, own, around in rows:
                for d, at, digests in strings_of(around, own, length):
                    yield out(ids[at], hashes[at], spot[at], np.full(len(at), 1 << d, np.int64), digests)

        for b in batches:
            done = pc.equal(pc.binary_length(b["around"]), 0)
            if pc.any(done).as_py():
                told = b.filter(done)
                yield out(told["id"], told["hash"], told["spot"], told["own"])
                b = b.filter(pc.invert(done))
            if not b.num_rows:
                continue
            flat = fixed_rows(b["around"], span - 1 + length)
            anchor = np.ascontiguousarray(flat[:, span - 1 : span - 1 + GRAM]).view("S%d" % GRAM).ravel()
            columns = [anchor, *(b[c].to_numpy() for c in ("id", "hash", "spot", "own"))]
            starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
            for start, end in zip(starts, [*starts[1:], len(anchor)], strict=True):
                rows = (*(c[start:end] for c in columns), flat[start:end])
                name = anchor[start]
                same = bool(held) and held[-1][0][-1] == name
                if hot is not None and name == hot:
                    yield from undecided([rows])
                    continue
                hot = None
                if held and not same and size >= most // 4:
                    yield settle(held)
                    held, size = [], 0
                held.append(rows)
                size += end - start
                if size > most:
                    # Only the last anchor's rows can have brought it there.
                    own_rows = [r for r in held if r[0][0] == name]
                    rest = [r for r in held if r[0][0] != name]
                    if rest:
                        yield settle(rest)
                    held, size = own_rows, sum(len(r[0]) for r in own_rows)
                    if size > most:
                        yield from undecided(held)
                        held, size, hot = [], 0, name
        if held:
            yield settle(held)

    # The same exchange of the texts, compressed, serves the first two joins.
    name = ["id", "hash"]
    rows = pressed(rows)
    originals = rows.join(copies, name, "left_anti").select("id", "hash", "size", "text")
    blobs = originals.mapInArrow(own_anchors, ", ".join(f"{n} {'int' if n == 'part' else 'binary'}" for n in PACKED))
    shared = blobs.repartition(width, "part").sortWithinPartitions("part")
    shared = shared.mapInArrow(shared_anchors, "id bigint, hash bigint, token bigint")
    wanted = shared.groupBy(*name).agg(F.collect_list("token").alias("shared"))
    placed = rows.join(wanted, name).select("id", "hash", "size", "text", "shared").mapInArrow(
        suffixes, "part int, id bigint, hash bigint, spot bigint, own bigint, around binary"
    )
    gram = F.substring("around", span, GRAM)
    ranged = placed.repartition(width, "part").sortWithinPartitions("part", gram)
    judged = ranged.select("id", "hash", "spot", "own", "around").mapInArrow(
        compare, "id bigint, hash bigint, spot bigint, offsets bigint, digest binary"
    )
    # Read three times below, compared once.
    judged = stage(judged, "judged")
    late = judged.where("digest is not null")
    least = late.groupBy("digest").agg(F.min("id").alias("least"))
    settled = late.join(least, "digest").where("id > least").select("id", "hash", "spot", "offsets")
    marks = judged.where("digest is null").select("id", "hash", "spot", "offsets").unionByName(settled)
    none = F.lit(None).cast("bigint")
    whole = copies.select("id", "hash", none.alias("spot"), none.alias("offsets"), F.lit(True).alias("copy"))
    marks = marks.withColumn("copy", F.lit(False)).unionByName(whole)
    marks = marks.groupBy(*name).agg(
        F.collect_list(F.when(F.col("spot").isNotNull(), F.struct("spot", "offsets"))).alias("marks"),
        F.max("copy").alias("copy"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        for b in (part for whole in batches for part in in_parts(whole, whole["size"].to_numpy(), CUT_AT_ONCE)):
            texts = list(map(unpressed, b["text"].to_pylist(), b["size"].to_pylist()))
            copy = pc.fill_null(b["copy"], False).to_numpy(zero_copy_only=False)
            n_removed, n_spans, kept = without_marks(texts, b["marks"], copy, length)
            ids = b["id"].to_numpy()
            arrays = [pa.array(ids, mask=ids == -(2**63)), b["size"], pa.array(n_removed), pa.array(n_spans), kept]
            yield pa.RecordBatch.from_arrays(arrays, names)

    joined = rows.join(marks, name, "left")
    return joined.mapInArrow(cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
