"""SentencePiece encoding and decoding of whole texts with a given byte-pair model.

Texts become words (runs that no piece of the vocabulary crosses), and the words that a task has not seen
yet are encoded together: their characters lie in one flat array of symbols, cut into segments. Every
round finds the smallest rank of a pair in each segment, merges its occurrences from the left, and takes
the segments out that have no pair left, until none remains.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlift.llm.common import in_parts, whole_text

SPACE = "▁"
#: Words whose ids a process remembers, and the longest word worth remembering. They decide the speed only.
REMEMBERED, LONGEST_REMEMBERED = 1 << 18, 64
#: Characters that are merged at once, and bytes of texts that are split at once, but for a longer word or text.
CHARS_AT_ONCE, TEXTS_AT_ONCE = 1 << 17, 1 << 20
#: Ids that become texts at once, but for a longer line.
IDS_AT_ONCE = 1 << 18
#: Symbols of a segment from which on merges that must follow each other are taken from a queue.
QUEUED = 128
NONE = np.iinfo(np.int32).max
#: Fixed values of the model format: fields of its messages and kinds of pieces.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a serialised protocol message: number and value."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return out

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) if kind != 2 else number()
        if size is None:
            raise ValueError("not a SentencePiece model")
        yield tag >> 3, data[at : at + size]
        at += size


class Lookup:
    """Numbers of 63 bits to numbers: a hash table in flat arrays, asked for many at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(4, (8 * len(keys)).bit_length()))
        self.keys = np.full((1 << 64 - int(self.shift)) + len(keys) + 1, -1, np.int64)
        self.values = np.full(len(self.keys), -1, np.int64)
        slot = self.slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] < 0)
            chosen = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[chosen]], self.values[slot[chosen]] = keys[chosen], values[chosen]
            rest = np.ones(len(keys), bool)
            rest[chosen] = False
            keys, values, slot = keys[rest], values[rest], slot[rest] + 1

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, or -1."""
        slot = self.slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], -1)
        left = np.flatnonzero((there != keys) & (there >= 0))
        slot = slot[left]
        while len(left):
            slot = slot + 1
            there = self.keys[slot]
            hit = there == keys[left]
            out[left[hit]] = self.values[slot[hit]]
            on = ~hit & (there >= 0)
            left, slot = left[on], slot[on]
        return out


class Pieces:
    """A byte-pair model: its vocabulary, its pairs, and texts to ids and back."""

    def __init__(self, model: bytes):
        pieces, trainer, normalizer = [], {}, {}
        for field, value in message(model):
            if field == PIECES:
                pieces.append(dict(message(value)))
            elif field == TRAINER:
                trainer = dict(message(value))
            elif field == NORMALIZER:
                normalizer = dict(message(value))
        names = [p[1].decode("utf-8") for p in pieces]
        scores = np.array([np.frombuffer(p.get(2, bytes(4)), "<f4")[0] for p in pieces], np.float32)
        kinds = np.array([p.get(3, NORMAL) for p in pieces])
        if trainer.get(3, 1) != 2 or np.isin(kinds, (USER_DEFINED, UNUSED)).any() or trainer.get(24, 0):
            raise ValueError("only byte-pair models without user-defined or unused pieces are read")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("only models that leave the text as it is are read")
        self.prefix = SPACE if normalizer.get(3, 1) else ""
        self.unknown = int(np.flatnonzero(kinds == UNKNOWN)[0])
        self.unknown_text = trainer.get(44, " ⁇ ".encode())
        self.bytes = np.full(256, -1, np.int32)
        for i in np.flatnonzero(kinds == BYTE):
            self.bytes[int(names[i], 16) if names[i][0] != "<" else int(names[i][1:-1], 16)] = i
        self.fallback = bool(trainer.get(35, 0)) and bool((self.bytes >= 0).all())
        self.kinds, self.names = kinds, names
        self.known: dict[str, bytes] = {}
        self._vocabulary([int(i) for i in np.flatnonzero(kinds == NORMAL)], scores)

    def _vocabulary(self, normal: list[int], scores: np.ndarray) -> None:
        symbol = {self.names[i]: i for i in reversed(normal)}
        for name in [self.names[i] for i in normal]:
            for char in name:
                symbol.setdefault(char, len(self.names) + len(symbol))
        self.base = max(symbol.values(), default=0) + 2  # the last symbol stands for all other characters
        self.of_char = np.full(0x110000, self.base - 1, np.int64)
        for name, i in symbol.items():
            if len(name) == 1:
                self.of_char[ord(name)] = i
        self.rank = np.full(self.base, NONE, np.int32)
        order = np.unique(-scores[normal], return_inverse=True)[1] if normal else np.zeros(0, np.int32)
        self.rank[normal] = order
        pairs, inside = {}, set()
        for i in normal:
            name = self.names[i]
            inside.update(zip(name, name[1:]))
            for cut in range(1, len(name)):
                left, right = symbol.get(name[:cut]), symbol.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = symbol[name]
        pair, made = (np.fromiter(x, np.int64, len(pairs)) for x in (pairs.keys(), pairs.values()))
        self.pairs = Lookup(pair, made)
        self.one_pair: dict[int, int] | None = None  # the same table for single pairs, made when needed
        # Symbols that may at once be part of a pair that ranks as high as they do.
        self.eager = np.zeros(self.base, bool)
        for side in (pair // self.base, pair % self.base):
            self.eager[side[self.rank[made] <= self.rank[side]]] = True
        neighbours = np.array([ord(a) << 21 | ord(b) for a, b in inside], np.int64)
        self.inside = Lookup(neighbours, np.ones(len(neighbours), np.int64))
        # Characters that no longer piece holds are words of their own; other words start at their spaces.
        together = {c for pair in inside for c in pair}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in together)
        if any(b == SPACE != a for a, b in inside):
            self.words = re.compile(r".+", re.DOTALL)
        else:
            own = f"|[{alone}]+" if alone else ""
            self.words = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+{own}", re.DOTALL)

    def merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The symbol that each pair makes, or -1."""
        return self.pairs.of(left * self.base + right)

    def rank_of(self, made: np.ndarray) -> np.ndarray:
        return np.where(made >= 0, self.rank[made], NONE)

    def merge_rounds(self, symbol: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that are left when no pair remains, and the place where each began."""
        place = np.arange(len(symbol))
        done: list[tuple[np.ndarray, np.ndarray]] = [(symbol[:0], place[:0])]
        made = np.full(len(symbol), -1, np.int64)
        inner = np.flatnonzero(segment[1:] == segment[:-1])
        made[inner] = self.merge_of(symbol[inner], symbol[inner + 1])
        rank = self.rank_of(made)
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
            least = np.minimum.reduceat(rank, starts)
            size = np.diff(np.r_[starts, len(symbol)])
            if (least == NONE).any():
                live = np.repeat(least < NONE, size)
                done.append((symbol[~live], place[~live]))
                symbol, segment, place, made, rank = (x[live] for x in (symbol, segment, place, made, rank))
                size, least = size[least < NONE], least[least < NONE]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(least, size))
            # Of pairs that overlap in a run, the leftmost, and every second one after it.
            n = np.arange(len(at))
            run = np.maximum.accumulate(np.where(np.r_[True, at[1:] != at[:-1] + 1], n, 0))
            at = at[(n - run) % 2 == 0]
            if self.eager[made[at]].any():
                at, waiting = self.undisturbed(at, symbol, segment, made, rank)
                if len(waiting):
                    out = np.zeros(len(symbol), bool)
                    for a, b in waiting:
                        left, started = self.one_by_one(symbol[a:b].tolist())
                        done.append((np.array(left), place[a:b][started]))
                        out[a:b] = True
                    symbol, segment, place, made, rank = (x[~out] for x in (symbol, segment, place, made, rank))
                    continue
            symbol[at] = made[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            symbol, segment, place, made, rank = (x[keep] for x in (symbol, segment, place, made, rank))
            new = at - np.arange(len(at))
            touched = np.r_[new, new[new > 0] - 1]
            right = np.minimum(touched + 1, len(symbol) - 1)
            joined = (right > touched) & (segment[right] == segment[touched])
            made[touched] = np.where(joined, self.merge_of(symbol[touched], symbol[right]), -1)
            rank[touched] = self.rank_of(made[touched])
        symbols, places = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(places, kind="stable")
        return symbols[order], places[order]

    def undisturbed(self, at, symbol, segment, made, rank) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """The merges of each segment up to the first after which another pair may come before the next.

        With them the bounds of long segments that have such a merge before their last one.
        """
        last = len(symbol) - 1
        new, least = made[at], rank[at]

        def beside(place: np.ndarray, there: np.ndarray, left: bool) -> np.ndarray:
            other = symbol[np.clip(place, 0, last)]
            pair = self.merge_of(other, new) if left else self.merge_of(new, other)
            same = there & (segment[np.clip(place, 0, last)] == segment[at])
            return same & (self.rank_of(pair) <= least)

        loud = beside(at - 1, at > 0, True) | beside(at + 2, at + 2 <= last, False)
        follows = np.flatnonzero(at[1:] == at[:-1] + 2) + 1
        loud[follows] |= self.rank_of(self.merge_of(new[follows - 1], new[follows])) <= least[follows]
        before = np.cumsum(loud) - loud
        own = segment[at]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        at_start = np.repeat(before[starts], np.diff(np.r_[starts, len(at)]))
        now = before == at_start
        held = np.unique(own[~now])
        a, b = np.searchsorted(segment, held), np.searchsorted(segment, held, "right")
        long = b - a > QUEUED
        return at[now], list(zip(a[long].tolist(), b[long].tolist(), strict=True))

    def one_by_one(self, symbol: list[int]) -> tuple[list[int], list[int]]:
        """The same merges from a queue: for long segments where one decides whether the next can take place."""
        n = len(symbol)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        queue: list[tuple[int, int, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 <= b:
                made = self.merge(symbol[a], symbol[b])
                if made is not None:
                    heapq.heappush(queue, (int(self.rank[made]), a, b, symbol[a], symbol[b]))

        for a in range(n - 1):
            offer(a, a + 1)
        while queue:
            _, a, b, left, right = heapq.heappop(queue)
            if symbol[a] != left or symbol[b] != right or after[a] != b:
                continue
            symbol[a], symbol[b] = self.merge(left, right), -1
            after[a] = after[b]
            if after[a] >= 0:
                before[after[a]] = a
            offer(before[a], a)
            offer(a, after[a])
        started = [a for a in range(n) if symbol[a] != -1]
        return [symbol[a] for a in started], started

    def merge(self, left: int, right: int) -> int | None:
        if self.one_pair is None:
            there = self.pairs.keys >= 0
            self.one_pair = dict(zip(self.pairs.keys[there].tolist(), self.pairs.values[there].tolist(), strict=True))
        return self.one_pair.get(left * self.base + right)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word as bytes of 32-bit numbers."""
        text = "".join(words)
        code = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        ends = np.cumsum([len(w) for w in words])
        first = np.zeros(len(code), bool)
        first[np.r_[0, ends[:-1]]] = True
        apart = self.inside.of(code[:-1] << 21 | code[1:]) < 0
        segment = np.cumsum(first | np.r_[True, apart])
        symbol, place = self.merge_rounds(self.of_char[code], segment)
        unknown = symbol >= len(self.names)
        ids = np.where(unknown, self.unknown, symbol).astype(np.int32)
        if self.fallback and unknown.any():
            # A character without a piece is its bytes.
            chars = code[place[unknown]]
            length = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
            utf8 = np.frombuffer(chars.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
            count = np.ones(len(symbol), np.int64)
            count[unknown] = length
            ids = np.repeat(ids, count)
            ids[np.repeat(unknown, count)] = self.bytes[utf8]
            place = np.repeat(place, count)
        cuts = np.searchsorted(place, np.r_[0, ends])
        flat = ids.tobytes()
        return [flat[4 * a : 4 * b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def learn(self, words: set[str]) -> None:
        """Encode the words that are not known yet, a bounded number of characters at a time."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(words)
        held, size = [], 0
        for word in [*new, None]:
            if held and (word is None or size + len(word) > CHARS_AT_ONCE):
                self.known.update(zip(held, self.encode_words(held), strict=True))
                held, size = [], 0
            if word is not None:
                held.append(word)
                size += len(word)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, without begin or end."""
        split = [self.words.findall(self.prefix + t.replace(" ", SPACE)) if t else [] for t in texts]
        words = {w for line in split for w in line}
        self.learn(words)
        out = [np.frombuffer(b"".join(map(self.known.__getitem__, line)), np.int32) for line in split]
        if not self.fallback:
            # Unknown characters that follow each other are one.
            out = [x[np.r_[True, (x[1:] != self.unknown) | (x[:-1] != self.unknown)][: len(x)]] for x in out]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        for word in words:
            if len(word) > LONGEST_REMEMBERED:
                self.known.pop(word, None)
        return out

    def shown(self, i: int) -> bytes:
        """What an id adds to a text."""
        if self.kinds[i] == CONTROL:
            return b""
        if self.kinds[i] == UNKNOWN:
            return self.unknown_text
        if self.kinds[i] == BYTE:
            return bytes([int(np.flatnonzero(self.bytes == i)[0])])
        return self.names[i].replace(SPACE, " ").encode()

    def decode(self, lines: list[np.ndarray]) -> list[str]:
        """The text of each line of ids."""
        if not hasattr(self, "texts"):
            self.texts = [self.shown(i) for i in range(len(self.names))]
        out = []
        for line in lines:
            parts = [self.texts[i] for i in line.tolist()]
            if self.prefix:
                for k, i in enumerate(line.tolist()):
                    # The blank before the first piece that shows anything is the model's own.
                    if self.kinds[i] == NORMAL and self.names[i].startswith(SPACE):
                        parts[k] = parts[k][1:]
                        break
                    if parts[k]:
                        break
            try:
                out.append(b"".join(parts).decode("utf-8"))
            except UnicodeDecodeError:
                out.append(self._lenient(line, parts))
        return out

    def _lenient(self, line: np.ndarray, parts: list[bytes]) -> str:
        """As decode, where bytes do not make up characters: each that does not becomes U+FFFD."""
        text, raw = [], b""
        for is_byte, part in [*zip(self.kinds[line] == BYTE, parts, strict=True), (False, b"")]:
            if is_byte:
                raw += part
                continue
            while raw:
                for size in (1, 2, 3, 4):
                    try:
                        text.append(raw[:size].decode("utf-8"))
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    text.append("�")
                raw = raw[size:]
            text.append(part.decode("utf-8"))
        return "".join(text)


_loaded: dict[str, Pieces] = {}


def pieces(model: bytes) -> Pieces:
    """The model, read once in a process."""
    name = hashlib.sha256(model).hexdigest()
    if name not in _loaded:
        _loaded.clear()
        _loaded[name] = Pieces(model)
    return _loaded[name]


def sliced(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about TEXTS_AT_ONCE bytes of a text column; a longer text is a part of its own."""
    size = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    yield from in_parts(batch, size, TEXTS_AT_ONCE)


def encoded(texts: pa.Array, use: Pieces) -> pa.ListArray:
    """The ids of each text."""
    ids = use.encode(texts.to_pylist())
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def decoded(lists: pa.ListArray, use: Pieces) -> pa.Array:
    """The text of each line of ids; a null line is empty."""
    none = np.zeros(0, np.int32)
    flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    valid = lists.is_valid().to_numpy(zero_copy_only=False)
    lines = [flat[x:y] if ok else none for x, y, ok in zip(ends[:-1], ends[1:], valid, strict=True)]
    return pa.array(use.decode(lines), pa.string())


def with_ids(docs: DataFrame, model: bytes, text: str = "text", back: str | None = None) -> DataFrame:
    """``row`` (all columns but the text, as a struct) and ``ids``: the whole text in the pieces of ``model``.

    Ids are those that the sentencepiece library gives, without begin or end. ``model`` is a serialised
    byte-pair model; it travels with the tasks, so executors need no file. ``back`` names one more column:
    the text that the ids decode to, as by ``with_text``, made in the same pass. Two passes that follow each
    other would run in two processes to a task, each with a model of its own.

    A null or empty text has no ids; a very long one, also without any blank, is encoded whole; repeated
    rows and null ids stay as they are; an empty table gives an empty one. Other columns may have any name.
    """
    if back in ("row", "ids"):
        raise ValueError(f"the table has a column {back} already")
    pieces(model)  # tells of a model that cannot be read before any task starts
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rows = docs.select(F.struct(*others, F.lit(0).alias("_")).alias("row"), whole_text(f"`{text}`").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = pieces(model)
        for batch in batches:
            for b in sliced(batch, "text"):
                ids = encoded(b["text"], use)
                columns = {"row": b["row"], "ids": ids} | ({back: decoded(ids, use)} if back else {})
                yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])

    kind = rows.schema["row"].dataType.simpleString()
    out = rows.mapInArrow(encode, f"row {kind}, ids array<int>" + (f", `{back}` string" if back else ""))
    return out.withColumn("row", F.col("row").dropFields("_")) if others else out


def with_text(encoded: DataFrame, model: bytes, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """All columns and ``name``: the text that the sentencepiece library decodes ``ids`` to.

    Null or empty ids are the empty text. ``ids`` must be ids of the model.
    """
    if name in encoded.columns:
        raise ValueError(f"the table has a column {name} already")
    schema = StructType([*encoded.schema.fields, StructField(name, StringType())])
    at = encoded.columns.index(ids)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = pieces(model)
        for batch in batches:
            size = pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
            for b in in_parts(batch, size, IDS_AT_ONCE):
                yield pa.RecordBatch.from_arrays([*b.columns, decoded(b.column(at), use)], [*b.schema.names, name])

    return encoded.mapInArrow(decode, schema)


def round_trip(docs: DataFrame, model: bytes) -> DataFrame:
    """Per document doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by commas) and decoded_sha256."""
    back = with_ids(docs.select("doc_id", "text"), model, back="decoded")
    return back.select(
        "row.doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
