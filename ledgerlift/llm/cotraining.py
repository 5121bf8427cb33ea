"""Quality by co-training: a classifier of the text and one of the page's metadata teach each other.

Both are logistic regressions. They start from a bounded sample of labelled documents. In every round each view
labels all other documents that it is sure of, for the other view to learn from: a Newton step whose sums are
one pass over the features of all documents. Held-out labels calibrate the views and weigh them; then all
documents are scored.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import delete, shuffle_width, small_batches, staging_path, whole_text

WORD_BUCKETS, SHAPE_BUCKETS = 512, 256
SOURCE_BUCKETS, LANG_BUCKETS, LAYOUT = 64, 16, 10
TEXT_WIDTH = WORD_BUCKETS + SHAPE_BUCKETS + 1
META_WIDTH = SOURCE_BUCKETS + LANG_BUCKETS + LAYOUT
#: Words whose buckets a task remembers, rows that are one matrix, and steps that a fit takes at most.
REMEMBERED, ROWS_AT_ONCE, STEPS = 1 << 18, 2048, 25
#: The curvature that a taught document counts with at least: lessons are sure, and would else have next to none.
LEAST_CURVATURE = 0.05
FEATURES = "y double, held boolean, at binary, share binary, meta binary, known boolean"


@dataclass(frozen=True)
class CoTraining:
    """``labelled`` bounds the labelled documents that are fitted on; everything else covers all documents."""

    labelled: int = 12_000
    rounds: int = 2
    sure: float = 0.97
    held_out: float = 0.3
    reject_below: float = 0.5
    penalty: float = 1e-4


def bucket(text: str, n: int) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=4).digest()) % n


@lru_cache(REMEMBERED)
def shape_bucket(shape: str) -> int:
    return bucket(shape, SHAPE_BUCKETS)


def kind_of(char: str) -> int:
    """1 for lower-case and other letters, 2 for capitals, 3 for digits, 4 for blanks, 0 for the rest."""
    if char.isalpha():
        return 2 if char.isupper() else 1
    return 3 if char.isdigit() else 4 if char.isspace() else 0


class Buckets(dict):
    """Words to buckets: of the word, and (times WORD_BUCKETS) of its shape; forgets all when it is full.

    A shape has runs of letters as a or A, of digits as 0, and the rest as it is.
    """

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        if word.isalpha():
            shape = "A" if word.isupper() and len(word) > 1 else "a"
        else:
            shape = re.sub(r"[^\W\d_]+", lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "a", word)
            shape = re.sub(r"(.)\1+", r"\1", re.sub(r"\d+", "0", shape))
        self[word] = out = bucket(word.lower(), WORD_BUCKETS) + WORD_BUCKETS * shape_bucket(shape)
        return out


KINDS = np.array([kind_of(chr(c)) for c in range(1 << 16)], np.uint8)


class Features:
    """The features of both views."""

    def __init__(self):
        self.buckets = Buckets()

    def codes(self, words: list[str]) -> np.ndarray:
        """The buckets of the words and of their shapes, as one number each."""
        return np.fromiter(map(self.buckets.__getitem__, words), np.int64, len(words))

    def text(self, codes: np.ndarray) -> np.ndarray:
        """Shares of words and shapes, damped, and how much the commonest word makes up."""
        out = np.zeros(TEXT_WIDTH)
        if len(codes):
            share = np.bincount(codes % WORD_BUCKETS, minlength=WORD_BUCKETS) / len(codes)
            shapes = np.bincount(codes // WORD_BUCKETS, minlength=SHAPE_BUCKETS) / len(codes)
            out[:-1] = np.sqrt(np.r_[share, shapes])
            out[-1] = share.max()
        return out

    def meta(self, text: str, words: list[str], codes: np.ndarray, source: str | None, lang: str | None) -> np.ndarray:
        """Where the page is from and how it is laid out."""
        out = np.zeros(META_WIDTH)
        out[bucket(f"s{source}", SOURCE_BUCKETS)] = 1
        out[SOURCE_BUCKETS + bucket(f"l{lang}", LANG_BUCKETS)] = 1
        n, lines = max(1, len(text)), text.count("\n") + 1
        points = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)
        other, small, capitals, digits, blanks = np.bincount(KINDS[points], minlength=5)
        words_n = max(1, len(words))
        again = np.count_nonzero(codes[1:] == codes[:-1])
        out[-LAYOUT:] = [
            math.log1p(len(text)) / 10,
            math.log1p(lines) / 10,
            math.log1p(len(text) / lines) / 10,
            (small + capitals) / words_n / 10,
            digits / n,
            capitals / n,
            other / n,
            blanks / n,
            len(set(words)) / words_n,
            again / words_n,
        ]
        return out

    def both(self, text: str, source: str | None, lang: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        codes = self.codes(words)
        return self.text(codes), self.meta(text, words, codes, source, lang)


_features: list[Features] = []


def features() -> Features:
    """The features of this process; it goes on remembering words from one task to the next."""
    if not _features:
        _features.append(Features())
    return _features[0]


@dataclass(frozen=True)
class View:
    """A fitted view: weights, and the line that calibrates its log-odds."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def odds(self, features: np.ndarray) -> np.ndarray:
        return self.slope * (features @ self.weights + self.bias) + self.shift


@dataclass(frozen=True)
class Quality:
    """Both calibrated views and their weights. Without two classes of labels all documents score ``prior``."""

    text: View | None
    meta: View | None
    weights: tuple[float, float, float] = (0.5, 0.5, 0.0)
    prior: float = 1.0


def uniform(column: str, seed: int) -> Column:
    """A number in [0, 1) from a hash: the same row falls into the same sample on every run."""
    return (F.xxhash64(F.col(column), F.lit(seed)).cast("double") / 2.0**64) + 0.5


def featured(docs: DataFrame, labels: DataFrame, how: CoTraining) -> tuple[DataFrame, DataFrame, str]:
    """Features of at most how.labelled labelled documents, and of all others, staged, and their path.

    Labels that are null, not 0 or 1, or contradict each other are not used.
    """
    clean = (
        labels.where("quality in (0, 1) and doc_id is not null")
        .groupBy(F.col("doc_id").cast("bigint").alias("labelled"))
        .agg(F.min("quality").alias("y"), F.max("quality").alias("top"))
        .where("y = top")
    )
    n_labels = clean.count()
    drawn = clean.where(uniform("labelled", 1) < how.labelled / max(1, n_labels))
    chosen = drawn.orderBy(uniform("labelled", 1)).limit(how.labelled)
    chosen = chosen.select("labelled", F.col("y").cast("double").alias("y"))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        whole_text().alias("text"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
    )
    # At most how.labelled rows of two numbers.
    rows = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"), "left")
    held = F.col("y").isNotNull() & (uniform("doc_id", 3) < how.held_out)
    rows = rows.select("text", "source", "lang", "y", F.coalesce(held, F.lit(False)).alias("held"), F.col("y").isNotNull().alias("known"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = features()
        for b in batches:
            at, share, meta = [], [], []
            for row in zip(*(b[c].to_pylist() for c in ("text", "source", "lang")), strict=True):
                text, layout = made.both(*row)
                some = np.flatnonzero(text)
                at.append(some.astype("<u2").tobytes())
                share.append(text[some].astype("<f4").tobytes())
                meta.append(layout.astype("<f4").tobytes())
            packed = [pa.array(c, pa.binary()) for c in (at, share, meta)]
            yield pa.RecordBatch.from_arrays([b["y"], b["held"], *packed, b["known"]], [c.split()[0] for c in FEATURES.split(", ")])

    path = staging_path(docs.sparkSession, "features")
    with small_batches(docs.sparkSession):
        rows.mapInArrow(make, FEATURES).write.partitionBy("known").parquet(path)
    whole = docs.sparkSession.read.schema(FEATURES).parquet(path)
    return whole.where("known"), whole.where("not known"), path


def matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of a batch: y, held, and the features of both views with a constant."""
    for start in range(0, batch.num_rows, ROWS_AT_ONCE):
        b = batch.slice(start, ROWS_AT_ONCE)
        n = b.num_rows
        at, share, meta = (b[c].to_pylist() for c in ("at", "share", "meta"))
        text = np.zeros((n, TEXT_WIDTH + 1))
        row = np.repeat(np.arange(n), [len(x) // 2 for x in at])
        text[row, np.frombuffer(b"".join(at), "<u2")] = np.frombuffer(b"".join(share), "<f4")
        layout = np.ones((n, META_WIDTH + 1))
        layout[:, :-1] = np.frombuffer(b"".join(meta), "<f4").reshape(n, META_WIDTH)
        text[:, -1] = 1
        yield b["y"].to_numpy(zero_copy_only=False), b["held"].to_numpy(zero_copy_only=False), text, layout


def newton_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray, least: float) -> np.ndarray:
    """Hessian, gradient, loss and number of rows of a logistic fit at ``w``, in one matrix."""
    margin = x @ w
    p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
    out = np.zeros((len(w), len(w) + 2))
    out[:, :-2] = (x * np.maximum(p * (1 - p), least)[:, None]).T @ x
    out[:, -2] = x.T @ (p - y)
    out[0, -1], out[1, -1] = (np.logaddexp(0, margin) - y * margin).sum(), len(y)
    return out


def total(rows: DataFrame, sums: Callable[[pa.RecordBatch], list[np.ndarray]]) -> list[np.ndarray]:
    """The sums of matrices over all batches; tasks add up their own, some tasks those of others, one the rest."""

    def added(batches: Iterator[pa.RecordBatch], of: Callable) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for b in batches:
            if b.num_rows:
                for found in of(b):
                    held = [a + x for a, x in zip(held, found, strict=True)] if held else found
        if held:
            packed = pickle.dumps(held)
            yield pa.RecordBatch.from_pydict({"part": pa.array([zlib.crc32(packed) >> 1], pa.int32()), "sums": pa.array([packed], pa.binary())})

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return added(batches, lambda b: (pickle.loads(x) for x in b["sums"].to_pylist()))

    parts = rows.mapInArrow(lambda batches: added(batches, lambda b: [sums(b)]), "part int, sums binary")
    some = max(1, math.isqrt(shuffle_width(rows.sparkSession)))
    # In one order, so that the sums do not depend on which task ends first.
    found = parts.repartition(some, "part").sortWithinPartitions("part").mapInArrow(again, "part int, sums binary")
    found = found.coalesce(1).mapInArrow(again, "part int, sums binary")
    one = found.first()
    return pickle.loads(bytes(one.sums)) if one else []


def stepped(w: np.ndarray, sums: np.ndarray, penalty: float) -> np.ndarray:
    """A Newton step; the constant is free of the penalty, which grows with the rows."""
    ridge = np.r_[np.full(len(w) - 1, penalty * max(1.0, sums[1, -1])), 1e-9]
    return np.linalg.solve(sums[:, :-2] + np.diag(ridge), sums[:, -2] + ridge * w)


def fitted(x: np.ndarray, y: np.ndarray, penalty: float) -> np.ndarray:
    """A logistic fit on a few numbers of held-out documents, of which there are how.labelled at most."""
    w = np.zeros(x.shape[1])
    for _ in range(STEPS):
        step = stepped(w, newton_sums(x, y, w, 1e-6), penalty)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max(initial=0.0) < 1e-9:
            break
    return w


def started(known: DataFrame, how: CoTraining) -> list[np.ndarray]:
    """Both views fitted on the labelled documents that are not held out: damped Newton steps."""
    views = [np.zeros(TEXT_WIDTH + 1), np.zeros(META_WIDTH + 1)]

    def judged(at: list[np.ndarray]) -> list[np.ndarray]:
        def sums(batch: pa.RecordBatch) -> list[np.ndarray]:
            out = [np.zeros((len(w), len(w) + 2)) for w in at]
            for y, _, *both in matrices(batch):
                out = [o + newton_sums(x, y, w, 1e-6) for o, x, w in zip(out, both, at, strict=True)]
            return out

        return total(known, sums)

    def loss(sums: np.ndarray, w: np.ndarray) -> float:
        return sums[0, -1] + how.penalty * sums[1, -1] * float(w[:-1] @ w[:-1]) / 2

    here, size = judged(views), [1.0, 1.0]
    moves = [stepped(w, s, how.penalty) for w, s in zip(views, here, strict=True)]
    for _ in range(STEPS):
        there = [w - k * m for w, k, m in zip(views, size, moves, strict=True)]
        found = judged(there)
        small = True
        for v in range(2):
            if loss(found[v], there[v]) <= loss(here[v], views[v]) + 1e-9:
                small &= bool(np.abs(there[v] - views[v]).max() < 1e-4 * max(1.0, np.abs(there[v]).max()))
                views[v], here[v], size[v] = there[v], found[v], 1.0
                moves[v] = stepped(views[v], here[v], how.penalty)
            else:
                size[v] /= 2
                small = False
        if small:
            break
    return views


def taught(rows: DataFrame, views: list[np.ndarray], how: CoTraining) -> list[np.ndarray]:
    """Both views after a round: a step on the labelled documents and on all those the other view is sure of."""
    edge = math.log(how.sure / (1 - how.sure))

    def sums(batch: pa.RecordBatch) -> list[np.ndarray]:
        out = [np.zeros((len(w), len(w) + 2)) for w in views]
        for y, _, *both in matrices(batch):
            odds = [x @ w for x, w in zip(both, views, strict=True)]
            for v, (x, w) in enumerate(zip(both, views, strict=True)):
                other = odds[1 - v]
                label = np.where(np.isnan(y), np.where(other > edge, 1.0, np.where(other < -edge, 0.0, np.nan)), y)
                use = ~np.isnan(label)
                out[v] += newton_sums(x[use], label[use], w, LEAST_CURVATURE)
        return out

    return [w - stepped(w, s, how.penalty) for w, s in zip(views, total(rows, sums), strict=True)]


def fit(docs: DataFrame, labels: DataFrame, how: CoTraining = CoTraining()) -> Quality:
    """Both views after ``how.rounds`` exchanges, calibrated and weighed on held-out labels."""
    labelled, others, path = featured(docs, labels, how)
    try:
        return fitted_views(labelled, others, how)
    finally:
        delete(docs.sparkSession, path)


def fitted_views(labelled: DataFrame, others: DataFrame, how: CoTraining) -> Quality:
    """As ``fit``, from the features."""
    seen = {(r.held, r.y): r["count"] for r in labelled.groupBy("held", "y").count().collect()}
    if len(seen) < 4:
        good = sum(n for (_, y), n in seen.items() if y == 1)
        return Quality(None, None, prior=good / sum(seen.values()) if seen else 1.0)
    known = labelled.where("not held")
    views = started(known, how)
    for _ in range(how.rounds):
        views = taught(known.unionByName(others), views, how)

    def held_odds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for y, _, *both in matrices(b):
                columns = [y, *[x @ w for x, w in zip(both, views, strict=True)]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["y", "text", "meta"])

    # At most how.labelled rows of three numbers.
    held = labelled.where("held").mapInArrow(held_odds, "y double, text double, meta double").collect()
    y, *odds = np.array(sorted(map(tuple, held))).T
    ones, lines, sides = np.ones(len(y)), [], []
    for o in odds:
        slope, shift = fitted(np.c_[o, ones], y, how.penalty)
        # A view that is wrong more often than right is left out rather than turned round.
        lines.append((max(0.0, float(slope)), float(shift)))
        sides.append(lines[-1][0] * o + lines[-1][1])
    u, v, shift = fitted(np.c_[sides[0], sides[1], ones], y, how.penalty)
    text, meta = (View(w[:-1], float(w[-1]), *line) for w, line in zip(views, lines, strict=True))
    return Quality(text, meta, (max(0.0, float(u)), max(0.0, float(v)), float(shift)))


def scores(model: Quality):
    """A pandas UDF of (text, source, lang): the probabilities of the views and of both together."""

    def chance(odds: float) -> float:
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))

    @F.pandas_udf("struct<p_text:double,p_meta:double,p:double>")
    def score(text: pd.Series, source: pd.Series, lang: pd.Series) -> pd.DataFrame:
        made, out = features(), []
        for row in zip(text, source, lang, strict=True):
            if model.text is None:
                out.append((model.prior,) * 3)
                continue
            a, b = made.both(*row)
            a, b = float(model.text.odds(a)), float(model.meta.odds(b))
            u, v, w = model.weights
            out.append((chance(a), chance(b), chance(u * a + v * b + w)))
        return pd.DataFrame(out, columns=["p_text", "p_meta", "p"])

    return score


def with_quality(docs: DataFrame, labels: DataFrame, how: CoTraining = CoTraining()) -> DataFrame:
    """Every document as ``row`` (a struct of its columns) with p_text, p_meta, p and ``keep``.

    ``p`` is the probability of good quality; documents below how.reject_below are not kept. A null text is
    an empty one; a null source or language is one of its own; repeated rows score alike; documents without
    labels are scored like the others. Without labels of both classes every document scores the share of
    good ones (1 without any). Very long texts are read whole. Ties at the threshold are kept. An empty table
    gives an empty one; clashing names are safe inside ``row``.
    """
    model = fit(docs, labels, how)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    source, lang = F.col("row.source").cast("string"), F.col("row.lang").cast("string")
    scored = rows.select("row", scores(model)(text, source, lang).alias("s"))
    keep = F.col("s.p") >= how.reject_below
    return scored.select("row", "s.p_text", "s.p_meta", "s.p", keep.alias("keep"))


def good_documents(docs: DataFrame, labels: DataFrame, how: CoTraining = CoTraining()) -> DataFrame:
    """The documents that are kept, in the columns they came with."""
    return with_quality(docs, labels, how).where("keep").select("row.*")
