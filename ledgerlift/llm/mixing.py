"""Mixing sources: tempered shares, an exponent found by bisection, budgets dealt out as permuted blocks."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.llm.common import stage, whole_text
from ledgerlift.llm.packing import word_count

#: The exponent is a multiple of 1/GRID between 0 and 1.
GRID = 1 << 20
#: Halvings that one job over the sources decides.
HALVINGS = 5
HASH_BITS = 60


@dataclass(frozen=True)
class Mix:
    """What is asked for.

    ``most_repeats``: flatten the shares as far as no source is repeated more often than this; or
    ``least_entropy``: flatten them only until their entropy (in nats) is reached.
    ``budget``: tokens in all; None takes as many as it needs for every document to occur once at least.
    """

    most_repeats: float | None = 2.0
    least_entropy: float | None = None
    budget: int | None = None
    block_tokens: int = 1 << 20
    seed: int = 0

    def __post_init__(self):
        if (self.most_repeats is None) == (self.least_entropy is None):
            raise ValueError("give either most_repeats or least_entropy")


def source_totals(rows: DataFrame) -> DataFrame:
    """Tokens, documents and token share of each source; sums are taken map-side first."""
    totals = stage(
        rows.groupBy("source").agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("docs")), "sources"
    )
    everything = totals.agg(F.sum("total")).first()[0] or 0
    return totals.withColumn("share", F.col("total") / F.lit(float(max(everything, 1))))


def exponent(totals: DataFrame, mix: Mix) -> float:
    """Bisect the exponent: the smallest that keeps the repeats, or the largest that keeps the entropy.

    Flattening (a smaller exponent) only raises the entropy and the repeats. Every job over the sources
    evaluates all points that ``HALVINGS`` halvings could ask for; rows are source x point, sums are one
    row per point.
    """
    some = totals.where("share > 0")

    def measures(points: list[int]) -> dict[int, tuple[float, float]]:
        a = F.col("point") / F.lit(float(GRID))
        spread = some.withColumn("point", F.explode(F.array(*map(F.lit, points))))
        weight, rate = F.pow("share", a), F.pow("share", a - 1)
        found = spread.groupBy("point").agg(
            F.sum(weight).alias("z"),
            F.sum(weight * F.log("share")).alias("l"),
            F.max(rate).alias("most"),
            F.min(rate).alias("least"),
        )
        total = some.agg(F.sum("total")).first()[0]
        out = {}
        for r in found.collect():
            entropy = math.log(r.z) - r.point / GRID * r.l / r.z
            # A source is repeated budget * weight / total times; the budget of None makes the least of these 1.
            repeats = r.most / r.least if mix.budget is None else mix.budget / total * r.most / r.z
            out[r.point] = (entropy, repeats)
        return out

    def low_enough(measure: tuple[float, float]) -> bool:
        """Whether the true place is at this point or below it."""
        entropy, repeats = measure
        return repeats <= mix.most_repeats * (1 + 1e-12) if mix.most_repeats is not None else entropy < mix.least_entropy

    if some.isEmpty():
        return 1.0
    low, high = -1, GRID  # low: known not to do (or below the range); high: does, or is the end of the range
    while high - low > 1:
        step = max(1, (high - low) >> HALVINGS)
        points = list(range(low + step, high, step))
        measured = measures(points)
        fitting = [p for p in points if low_enough(measured[p])]
        if fitting:
            high = min(fitting)
        low = max([p for p in points if p < high], default=low)
    if mix.most_repeats is not None:
        return high / GRID
    # The largest point whose entropy is still enough is the one below the first that has too little.
    at_end = high == GRID and not low_enough(measures([GRID])[GRID])
    return 1.0 if at_end else max(low, 0) / GRID


def budgets(totals: DataFrame, mix: Mix) -> tuple[DataFrame, int]:
    """Each source's total, docs, weight, budget and passes, and the tokens in all."""
    a = exponent(totals, mix)
    rows = totals.withColumn("power", F.when(F.col("share") > 0, F.pow("share", F.lit(a))).otherwise(0.0))
    sums = rows.agg(F.sum("power").alias("z"), F.max(F.try_divide("total", "power")).alias("need")).first()
    z = sums.z or 1.0
    whole = mix.budget is None
    tokens = math.ceil((sums.need or 0.0) * z - 1e-6) if whole else mix.budget
    rows = rows.withColumn("weight", F.col("power") / z)
    share = F.floor(F.col("weight") * tokens + 1e-6).cast("bigint")
    rows = rows.withColumn("budget", F.greatest(share, F.col("total")) if whole else share)
    passes = F.when(F.col("total") > 0, F.ceil(F.col("budget") / F.col("total"))).otherwise(0)
    rows = rows.withColumn("passes", F.greatest(passes.cast("int"), F.lit(1)))
    return rows.select("source", "total", "docs", "weight", "budget", "passes"), tokens


def row_digest(docs: DataFrame) -> Column:
    """A hash of all columns that Spark can hash (not of maps)."""
    kinds = [(f.name, f.dataType.simpleString()) for f in docs.schema.fields]
    return F.xxhash64(*[F.col(f"`{n}`") for n, k in kinds if "map<" not in k and "variant" not in k])


def mix_sources(docs: DataFrame, mix: Mix = Mix(), per_bucket: int = 1024) -> DataFrame:
    """The mixed corpus: the rows of ``docs`` as often as their source's budget takes them.

    Columns: ``row`` (a struct of all columns of docs), ``source``, ``tokens``, ``epoch`` (passes over the
    source before this one), ``block`` and ``place`` (from 0, within the block). Every pass over a source
    is a permutation of its documents by hash; the budget cuts the last one. A source's stream is spread
    evenly over the blocks, so each block holds the sources in the target weights, in permuted order.

    Running token totals within a source need no window over it: a pass is cut into hash buckets of about
    ``per_bucket`` documents, and only the buckets' totals are summed along the source.

    A null or empty text has no tokens: such documents follow their source, and a source without any token
    occurs once. A null source is a source of its own. Rows of one doc_id come in order of a digest of the
    whole row, rows without doc_id by that digest alone, so the order of the input does not matter; repeated
    rows each count, and follow each other. Very long texts count with all their words; an empty table gives
    an empty one; clashing names are safe inside ``row``.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("source").cast("string").alias("source"),
        word_count(whole_text()).alias("tokens"),
        row_digest(docs).alias("digest"),
    )
    # Rows without doc_id are told apart by what they hold.
    rows = rows.withColumn("key", F.coalesce(F.col("row.doc_id").cast("string"), F.concat(F.lit(":"), F.col("digest").cast("string"))))
    per_source, tokens = budgets(source_totals(rows.select("source", "tokens")), mix)
    per_source = stage(per_source.withColumnRenamed("source", "name"), "budgets")
    blocks = max(1, -(-tokens // mix.block_tokens))
    digest = F.md5(F.concat_ws(":", F.lit(str(mix.seed)), F.col("epoch").cast("string"), "key"))
    passes = (
        rows.join(per_source, F.col("source").eqNullSafe(F.col("name")))
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
        .withColumn("hash", F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint"))
        .withColumn(
            "bucket",
            F.floor(F.col("hash") / float(1 << HASH_BITS) * F.greatest(F.floor(F.col("docs") / per_bucket), F.lit(1))),
        )
    )
    slim = passes.groupBy("source", "epoch", "bucket").agg(F.sum("tokens").alias("held"))
    along = Window.partitionBy("source", "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = slim.select(
        F.col("source").alias("s"),
        F.col("epoch").alias("e"),
        F.col("bucket").alias("b"),
        F.coalesce(F.sum("held").over(along), F.lit(0)).alias("before"),
    )
    joined = passes.join(
        before, F.col("source").eqNullSafe(F.col("s")) & (F.col("epoch") == F.col("e")) & (F.col("bucket") == F.col("b"))
    )
    within = Window.partitionBy("source", "epoch", "bucket").orderBy("hash", "key", "digest")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("total") * F.col("epoch") + F.col("before") + F.coalesce(F.sum("tokens").over(within), F.lit(0))
    taken = F.col("start") < F.col("budget")
    taken = taken | (F.col("epoch") == 0) if mix.budget is None else taken
    spread = F.floor(F.col("start") / F.col("budget") * blocks)
    block = F.when(F.col("total") > 0, F.least(spread, F.lit(blocks - 1))).otherwise(F.pmod("hash", F.lit(blocks)))
    placed = (
        joined.withColumn("start", start)
        .where(taken)
        .select("row", "source", "tokens", "epoch", "hash", "key", "digest", block.cast("bigint").alias("block"))
    )
    in_block = Window.partitionBy("block").orderBy("hash", "key", "source", "digest")
    return placed.select(
        "row", "source", "tokens", "epoch", "block", (F.row_number().over(in_block) - 1).cast("bigint").alias("place")
    )


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The documents of the mix, in the columns they came with: repeats are repeated rows."""
    return mix_sources(docs, mix).select("row.*")
