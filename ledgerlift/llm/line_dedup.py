"""Cross-site boilerplate: lines that stand on many sites are removed from all documents.

Built-in functions only. How many sites a line is on is estimated with one HyperLogLog sketch per line
hash; only lines whose estimate is near the threshold are counted exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import stage, whole_text

#: Sites a line must be on to be boilerplate.
MIN_SITES = 10
#: Logarithm of a sketch's registers; its relative error is 1.04 / sqrt(registers).
REGISTERS = 12


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def site_lines(docs: DataFrame) -> DataFrame:
    """(line, site) for every line that is not blank; a null source is a site of its own."""
    site = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    lines = F.filter(lines_of(whole_text()), lambda x: F.trim(x) != "")
    hashes = F.transform(lines, line_hash)
    return docs.select(site.alias("site"), F.explode(hashes).alias("line"))


def boilerplate_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Hashes of the lines that stand on at least ``min_sites`` sites, staged.

    Sketches are merged map-side and after the shuffle, so a line that a third of all documents share is
    one sketch per task. An estimate further from the threshold than three standard errors (and one site)
    decides; the lines between are counted exactly over all documents, by distinct (line, site) first.
    """
    margin = max(1, math.ceil(3 * 1.04 / math.sqrt(1 << REGISTERS) * min_sites))
    sketched = site_lines(docs).groupBy("line").agg(F.hll_sketch_agg("site", F.lit(REGISTERS)).alias("sketch"))
    spread = stage(
        sketched.select("line", F.hll_sketch_estimate("sketch").alias("sites")).where(
            F.col("sites") >= min_sites - margin
        ),
        "spread",
    )
    sure = spread.where(F.col("sites") > min_sites + margin).select("line")
    near = spread.where(F.col("sites") <= min_sites + margin).select("line")
    pairs = site_lines(docs).join(near, "line", "left_semi").groupBy("line", "site").agg(F.lit(1).alias("one"))
    exact = pairs.groupBy("line").agg(F.count(F.lit(1)).alias("sites")).where(F.col("sites") >= min_sites)
    return stage(sure.unionByName(exact.select("line")), "boilerplate")


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """All rows of ``docs`` as ``row`` (a struct of its columns), with ``text`` less its boilerplate lines.

    Also ``n_lines`` and ``n_removed``. Lines are compared without leading and trailing blanks; blank
    lines stay, as do the order of the rest and all documents, even those of which nothing is left.

    A null text is an empty one; null ids and sources and repeated rows are kept as they are; an empty
    table gives an empty one; clashing names are safe inside ``row``.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), whole_text().alias("text"))
    whole = whole.select("row", "text", F.col("row.doc_id").alias("id"), F.xxhash64("text", "row.doc_id").alias("key"))
    marked = boilerplate_lines(docs, min_sites)
    hashes = F.transform(lines_of(F.col("text")), line_hash)
    places = (
        whole.select("key", "id", F.posexplode(hashes).alias("place", "line"))
        .join(marked, "line")
        .groupBy("key", "id")
        .agg(F.collect_set("place").alias("places"))
        .select(F.col("key").alias("k"), F.col("id").alias("i"), "places")
    )
    joined = whole.join(places, (F.col("key") == F.col("k")) & F.col("id").eqNullSafe(F.col("i")), "left")
    cut = joined.select("row", "text", "places", lines_of(F.col("text")).alias("lines"))
    n = F.size("lines")
    kept = F.array_except(F.sequence(F.lit(0), n - 1), F.col("places"))
    text = F.array_join(F.transform(kept, lambda i: F.col("lines")[i]), "\n")
    return cut.select(
        "row",
        F.when(F.col("places").isNull(), F.col("text")).otherwise(text).alias("text"),
        n.cast("bigint").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("bigint").alias("n_removed"),
    )


def without_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The documents in the columns they came with, the text cleaned and n_chars (if there) counted anew."""
    clean = remove_boilerplate(docs, min_sites)
    new = {"text": F.col("text")} | {"n_chars": F.char_length("text").cast("bigint")}
    return clean.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
