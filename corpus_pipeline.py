"""The corpus pipeline: five stages over the documents, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlift.llm.common import stage, table
from ledgerlift.llm.cotraining import good_documents
from ledgerlift.llm.line_dedup import without_boilerplate
from ledgerlift.llm.mixing import Mix, mixed_documents
from ledgerlift.llm.packing import pack
from ledgerlift.llm.parity_join import representatives


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the co-trained classifier rejects go."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: lines on ten sites or more are cut from the texts; all documents stay."""
    return without_boilerplate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of documents linked by 80 % of their five-word shingles the smallest doc_id stays."""
    return representatives(docs, words=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: small sources are repeated up to twice; every document occurs at least once."""
    return mixed_documents(docs, Mix(most_repeats=2.0))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: bins of 2,048 tokens, no bin with two copies or with more than four of a source."""
    return pack(docs, capacity=2048, per_source=4)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL cannot train the classifier; the stages after it are tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from documents to bins."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
