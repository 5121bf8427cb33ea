"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans are designed for. All of them are Spark defaults in
# recent versions except the partition size, but clusters often override them.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_local_dirs: dict[str, str] = {}


def recommend(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the recommended settings to a session builder."""
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without the setting it is the context's checkpoint folder, if one was set. Only a local session
    may do without both; it then gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="ledgerlift-")
    return _local_dirs[sc.applicationId]


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back.

    Cuts the lineage at a durable table: later jobs survive the loss of executors, read only the
    columns they need, and all see the same rows.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
