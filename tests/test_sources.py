import pytest

from pyspark.sql import functions as F

from ledgerlift import session
from ledgerlift.operators import supervised
from ledgerlift.sources import sinks, tables


def test_union_by_name_skips_what_is_missing(spark, tmp_path):
    spark.createDataFrame([(1, "x"), (1, "x")], "a int, b string").write.parquet(str(tmp_path / "one"))
    spark.createDataFrame([("y", 2)], "b string, a int").write.parquet(str(tmp_path / "two"))
    spark.createDataFrame([(3,)], "a int").write.parquet(str(tmp_path / "three"))
    got = tables.union_existing(spark, [str(tmp_path / n) for n in ("one", "none", "two", "three")])
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "x"), (1, "x"), (2, "y"), (3, None)]
    with pytest.raises(FileNotFoundError):
        tables.union_existing(spark, [str(tmp_path / "none")])


def test_csv_has_a_header_and_no_index(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string").coalesce(1)
    sinks.write_csv(df, str(tmp_path / "csv"))
    text = next((tmp_path / "csv").glob("part-*.csv")).read_text()
    assert text.splitlines() == ["a,b", "1,x", "2,"]
    assert sorted(map(tuple, tables.read_csv(spark, str(tmp_path / "csv")).collect())) == [(1, "x"), (2, None)]


def test_materialized_table_is_never_silently_stale(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1,)], "a int")
    assert sinks.materialize(one, path).collect() == one.collect()
    two = spark.createDataFrame([(2,)], "a int")
    assert sinks.materialize(two, path, refresh=False).collect() == one.collect()
    assert sinks.materialize(two, path).collect() == two.collect()
    with pytest.raises(ValueError):
        sinks.materialize(spark.createDataFrame([("x",)], "a string"), path, refresh=False)


class Cluster:
    """Just enough of a session to ask where staged tables go."""

    def __init__(self, master, setting=None, folder=None):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext = self
        self.master, self.applicationId, self.folder = master, f"app-{id(self)}", folder

    def getCheckpointDir(self):
        return self.folder


def test_staged_tables_go_where_the_session_says():
    assert session.shared_dir(Cluster("yarn", "s3a://bucket/shared/")) == "s3a://bucket/shared"
    assert session.shared_dir(Cluster("local[2]", "/shared")) == "/shared"
    assert session.shared_dir(Cluster("yarn", folder="hdfs://x/y")) == "hdfs://x/y"
    with pytest.raises(ValueError):
        session.shared_dir(Cluster("spark://host:7077"))


def test_staged_table_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, 0.5)], "a int, b string, c double")
    staged = session.stage(df, "abc")
    assert staged.schema == df.schema and sorted(staged.collect(), key=str) == sorted(df.collect(), key=str)


def test_files_of_different_types_are_normalised_one_by_one(spark):
    import datetime as dt

    a = spark.createDataFrame(
        [(bytearray(b"\x12\xab"), bytearray(b"\x01"), dt.datetime(2024, 1, 1), 1.5, "m", "c", "d")],
        "user_id binary, id binary, date timestamp_ntz, amount double, merchant_name string, primary_category string, detailed_category string",
    )
    b = spark.createDataFrame(
        [("b'\\x12\\xab'", None, "2024-01-02", "7"), ("b'\\x12\\xab'", "x", "junk", "junk")],
        "user_id string, id string, date string, amount string",
    )
    c = spark.createDataFrame([(7, 3, 1704067200000000000, 2)], "user_id bigint, id bigint, date bigint, amount int")
    got = tables.normalize_transaction_files([tables.presence_only(f, "id") for f in (a, b, c)])
    rows = sorted(((r.user_id, r.id, r.date, r.amount) for r in got.collect()), key=str)
    assert rows == sorted(
        [
            ("12ab", "1", dt.datetime(2024, 1, 1), 1.5),
            ("12ab", None, dt.datetime(2024, 1, 2), 7.0),
            ("12ab", "1", None, 0.0),
            ("7", "1", dt.datetime(2024, 1, 1), 2.0),
        ],
        key=str,
    )
    numbers = tables.normalize_transaction_files([c, c.select(*[F.col(x) if x != "user_id" else F.lit(" 8 ").alias(x) for x in c.columns])])
    assert dict(numbers.dtypes)["user_id"] == "bigint" and {r.user_id for r in numbers.collect()} == {7, 8}


def test_a_bucketed_table_keeps_its_buckets(spark):
    raw = spark.range(100).selectExpr("id as user_id", "id", "timestamp_ntz'2024-01-01' as date", "1.0d as amount")
    plan = tables.normalize_transactions(raw).select("user_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "cast" not in plan


def test_nan_labels_are_missing(spark):
    labels = tables.normalize_labels(spark.createDataFrame([("a", 1.0), ("b", 0.0), ("c", float("nan"))], "advance_id string, y double"))
    assert supervised.target_column(labels) == "y"
    users = labels.withColumn("user_id", F.col("advance_id"))
    assert {r.user_id: r.y for r in supervised.labelled_users(users, "y").collect()} == {"a": 1, "b": 0, "c": 0}


def test_a_table_is_built_again_only_when_its_inputs_change(spark, tmp_path):
    source, out, built = str(tmp_path / "in"), str(tmp_path / "out"), []

    def build():
        built.append(1)
        return spark.read.parquet(source)

    spark.range(3).write.parquet(source)
    for rows, times in ((3, 1), (3, 1)):
        assert sinks.materialize_once(spark, out, [source], build).count() == rows and len(built) == times
    spark.range(2).write.mode("append").parquet(source)
    assert sinks.materialize_once(spark, out, [source], build).count() == 5 and len(built) == 2
