import random

from test_features import T0, day

from ledgerlift import __main__ as job
from ledgerlift.plans import profiling


def test_whole_job_writes_every_report(spark, tmp_path):
    rng = random.Random(4)
    advances = [(f"r{u}", u, day(rng.randrange(5))) for u in range(120)]
    labels = [(f"r{u}", u % 2) for u in range(120)]
    tx = [(u * 9 + k, u, day(-k - 1), rng.uniform(1, 9) * (1 + 3 * (u % 2)), rng.choice("abc"), "FOOD", "d") for u in range(120) for k in range(6)]
    spark.createDataFrame(advances, "request_id string, user_id bigint, underwritten_at timestamp_ntz").write.parquet(f"{tmp_path}/adv")
    spark.createDataFrame(labels, "advance_id string, late int").write.parquet(f"{tmp_path}/lab")
    spark.createDataFrame(
        tx, "id bigint, user_id bigint, date timestamp_ntz, amount double, merchant_name string, primary_category string, detailed_category string"
    ).write.parquet(f"{tmp_path}/tx")
    args = ["--advances", f"{tmp_path}/adv", "--labels", f"{tmp_path}/lab", "--transactions", f"{tmp_path}/tx", f"{tmp_path}/absent",
            "--out", f"{tmp_path}/out", "--small", "--cv-folds", "0", "--user-id-type", "bigint"]
    job.run(spark, job.parse(args))
    written = {p.name for p in (tmp_path / "out").iterdir()}
    assert {"supervised", "precision_at_cutoffs", "predictions_holdout", "meta_weights", "class_report"} <= written
    predictions = spark.read.option("header", True).csv(f"{tmp_path}/out/predictions_holdout")
    assert predictions.columns == ["user_id", "request_id", "y_pred", "y_pred_proba", "y_true"]
    assert predictions.count() == 24
    auroc = spark.read.option("header", True).option("inferSchema", True).csv(f"{tmp_path}/out/holdout_auroc").first()[0]
    assert auroc > 0.8


def test_profiles_of_several_tables(spark):
    tables = {
        "a": spark.createDataFrame([(1, None), (1, T0)], "user_id bigint, t timestamp_ntz"),
        "b": spark.createDataFrame([(0.5,)], "x double"),
    }
    assert {tuple(r) for r in profiling.table_shapes(tables).collect()} == {("a", 2, 2, 4), ("b", 1, 1, 1)}
    assert {tuple(r) for r in profiling.table_nulls(tables).collect()} == {("a", "user_id", 0.0), ("a", "t", 0.5), ("b", "x", 0.0)}
    assert [tuple(r) for r in profiling.key_counts(tables).collect()] == [("a", 1)]
    assert profiling.table_schemas(tables).count() == 3


def test_profiles_as_a_command(spark, tmp_path):
    spark.createDataFrame([(1, 2.0), (1, None), (2, 5.0)], "user_id bigint, x double").write.parquet(f"{tmp_path}/a")
    spark.createDataFrame([("q",)], "name string").write.option("header", True).csv(f"{tmp_path}/b.csv")
    job.run(spark, job.parse(["--profile", f"a={tmp_path}/a", f"b={tmp_path}/b.csv", "--out", f"{tmp_path}/out"]))
    read = lambda name: {tuple(r) for r in spark.read.option("header", True).option("inferSchema", True).csv(f"{tmp_path}/out/{name}").collect()}
    assert read("shapes") == {("a", 3, 2, 6), ("b", 1, 1, 1)}
    assert read("keys") == {("a", 2)}
    assert ("a", "x", 1 / 3) in read("missing")
    assert {(r[0], r[1], r[5]) for r in read("summary_a")} == {("user_id", 3, 1.0), ("x", 2, 2.75)}
