import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from ledgerlift.operators import cohort, diversity, flow, spending, supervised
from ledgerlift.plans import features

T0 = dt.datetime(2024, 6, 1)
TX = "id bigint, user_id bigint, date timestamp_ntz, amount double, merchant_name string, primary_category string, detailed_category string"
ANCHORS = "user_id bigint, underwritten_at timestamp_ntz"


def day(n, hour=0):
    return T0 + dt.timedelta(days=n, hours=hour)


def test_first_per_column_and_row(spark):
    rows = [(1, 10, None, day(1)), (1, 11, "b", day(2)), (2, 12, "late", None), (2, 13, "dated", day(5)), (None, 14, "x", day(0)),
            (3, 16, "tie", day(1)), (3, 15, "first", day(1))]
    df = spark.createDataFrame(rows, "user_id bigint, request_id bigint, a string, t timestamp_ntz")
    by_column = {r.user_id: r for r in cohort.first_per_key(df, "user_id", "t", "request_id").collect()}
    by_row = {r.user_id: r for r in cohort.first_per_key(df, "user_id", "t", "request_id", "row").collect()}
    assert (by_column[1].a, by_column[1].t, by_column[1].request_id) == ("b", day(1), 10)
    assert (by_row[1].a, by_row[1].t) == (None, day(1))
    assert by_column[2].a == by_row[2].a == "dated"
    assert by_column[3].a == by_row[3].a == "first"
    assert set(by_column) == set(by_row) == {1, 2, 3}


def test_lookback_edges_and_short_history(spark):
    tx = [
        (1, 1, day(-30), 5.0, "m", "FOOD", "d"),  # the edge is inside
        (2, 1, day(0), 5.0, "n", "FOOD", "d"),  # the anchor itself is outside
        (3, 1, day(-31), 5.0, "o", "CAR", "e"),
        (None, 1, day(-1), 5.0, None, None, None),
        (4, 2, day(-1), 5.0, None, "FOOD", "d"),
        (5, 2, day(-1), 5.0, None, "FOOD", "d"),
        (6, 3, None, 5.0, "m", "FOOD", "d"),
        (7, 5, day(-9), 5.0, "m", "FOOD", "d"),
    ] + [(20 + i, 4, day(-2), 1.0, "abac"[i % 4], "FOOD", "d") for i in range(4)]
    anchors = [(1, T0), (2, T0), (3, T0), (4, T0), (5, None), (6, T0)]
    got = diversity.diversity_features(spark.createDataFrame(tx, TX), spark.createDataFrame(anchors, ANCHORS))
    got = {r.user_id: r for r in got.collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6}
    one = got[1]
    assert (one.unique_merchants_30d, one.unique_merchants_60d, one.unique_merchants_all_time) == (1, 2, 2)
    assert (one.transaction_count_30d, one.total_transactions_all_time) == (1, 2)  # the row without id is not counted
    assert (one.time_span_days, one.days_since_last_transaction) == (30, 1)
    assert (got[2].merchant_concentration, got[2].unique_merchants_all_time, got[2].recurring_merchants_count) == (0, 0, 0)
    assert got[2].transaction_frequency_all_time == 2.0
    assert got[4].transaction_frequency_all_time == 4.0 and got[4].time_span_days == 0
    assert got[4].merchant_concentration == (4 + 1 + 1) / 16
    for user in (3, 5, 6):
        assert all(v == 0 for k, v in got[user].asDict().items() if k != "user_id")


@pytest.mark.parametrize("over, expected", [("transactions", 0.625), ("merchants", 2.5)])
def test_concentration_of_three_and_one(spark, over, expected):
    rows = [(i, 1, day(-1), 1.0, m, "FOOD", "d") for i, m in enumerate("aaab")]
    got = diversity.merchant_concentration(spark.createDataFrame(rows, TX), over).first()
    assert got.merchant_concentration == expected


def test_exploratory_variant_fills_with_max(spark):
    tx = [(1, 1, day(-3), 5.0, "m", "FOOD", "d"), (2, 2, day(-8), 5.0, "m", "FOOD", "d")]
    anchors = spark.createDataFrame([(1, T0), (2, T0), (3, T0)], ANCHORS)
    got = diversity.diversity_features(spark.createDataFrame(tx, TX), anchors, variant="exploratory")
    assert {r.user_id: r.days_since_last_transaction for r in got.collect()} == {1: 3, 2: 8, 3: 8}
    assert "time_span_days" not in got.columns and "recurring_merchant_pct" in got.columns
    nobody = diversity.diversity_features(spark.createDataFrame([], TX), anchors, variant="exploratory")
    assert {r.days_since_last_transaction for r in nobody.collect()} == {0}


def test_flow_ratio_without_income(spark):
    tx = spark.createDataFrame(
        [(1, 1, T0, 500.0, "m", "FOOD", "d"), (2, 2, T0, -40.0, "m", "TRANSFER_IN", "d"), (3, 3, T0, 9.0, "m", "INCOME", "d"),
         (4, 4, T0, 9.0, "m", None, "d"), (5, None, T0, 9.0, "m", "FOOD", "d")], TX)
    got = {r.user_id: r for r in flow.flow_metrics(tx).collect()}
    assert set(got) == {1, 2}
    assert (got[1].outflow_inflow_ratio, got[1].income_spent_pct) == (500.0, 10.0)
    assert (got[2].total_inflow, got[2].total_transfer_in, got[2].total_income) == (40.0, 40.0, 0.0)


def test_category_without_spending_is_a_zero_column(spark):
    tx = spark.createDataFrame([(1, 1, T0, 5.0, "m", "FOOD", "d"), (2, 1, T0, -5.0, "m", "a.b", "d")], TX)
    got = spending.spending_shares(tx)
    assert got.columns == ["user_id", "FOOD", "a.b", "total_spending"]
    assert got.first().asDict() == {"user_id": 1, "FOOD": 1.0, "a.b": 0.0, "total_spending": 5.0}


def test_no_outflow_at_all(spark):
    tx = spark.createDataFrame([(1, 1, T0, -5.0, "m", "FOOD", "d")], TX)
    anchors = spark.createDataFrame([(1, T0), (2, T0)], ANCHORS)
    got = spending.spending_shares(tx, anchors)
    assert got.columns == ["user_id", "total_spending"]
    assert {r.user_id: r.total_spending for r in got.collect()} == {1: 0.0, 2: 0.0}


def test_too_many_categories_is_an_error(spark):
    tx = spark.createDataFrame([(i, 1, T0, 5.0, "m", f"c{i}", "d") for i in range(5)], TX)
    with pytest.raises(ValueError, match="more than 4"):
        spending.spending_categories(tx, limit=4)


def test_labels(spark):
    joined = spark.createDataFrame([(1, 1), (1, 0), (1, 1), (2, None), (None, 1)], "user_id bigint, target int")
    pairs = {tuple(r) for r in supervised.labelled_users(joined, "target").collect()}
    assert pairs == {(1, 1), (1, 0), (2, 0)}
    pairs = {tuple(r) for r in supervised.labelled_users(joined, "target", drop_null_labels=True).collect()}
    assert pairs == {(1, 1), (1, 0)}


def test_binary_detection(spark):
    df = spark.createDataFrame(
        [(5, "0", None, 1.0, True, None), (6, "1", None, 0.0, None, None)],
        "a int, b string, c string, d double, e boolean, f int",
    )
    flags = {r.column_name: r.is_binary for r in supervised.binary_columns(df).collect()}
    assert flags == {"a": False, "b": False, "c": True, "d": True, "e": True, "f": True}
    assert supervised.target_column(df) == "c"
    with pytest.raises(ValueError):
        supervised.target_column(df.select("a", "b"))


def test_numeric_matrix(spark):
    df = spark.createDataFrame(
        [("u", 1, float("inf"), "1", "x", True), ("v", None, float("nan"), "2.5", "1", False)],
        "user_id string, a int, b double, c string, d string, e boolean",
    )
    got = supervised.numeric_matrix(df, keep=("user_id",))
    assert [tuple(r) for r in got.collect()] == [("u", 1.0, 0.0, 1.0), ("v", 0.0, 0.0, 2.5)]


def test_mismatched_keys_are_refused(spark):
    tx = spark.createDataFrame([], TX)
    anchors = spark.createDataFrame([("1", T0)], "user_id string, underwritten_at timestamp_ntz")
    with pytest.raises(TypeError):
        diversity.before_anchor(tx, anchors)


def random_tx(spark, n=4000, users=40, hot_share=0.4, seed=1):
    """Random transactions in which one user has a large share of all rows."""
    rng = random.Random(seed)
    categories = ["FOOD", "CAR", "RENT", "INCOME", "TRANSFER_IN", None]
    rows = []
    for i in range(n):
        user = 0 if rng.random() < hot_share else rng.randrange(users)
        category = rng.choice(categories)
        value = round(rng.uniform(-50, 100), 2)
        rows.append((i, user, day(-rng.randrange(200), rng.randrange(24)) + dt.timedelta(days=60), value,
                     rng.choice([None, *"abcdefgh"]), category, rng.choice([None, *"xyz"])))
    return spark.createDataFrame(rows, TX)


@pytest.mark.parametrize("broadcast", [True, False])
def test_one_scan_features_equal_separate_blocks(spark, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before if broadcast else "-1")
    try:
        tx = random_tx(spark)
        anchors = spark.createDataFrame([(u, T0 + dt.timedelta(hours=7 * u)) for u in range(50)], ANCHORS)
        names = spending.spending_categories(tx).names
        blocks = [spending.spending_shares(tx), diversity.diversity_features(tx, anchors), flow.flow_metrics(tx)]
        expected = supervised.assemble(anchors.select("user_id"), blocks)
        got = supervised.assemble(anchors.select("user_id"), [diversity.user_features(tx, anchors, names)])
        assert set(got.columns) == set(expected.columns)
        columns = sorted(got.columns)
        a = sorted(tuple(r) for r in got.select(columns).collect())
        b = sorted(tuple(r) for r in expected.select(columns).collect())
        assert a == b
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_feature_invariants(spark):
    tx = random_tx(spark, n=500)  # few enough rows for every feature to vary between users
    anchors = spark.createDataFrame([(u, T0) for u in range(40)], ANCHORS)
    names = spending.spending_categories(tx).names
    rows = diversity.user_features(tx, anchors, names).collect()
    for r in rows:
        assert sum(r[n] for n in names) == pytest.approx(1.0 if r.total_spending else 0.0)
        assert r.total_outflow == r.total_spending
        assert r.unique_merchants_30d <= r.unique_merchants_60d <= r.unique_merchants_90d <= r.unique_merchants_all_time
        if r.unique_merchants_all_time:
            assert 1 / r.unique_merchants_all_time <= r.merchant_concentration * (1 + 1e-12) <= 1 + 1e-9
    for name in rows[0].__fields__:
        assert len({r[name] for r in rows}) > 1, name


def test_as_of_ignores_later_money(spark):
    tx = spark.createDataFrame([(1, 1, day(-1), 5.0, "m", "FOOD", "d"), (2, 1, day(1), 7.0, "m", "CAR", "d")], TX)
    anchors = spark.createDataFrame([(1, T0)], ANCHORS)
    assert diversity.user_features(tx, anchors, ["CAR", "FOOD"], as_of=True).first().total_spending == 5.0
    assert diversity.user_features(tx, anchors, ["CAR", "FOOD"]).first().total_spending == 12.0


def test_load_supervised_from_files(spark, tmp_path):
    advances = spark.createDataFrame(
        [(bytearray(b"\x01"), "1", "2024-06-01"), (bytearray(b"\x02"), "1", "2024-07-01"), (bytearray(b"\x03"), "2", "junk")],
        "request_id binary, user_id string, underwritten_at string",
    )
    labels = spark.createDataFrame([(r"b'\x01'", 1), (r"b'\x03'", 0)], "advance_id string, default int")
    tx = spark.createDataFrame([("7", "1", "2024-05-20", "12.50", "m", "FOOD", "d")], "id string, user_id string, date string, amount string, merchant_name string, primary_category string, detailed_category string")
    for name, df in (("advances", advances), ("labels", labels), ("tx", tx)):
        df.write.parquet(str(tmp_path / name))
    got = features.load_supervised(
        spark, str(tmp_path / "advances"), str(tmp_path / "labels"), [str(tmp_path / "tx"), str(tmp_path / "none")]
    )
    rows = {r.user_id: r for r in got.collect()}
    assert (rows[1].default, rows[1].request_id, rows[1].FOOD, rows[1].total_spending) == (1, "01", 1.0, 12.5)
    assert (rows[1].unique_merchants_30d, rows[1].days_since_last_transaction) == (1, 12)
    assert (rows[2].default, rows[2].total_spending) == (0, 0.0)


def test_overlap_counts_distinct_keys(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k bigint")
    b = spark.createDataFrame([("1",), ("3",), (None,), ("2",)], "j string")
    assert cohort.key_overlap(a, "k", b, "j").first().shared_keys == 2
    assert cohort.keep_known_users(a, a.where("k = 1"), "k").count() == 2


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_totals_are_right_or_an_error(spark, ansi):
    from ledgerlift.functions.arithmetic import exact_sum

    was = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:

        def total(amounts):
            df = spark.createDataFrame([(1, a) for a in amounts], "k int, a double").repartition(3)
            return df.groupBy("k").agg(exact_sum(F.col("a")).alias("t"), exact_sum(F.col("a"), F.col("a") > 0).alias("p")).first()

        assert tuple(total([4e14, 5e14, -8e14, 0.0001])) == (1, 1e14 + 0.0001, 9e14 + 0.0001)
        assert tuple(total([None, None])) == (1, 0.0, 0.0)
        for amounts in ([1e15], [-1e300], [5e14, 5e14]):
            with pytest.raises(Exception, match="beyond the range"):
                total(amounts)
        assert spark.createDataFrame([], "a double").agg(exact_sum(F.col("a"))).first()[0] == 0.0
    finally:
        spark.conf.set("spark.sql.ansi.enabled", was)
