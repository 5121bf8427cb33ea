"""What the physical plans must and must not contain."""

import random

import pytest
from pyspark.sql import functions as F
from test_features import ANCHORS, T0, random_tx

from ledgerlift.catalog import QUERIES
from ledgerlift.catalog.views import Views
from ledgerlift.operators import cohort, diversity, flow, rank, spending

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# Queries that fit models, which map features in a pandas UDF.
MODEL = ("stack_", "meta_weights", "holdout_", "cross_validation", "importance_")


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(MODEL)])
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin", "Expand"):
        if bad == "Expand" and name in ("distinct_counts", "approximate_distinct_within", "key_counts", "describe", "outliers"):
            continue  # unpivot
        assert bad not in plan, bad


def test_features_scan_transactions_once_and_shuffle_by_more_than_the_user(spark, no_broadcast):
    tx = random_tx(spark)
    anchors = spark.createDataFrame([(u, T0) for u in range(50)], ANCHORS)
    plan = plan_of(diversity.user_features(tx, anchors, ["FOOD", "CAR", "RENT"]))
    assert plan.count("SortMergeJoin") == 1
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 4
    assert sum("hashpartitioning(user_id" in e for e in exchanges) == 2  # the join itself
    assert sum("hashpartitioning(anchor" in e and "value" in e for e in exchanges) == 1
    assert plan.count("partial_") and "Window" not in plan


def test_largest_recency_takes_no_second_pass(spark, no_broadcast):
    tx = random_tx(spark)
    anchors = spark.createDataFrame([(u, T0) for u in range(50)], ANCHORS)
    got = diversity.diversity_features(tx, anchors, variant="exploratory")
    plan = plan_of(got)
    assert "Join" not in plan and "keys=[anchor" not in plan
    assert got.count() == 50


def test_transactions_are_made_small_before_they_move(spark, no_broadcast):
    plan = plan_of(Views(spark, SF).tx())
    assert "AS kind" in plan[plan.index("Exchange hashpartitioning(l_orderkey") :]
    # The categories that occur need no merchants.
    tx = Views(spark, SF).tx()
    plan = plan_of(tx.where("primary_category is not null").groupBy("primary_category").agg(F.bool_or(F.col("amount") > 0)))
    assert "p_type" in plan and "s_suppkey" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    v = Views(spark, SF)
    plan = QUERIES["income_totals"](spark, SF)._jdf.queryExecution().toString()
    assert "l_returnflag" in plan and "l_tax" not in plan.split("== Physical Plan ==")[1]
    lineitem = v.table("lineitem").where(F.col("l_returnflag") == "R").select("l_orderkey")
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan_of(lineitem)


def test_flow_is_one_shuffle(spark):
    plan = plan_of(flow.flow_metrics(random_tx(spark)))
    assert plan.count("Exchange") == 1 and plan.count("partial_try_sum") >= 1
    plan = plan_of(spending.spending_pivot(random_tx(spark), ["FOOD", "CAR"]))
    assert plan.count("Exchange") == 1


def test_first_row_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("u"), F.col("id").alias("t"), F.col("id").alias("r"))
    plan = plan_of(cohort.first_per_key(df, "u", "t", "r", "row"))
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[exchange:] and "Partial" in plan[exchange:]
    plan = plan_of(cohort.first_per_key(df, "u", "t", "r"))
    assert "partial_min_by" in plan[plan.index("Exchange") :]


def test_ranking_never_uses_one_partition_for_rows(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(i, rng.random()) for i in range(1000)], "id bigint, p double")
    plan = plan_of(rank.global_rank(df))
    before, single, after = plan.partition("Exchange SinglePartition")
    # The only single partition is fed by the per-partition row counts.
    assert single and "HashAggregate(keys=[_part" in after and plan.count("SinglePartition") == 1


def test_distinct_keys_meet_reduced(spark):
    a = spark.range(100).select((F.col("id") % 7).alias("k"))
    plan = plan_of(cohort.key_overlap(a, "k", a, "k"))
    assert plan.count("HashAggregate") >= 4 and "LeftSemi" in plan
