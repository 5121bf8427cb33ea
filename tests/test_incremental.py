"""Appending files gives what building from all of them gives."""

import pytest
from pyspark.sql import functions as F
from test_features import ANCHORS, T0, random_tx

from ledgerlift.operators import diversity
from ledgerlift.plans.incremental import FeatureState


@pytest.mark.parametrize("as_of", [False, True])
def test_append_equals_rebuild(spark, tmp_path, as_of):
    tx = random_tx(spark).withColumn("n", F.pmod(F.hash("id", "date"), F.lit(3)))
    parts = [tx.where(F.col("n") == k).drop("n") for k in range(3)]
    # The last file touches some users only, and brings a category of its own.
    parts[2] = parts[2].where("user_id % 4 = 0")
    new = F.when(F.col("id") % 5 == 0, F.lit("NEW")).otherwise(F.col("primary_category"))
    parts[2] = parts[2].withColumn("primary_category", new)
    anchors = spark.createDataFrame([(u, T0) for u in range(50)], ANCHORS)
    state = FeatureState(spark, str(tmp_path / "state"), as_of=as_of)
    state.begin(anchors)
    with pytest.raises(ValueError):
        state.features()
    state.append(parts[0])
    features = state.features()
    for part in parts[1:]:
        before = spark.createDataFrame(features.collect(), features.schema)
        touched = state.append(part)
        features = state.refresh(before, touched)
        untouched = before.join(touched, "user_id", "left_anti").count()
        assert features.count() == untouched + touched.count()
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    rebuilt = diversity.user_features(whole, anchors, state.categories(), as_of=as_of)
    assert "NEW" in rebuilt.columns
    assert sorted(map(str, features.select(*rebuilt.columns).collect())) == sorted(map(str, rebuilt.collect()))
    state.compact()
    assert sorted(map(str, state.features().select(*rebuilt.columns).collect())) == sorted(map(str, rebuilt.collect()))
