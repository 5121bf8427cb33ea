"""The registered model queries fit the published sizes; here only what they ask for is looked at."""

import pytest

from ledgerlift.catalog import model_queries as Q
from ledgerlift.operators.model import Sizes


class Asked(Exception):
    pass


@pytest.fixture
def asked(monkeypatch):
    """The sizes, folds and repeats of the calls, none of which is carried out."""
    calls = {}

    def note(name, result=None):
        def call(*args, **named):
            found = [a for a in args if isinstance(a, Sizes)]
            calls[name] = (found[0] if found else None, named)
            if result is None:
                raise Asked
            return result

        return call

    class Model:
        learners, features = {"svc": None}, []

        def prepare(self, rows):
            return rows

    monkeypatch.setattr(Q, "_once", lambda v, what, build: build())
    monkeypatch.setattr(Q, "supervised", lambda v: v)
    monkeypatch.setattr(Q.ranking, "feature_names", lambda rows, target: [])
    monkeypatch.setattr(Q, "fit_stack", note("fit_stack", Model()))
    monkeypatch.setattr(Q, "cross_validated_scores", note("cross_validated_scores"))
    monkeypatch.setattr(Q.ranking, "train_and_rank", note("train_and_rank"))
    monkeypatch.setattr(Q.ranking, "single_model_importances", note("single_model_importances"))
    monkeypatch.setattr(Q.ranking, "stack_importances", note("stack_importances"))
    monkeypatch.setattr(Q.importance, "permutation_importance", note("permutation_importance"))
    return calls


@pytest.mark.parametrize(
    "name,call,sizes,named",
    [
        ("holdout_report", "train_and_rank", Sizes(), {"cv_folds": 5}),
        ("cross_validation", "cross_validated_scores", Sizes(), {"folds": 5}),
        ("importance_single_models", "single_model_importances", Sizes(), {"repeats": 7}),
        ("importance_permutation", "permutation_importance", None, {"repeats": 7}),
        ("importance_meta", "stack_importances", None, {"repeats": 5}),
    ],
)
def test_published_sizes(spark, asked, name, call, sizes, named):
    rows = spark.createDataFrame([], "row_id string, target int, features array<double>")
    with pytest.raises(Asked):
        getattr(Q, name)(rows)
    assert asked[call] == (sizes, named)
    if sizes is None:
        assert asked["fit_stack"][0] == Sizes()
