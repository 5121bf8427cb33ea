"""Train the stack, judge it on a holdout, and explain it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.operators import evaluate, importance
from ledgerlift.operators.model import (
    LEARNERS,
    Sizes,
    StackModel,
    cross_validated_scores,
    feature_vector,
    fit_learners,
    fit_stack,
    weight_table,
)
from ledgerlift.operators.rank import global_rank
from ledgerlift.operators.split import stratified_split
from ledgerlift.session import stage

# The cutoffs of the published holdout report.
REPORT_CUTOFFS = (0.05, 0.1, 0.2, 0.3, 0.5)
KEYS = ("user_id", "request_id")


def with_row_id(supervised: DataFrame, target: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Add ``row_id``, a text id from the keys and the target, unique even for conflicting labels."""
    present = [k for k in keys if k in supervised.columns]
    return supervised.withColumn("row_id", F.concat_ws("|", *[F.col(c).cast("string") for c in (*present, target)]))


def feature_names(supervised: DataFrame, target: str, keys: tuple[str, ...] = KEYS) -> list[str]:
    return [c for c in supervised.columns if c not in (*keys, target, "row_id", "split", "fold")]


@dataclass
class RankingReport:
    """The fitted stack, the scored holdout, and its metric tables."""

    model: StackModel
    scored: DataFrame
    cutoffs: DataFrame
    bins: DataFrame
    precision: DataFrame
    auroc: DataFrame
    report: DataFrame
    meta_weights: DataFrame
    folds: DataFrame | None


def train_and_rank(
    supervised: DataFrame, target: str, sizes: Sizes = Sizes(), test_size: float = 0.2, cv_folds: int = 5
) -> RankingReport:
    """Split, cross-validate on the training rows, fit, and judge the holdout as a ranking.

    ``cv_folds=0`` leaves the cross-validation out.
    """
    features = feature_names(supervised, target)
    rows = with_row_id(supervised, target).withColumn("y", F.col(target).cast("int"))
    rows = stage(stratified_split(rows, "y", "row_id", test_size, sizes.seed), "split")
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    folds = None
    if cv_folds:
        folds = evaluate.fold_metrics(cross_validated_scores(train, features, "y", "row_id", sizes, cv_folds))
    model = fit_stack(train, features, "y", "row_id", sizes)
    keys = [k for k in KEYS if k in rows.columns]
    scored = model.score(test).select(*keys, F.col("row_id").alias("id"), "y", "p")
    scored = stage(scored, "scored")
    ranked = global_rank(scored)
    return RankingReport(
        model=model,
        scored=scored,
        cutoffs=evaluate.precision_at_cutoffs(ranked, REPORT_CUTOFFS, ranked=True),
        bins=evaluate.calibration(scored),
        precision=evaluate.precision_at_threshold(scored),
        auroc=evaluate.auroc(scored),
        report=evaluate.class_report(scored),
        meta_weights=weight_table(supervised.sparkSession, model),
        folds=folds,
    )


def single_model_importances(
    supervised: DataFrame, target: str, sizes: Sizes = Sizes(), test_size: float = 0.2, repeats: int = 7
) -> DataFrame:
    """Importances of each base learner fitted alone on unscaled training rows.

    Learners without an importance of their own are permuted on the holdout.
    """
    features = feature_names(supervised, target)
    rows = with_row_id(supervised, target).withColumn("y", F.col(target).cast("int"))
    rows = stage(stratified_split(rows, "y", "row_id", test_size, sizes.seed), "split")
    table = rows.select(F.col("row_id").alias("id"), "y", "split", feature_vector(features).alias("features"))
    train, test = table.where("split = 'train'"), table.where("split = 'test'")
    learners = fit_learners(train, "y", "id", LEARNERS, sizes, boost_weight="none")
    parts = [importance.learner_importance(learner, test, features, repeats) for learner in learners.values()]
    return reduce(DataFrame.unionByName, parts)


def stack_importances(
    model: StackModel, rows: DataFrame, label: str, id: str, repeats: int = 5, skip: tuple[str, ...] = ("rf",)
) -> DataFrame:
    """Importances of the stack's own base learners on ``rows``, leaving out those in ``skip``."""
    prepared = model.prepare(rows).select(F.col(id).alias("id"), F.col(label).cast("int").alias("y"), "features")
    prepared = stage(prepared, "prepared")
    parts = [
        importance.learner_importance(learner, prepared, model.features, repeats)
        for name, learner in model.learners.items()
        if name not in skip
    ]
    if not parts:
        raise ValueError("every base learner is skipped")
    return reduce(DataFrame.unionByName, parts)


def meta_importance(
    supervised: DataFrame, target: str, sizes: Sizes = Sizes(), repeats: int = 5, top_k: int | None = None,
    holdout: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Combined importance, importances per model, and meta weights of a stack fitted on all rows.

    Permutations use the same rows unless a ``holdout`` is given.
    """
    features = feature_names(supervised, target)
    rows = stage(with_row_id(supervised, target), "all")
    model = fit_stack(rows, features, target, "row_id", sizes)
    judged = rows if holdout is None else with_row_id(holdout, target)
    per_model = stage(stack_importances(model, judged, target, "row_id", repeats), "importances")
    weights = weight_table(supervised.sparkSession, model)
    if not any(w for name, w in model.weights().items() if name != "rf"):
        raise ValueError("all meta weights are zero")
    combined = importance.meta_weighted(per_model, weights)
    return (importance.top_features(combined, top_k) if top_k else combined), per_model, weights

