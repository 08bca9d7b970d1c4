"""Train, evaluate and compare classifiers with and without calibration."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.operators.evaluation import evaluation_summary, metrics_long, pr_curve, roc_curve, score_counts
from churnspark.operators.training import (
    SEARCH_SPACES,
    adaptive_search,
    classifiers,
    meta_learner,
    out_of_fold,
    scored_table,
    train_calibrated,
    train_classifier,
    train_stacking,
    weighted_rows,
)
from churnspark.runtime import materialize


@dataclass
class Experiment:
    """What a run leaves behind: tables, fitted models and chosen parameters."""

    metrics: DataFrame | None = None
    pr_curves: DataFrame | None = None
    roc_curves: DataFrame | None = None
    models: dict = field(default_factory=dict)
    parameters: dict = field(default_factory=dict)

    def add(self, name: str, model, scored: DataFrame) -> None:
        self.models[name] = model
        counts = materialize(score_counts(scored), "score-counts")
        parts = {
            "metrics": metrics_long(evaluation_summary(scored, counts=counts), name),
            "pr_curves": pr_curve(scored, counts).select(F.lit(name).alias("model"), "*"),
            "roc_curves": roc_curve(scored, counts).select(F.lit(name).alias("model"), "*"),
        }
        for attribute, part in parts.items():
            known = getattr(self, attribute)
            setattr(self, attribute, part if known is None else known.unionByName(part))


def run_experiment(
    train: DataFrame,
    test: DataFrame,
    estimators: Mapping[str, Estimator] | None = None,
    spaces: Mapping[str, Mapping[str, tuple]] = SEARCH_SPACES,
    trials: int = 20,
    seed: int = 42,
    stacking: bool = True,
    calibrate: bool = True,
) -> Experiment:
    """Search, fit and evaluate every classifier; then its calibrated twin.

    ``train`` and ``test`` are encoded tables. The loop on the driver only submits Spark
    jobs; training rows are stored once because every trial reads them.
    """
    estimators = dict(estimators or classifiers(seed))
    train = materialize(weighted_rows(train), "train")
    test = materialize(test, "test")
    result = Experiment()

    def keep(name: str, model) -> None:
        result.add(name, model, materialize(scored_table(model, test), "scored"))

    for name, estimator in estimators.items():
        drawn, _ = adaptive_search(train, estimator, spaces[name], trials, seed)
        result.parameters[name] = drawn
        keep(name, train_classifier(train, estimator, drawn))
    if stacking:
        # The meta-learner is searched on the probabilities it is trained on.
        held_out = materialize(out_of_fold(train, estimators, seed), "out-of-fold")
        drawn, _ = adaptive_search(held_out, meta_learner(), spaces["stacking"], trials, seed)
        result.parameters["stacking"] = drawn
        keep("stacking", train_stacking(train, estimators, held_out, drawn))
    if calibrate:
        for name, estimator in estimators.items():
            keep(f"calibrated_{name}", train_calibrated(train, estimator, result.parameters[name], seed))
    return result
