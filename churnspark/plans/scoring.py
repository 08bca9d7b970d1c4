"""Batch scoring: from a raw log to probabilities and contributions per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    GBTClassificationModel,
    LogisticRegressionModel,
    RandomForestClassificationModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.operators.encoding import encode, model_matrix, vector_names
from churnspark.operators.explanation import contribution_map, linear_contributions, sampled_shapley
from churnspark.operators.training import AveragedModel, with_probability
from churnspark.operators.tree_explanation import model_contributions
from churnspark.plans.feature_table import feature_table
from churnspark.runtime import materialize


TREE_MODELS = (DecisionTreeClassificationModel, RandomForestClassificationModel, GBTClassificationModel)


def contributions_of(
    encoded: DataFrame,
    model: Model | AveragedModel,
    base: Sequence[float] | None = None,
    permutations: int = 10,
    seed: int = 42,
) -> DataFrame:
    """(userId, feature, value): closed form for a logistic model (scaled features have mean 0), else sampled."""
    names = vector_names(encoded)
    if isinstance(model, LogisticRegressionModel):
        weights = dict(zip(names, model.coefficients.toArray().tolist(), strict=True))
        matrix = model_matrix(encoded, keep=("userId",))
        return linear_contributions(matrix, weights, dict.fromkeys(names, 0.0))
    if not base:
        raise ValueError("sampled contributions need the base of an unknown user")
    return sampled_shapley(encoded, model, names, base, permutations, seed)


def _closed_form(encoded: DataFrame, model: LogisticRegressionModel) -> Column:
    """Map of contributions to the log odds, from the vector of the same row: no explode, no shuffle."""
    names = F.array(*[F.lit(n) for n in vector_names(encoded)])
    weights = F.array(*[F.lit(float(w)) for w in model.coefficients.toArray()])
    values = F.zip_with(vector_to_array("scaled_features"), weights, lambda x, w: x * w)
    return F.map_from_arrays(names, values)


def score_users(
    log: DataFrame,
    fitted_encoder: PipelineModel,
    model: Model | AveragedModel,
    base: Sequence[float] | None = None,
    permutations: int = 10,
    seed: int = 42,
    missing_numbers: str = "error",
) -> DataFrame:
    """``(userId, churn_probability, contributions, units, base_value)`` for every user of a raw log.

    ``units`` says what the contributions add up to above ``base_value``: ``log_odds`` for a
    logistic model (closed form) and boosted trees, ``probability`` for other trees (both exact, one
    pass over the features, nothing shuffled after it) and for all other models (sampled).
    """
    encoded = encode(feature_table(log), fitted_encoder, missing_numbers)
    if isinstance(model, TREE_MODELS) and base is None:
        names = vector_names(encoded)
        # Scored first: the probability goes with the rows that are explained.
        probable = with_probability(model, encoded, "churn_probability")
        explained = model_contributions(probable, model, names, keep=("userId", "churn_probability"))
        return explained.select("userId", "churn_probability", "contributions", "units", "base_value")
    if isinstance(model, LogisticRegressionModel):
        explained = encoded.withColumn("contributions", _closed_form(encoded, model))
        return with_probability(model, explained, "churn_probability").select(
            "userId", "churn_probability", "contributions", F.lit("log_odds").alias("units"),
            F.lit(float(model.intercept)).alias("base_value"),
        )
    scores = with_probability(model, encoded, "churn_probability").select("userId", "churn_probability")
    values = contributions_of(encoded, model, base, permutations, seed)
    explained = contribution_map(values, also=("base_value",))
    return scores.join(explained, "userId").select(
        "userId", "churn_probability", "contributions", F.lit("probability").alias("units"), "base_value"
    )


def ranking(scored: DataFrame, id_column: str = "userId", probability: str = "churn_probability") -> DataFrame:
    """Users by falling probability."""
    return scored.select(id_column, probability).orderBy(F.desc(probability), id_column)


def ranked(scored: DataFrame, id_column: str = "userId", probability: str = "churn_probability") -> DataFrame:
    """(place, user, probability): places from 1 by falling probability, equal ones by id; nulls come last.

    The sort leaves ranges of rows; places are counted inside each, and only one row per range is
    looked at together.
    """
    ordered = scored.select(id_column, probability).orderBy(F.desc_nulls_last(probability), id_column)
    placed = materialize(ordered.withColumn("_row", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("_part", F.shiftright("_row", 33))
    ends = placed.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    ends = ends.select("_part", (before - F.col("_first") + 1).alias("_shift"))
    return placed.join(ends, "_part").select((F.col("_row") + F.col("_shift")).alias("place"), id_column, probability)
