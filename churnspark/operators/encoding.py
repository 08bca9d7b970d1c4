"""Encode and scale the feature table with Spark ML, and name the result."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.schema import categorical_columns, numeric_columns

UNKNOWN = "unknown"
NUMERIC_VECTOR = "numerical_features"


def fill_unknown(features: DataFrame, missing_numbers: str = "error") -> DataFrame:
    """Unknown categories become a value of their own.

    ``missing_numbers`` is what happens to a null or NaN number: ``error`` leaves it, and the
    assembler stops there; ``zero`` puts 0.
    """
    filled = features.fillna(UNKNOWN, categorical_columns(features))
    if missing_numbers == "zero":
        return filled.fillna(0.0, numeric_columns(features))
    if missing_numbers != "error":
        raise ValueError(f"unknown choice {missing_numbers!r}: use error or zero")
    return filled


def encoder(features: DataFrame, handle_invalid: str = "error", drop_last: bool = True) -> Pipeline:
    """Index and one-hot the categories, assemble all, scale to mean 0 and deviation 1.

    ``handle_invalid`` is what happens to categories unseen in training: ``error`` or ``keep``.
    """
    categories = categorical_columns(features)
    indexed, encoded = [f"{c}_index" for c in categories], [f"{c}_vec" for c in categories]
    return Pipeline(
        stages=[
            StringIndexer(
                inputCols=categories, outputCols=indexed, handleInvalid=handle_invalid,
                stringOrderType="frequencyDesc",
            ),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=drop_last, handleInvalid=handle_invalid),
            VectorAssembler(inputCols=numeric_columns(features), outputCol=NUMERIC_VECTOR),
            VectorAssembler(inputCols=[NUMERIC_VECTOR, *encoded], outputCol="features"),
            StandardScaler(inputCol="features", outputCol="scaled_features", withMean=True, withStd=True),
        ]
    )


def fit_encoder(
    train: DataFrame, handle_invalid: str = "error", drop_last: bool = True, missing_numbers: str = "error"
) -> PipelineModel:
    filled = fill_unknown(train, missing_numbers)
    return encoder(filled, handle_invalid, drop_last).fit(filled)


def encode(features: DataFrame, fitted: PipelineModel, missing_numbers: str = "error") -> DataFrame:
    """Apply a fitted encoder to training, test or new users."""
    return fitted.transform(fill_unknown(features, missing_numbers))


def vector_names(encoded: DataFrame) -> list[str]:
    """Names of the vector slots, read from the metadata of ``features``.

    Numbers keep their column name; the dummies of a category are ``<c>_vec_<i>``, or
    ``<c>_vec`` when there is only one.
    """
    attributes = encoded.schema["features"].metadata["ml_attr"]["attrs"]
    slots = sorted((a for kind in attributes.values() for a in kind), key=lambda a: a["idx"])
    prefix = f"{NUMERIC_VECTOR}_"
    dummies: dict[str, int] = {}
    vector_of = []
    for slot in slots:
        name = slot["name"]
        if name.startswith(prefix):
            vector_of.append((name[len(prefix):], None))
            continue
        vector = next(f"{c}_vec" for c in categorical_columns(encoded) if name.startswith(f"{c}_vec_"))
        vector_of.append((vector, dummies.get(vector, 0)))
        dummies[vector] = dummies.get(vector, 0) + 1
    return [
        name if position is None or dummies[name] == 1 else f"{name}_{position}" for name, position in vector_of
    ]


def model_matrix(encoded: DataFrame, keep: tuple[str, ...] = ("userId", "churn"), vector: str = "scaled_features") -> DataFrame:
    """One named double column per vector slot; stays distributed."""
    names = vector_names(encoded)
    values = encoded.select(*keep, vector_to_array(vector).alias("slots"))
    return values.select(*keep, *[F.col("slots")[i].alias(n) for i, n in enumerate(names)])


def long_matrix(matrix: DataFrame, keep: tuple[str, ...] = ("userId",), value: str = "z") -> DataFrame:
    """(keep, feature, value) from a wide matrix."""
    names = [c for c in matrix.columns if c not in (*keep, "userId", "churn")]
    return matrix.unpivot(list(keep), names, "feature", value)
