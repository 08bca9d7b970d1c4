"""Classifiers, search, stacking and calibration on Spark ML."""

from __future__ import annotations

import json
import random
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import HasTrainingSummary
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.operators.evaluation import f_beta
from churnspark.operators.search import minimise, random_draw
from churnspark.operators.split import with_class_weight, with_folds
from churnspark.runtime import materialize
from churnspark.schema import ID_COLUMN, LABEL_COLUMN

VECTOR = "scaled_features"
WEIGHT = "weight"
# Folds that are fitted side by side; each submits its own Spark jobs.
PARALLEL_FOLDS = 4

# Search spaces per classifier, as (kind, low, high[, step]).
SEARCH_SPACES: dict[str, dict[str, tuple]] = {
    "logistic_regression": {"C": ("uniform", 0.01, 10.0)},
    "random_forest": {"numTrees": ("quniform", 10, 1000, 10), "maxDepth": ("quniform", 1, 20, 1)},
    "decision_tree": {"maxDepth": ("quniform", 1, 20, 1)},
    "gradient_boosting": {
        "maxIter": ("quniform", 10, 1000, 10),
        "maxDepth": ("quniform", 1, 20, 1),
        "stepSize": ("uniform", 0.01, 1.0),
    },
    "gradient_boosting_unweighted": {
        "maxIter": ("quniform", 10, 1000, 10),
        "maxDepth": ("quniform", 1, 20, 1),
        "stepSize": ("uniform", 0.01, 1.0),
    },
    "stacking": {"C": ("uniform", 0.01, 10.0)},
}


def classifiers(seed: int = 42, weighted: bool = True) -> dict[str, Estimator]:
    """The base classifiers over the scaled vector, balanced by the weight column.

    ``gradient_boosting_unweighted`` never reads the weights.
    """
    plain = {"featuresCol": VECTOR, "labelCol": LABEL_COLUMN}
    columns = {**plain, "weightCol": WEIGHT} if weighted else plain
    return {
        "logistic_regression": LogisticRegression(maxIter=5000, **columns),
        "random_forest": RandomForestClassifier(seed=seed, **columns),
        "decision_tree": DecisionTreeClassifier(seed=seed, **columns),
        "gradient_boosting": GBTClassifier(seed=seed, **columns),
        "gradient_boosting_unweighted": GBTClassifier(seed=seed, **plain),
    }


def draw_parameters(space: Mapping[str, tuple], trials: int, seed: int) -> list[dict[str, float | int]]:
    """Seeded random draws; a value without a fraction becomes an int."""
    generator = random.Random(seed)
    return [random_draw(space, generator) for _ in range(trials)]


def spark_parameters(estimator: Estimator, drawn: Mapping[str, float | int], n_rows: int) -> dict:
    """Spark params of a draw. ``C`` weighs the summed loss, ``regParam`` the mean loss."""
    translated = {}
    for name, value in drawn.items():
        if name == "C":
            translated[estimator.getParam("regParam")] = 1.0 / (float(value) * n_rows)
        else:
            param = estimator.getParam(name)
            translated[param] = float(value) if name == "stepSize" else value
    return translated


def fold_scores(
    train: DataFrame, estimator: Estimator, seed: int = 42, folds: int = 3, parallelism: int = 4, id_column: str = ID_COLUMN
) -> Callable[[Sequence[Mapping[str, float | int]]], list[float]]:
    """A function from draws to their mean F2 over folds that share out each label.

    ``C`` is translated by the rows that a fold trains on. F2 is 0 where it is undefined, as in a fold
    without positive rows. All folds of all draws run side by side; each submits its own Spark jobs.
    """
    folded = materialize(with_folds(train, folds, seed, id_column=id_column), "folds")
    sizes = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}
    total = sum(sizes.values())
    used = [f for f in sizes if sizes[f] < total]

    def score(task: tuple[Mapping[str, float | int], int]) -> float:
        drawn, fold = task
        rest = folded.where(F.col("fold") != fold)
        model = estimator.copy(spark_parameters(estimator, drawn, total - sizes[fold])).fit(rest)
        predicted = without_summary(model).transform(folded.where(F.col("fold") == fold))
        return f_beta(predicted.select(F.col(LABEL_COLUMN).alias("label"), "prediction")).first()[0]

    def scores(draws: Sequence[Mapping[str, float | int]]) -> list[float]:
        with ThreadPool(parallelism) as pool:
            found = pool.map(score, [(drawn, fold) for drawn in draws for fold in used], chunksize=1)
        many = max(len(used), 1)
        return [sum(found[i * len(used) : (i + 1) * len(used)]) / many for i in range(len(draws))]

    return scores


def random_search(
    train: DataFrame,
    estimator: Estimator,
    space: Mapping[str, tuple],
    trials: int = 20,
    seed: int = 42,
    folds: int = 3,
    parallelism: int = 4,
    id_column: str = ID_COLUMN,
) -> tuple[dict[str, float | int], float]:
    """The parameters of the random draw with the highest mean F2 over folds (see ``fold_scores``), and that mean."""
    draws = draw_parameters(space, trials, seed)
    means = fold_scores(train, estimator, seed, folds, parallelism, id_column)(draws)
    best = max(range(trials), key=lambda i: means[i])
    return draws[best], means[best]


def adaptive_search(
    train: DataFrame,
    estimator: Estimator,
    space: Mapping[str, tuple],
    trials: int = 20,
    seed: int = 42,
    folds: int = 3,
    parallelism: int = 4,
    round_size: int = 4,
    id_column: str = ID_COLUMN,
) -> tuple[dict[str, float | int], float]:
    """As ``random_search``, with draws that learn from the trials of earlier rounds (see ``search``)."""
    scores = fold_scores(train, estimator, seed, folds, parallelism, id_column)
    found = minimise(space, lambda draws: [-s for s in scores(draws)], trials, seed, round_size)
    drawn, loss = found.best()
    return drawn, -loss


def train_classifier(
    train: DataFrame, estimator: Estimator, drawn: Mapping[str, float | int] | None = None
) -> Model:
    """Fit with the given parameters on the weighted training rows."""
    parameters = spark_parameters(estimator, drawn or {}, train.count() if drawn and "C" in drawn else 1)
    return estimator.copy(parameters).fit(train)


def weighted_rows(train: DataFrame) -> DataFrame:
    return with_class_weight(train, LABEL_COLUMN, WEIGHT)


def _renamed(estimator: Estimator, suffix: str) -> Estimator:
    """The estimator with output columns of its own, so that several can follow each other."""
    return estimator.copy(
        {
            estimator.getParam("predictionCol"): f"prediction_{suffix}",
            estimator.getParam("probabilityCol"): f"probability_{suffix}",
            estimator.getParam("rawPredictionCol"): f"raw_{suffix}",
        }
    )


def _positive(suffix: str, source: str = "probability") -> VectorSlicer:
    """Stage that takes the positive class out of a probability or raw vector."""
    return VectorSlicer(inputCol=f"{source}_{suffix}", outputCol=f"positive_{suffix}", indices=[1])


def _stack_assembler(bases: Mapping[str, Estimator]) -> VectorAssembler:
    return VectorAssembler(inputCols=[f"positive_{n}" for n in bases], outputCol="stacked")


def meta_learner() -> LogisticRegression:
    """Its penalty falls on the probabilities as they are."""
    return LogisticRegression(featuresCol="stacked", labelCol=LABEL_COLUMN, maxIter=5000, standardization=False)


def out_of_fold(
    train: DataFrame, bases: Mapping[str, Estimator], seed: int = 42, folds: int = 5, id_column: str = ID_COLUMN
) -> DataFrame:
    """Probabilities of every training row by base models that did not see it.

    Within a fold the base models run one after another over the same rows, so nothing
    is joined. Returns (id, label, stacked).
    """
    marked = materialize(with_folds(train, folds, seed, id_column=id_column), "folds")
    assemble = _stack_assembler(bases)

    def predicted(fold: int) -> DataFrame:
        rows = marked.where(F.col("fold") == fold)
        for name, base in bases.items():
            model = _renamed(base, name).fit(marked.where(F.col("fold") != fold))
            rows = _positive(name).transform(without_summary(model).transform(rows))
        return assemble.transform(rows).select(id_column, LABEL_COLUMN, "stacked")

    with ThreadPool(PARALLEL_FOLDS) as pool:
        parts = pool.map(predicted, range(folds))
    return reduce(DataFrame.unionByName, parts)


def train_stacking(
    train: DataFrame,
    bases: Mapping[str, Estimator],
    held_out: DataFrame,
    drawn: Mapping[str, float | int] | None = None,
) -> PipelineModel:
    """Logistic regression over ``out_of_fold`` probabilities, with refitted base models.

    The result is a plain ``PipelineModel``: base models, assembler, meta-learner.
    """
    fitted = train_classifier(held_out, meta_learner(), drawn)
    stages = [s for n, b in bases.items() for s in (_renamed(b, n).fit(train), _positive(n))]
    return PipelineModel(stages=[*stages, _stack_assembler(bases), fitted])


class AveragedModel:
    """Mean positive probability of several pipelines (one per calibration fold)."""

    def __init__(self, parts: Sequence[PipelineModel]):
        self.parts = list(parts)

    def score(self, rows: DataFrame, column: str = "score") -> DataFrame:
        names = [f"{column}_{i}" for i in range(len(self.parts))]
        for part, name in zip(self.parts, names, strict=True):
            rows = with_probability(part, rows, name)
        mean = sum((F.col(n) for n in names[1:]), F.col(names[0])) / len(names)
        return rows.withColumn(column, mean).drop(*names)

    def save(self, path: str) -> None:
        """Write every part, then what ``load`` needs: the class and the number of parts."""
        for i, part in enumerate(self.parts):
            part.write().overwrite().save(f"{path}/part-{i}")
        described = json.dumps({"class": type(self).__name__, "parts": len(self.parts)})
        rows = SparkSession.active().createDataFrame([(described,)], "value string")
        rows.coalesce(1).write.mode("overwrite").text(f"{path}/metadata")

    @classmethod
    def load(cls, path: str) -> AveragedModel:
        described = json.loads(SparkSession.active().read.text(f"{path}/metadata").first()["value"])
        if described["class"] != cls.__name__:
            raise ValueError(f"{path} holds a {described['class']}, not a {cls.__name__}")
        return cls([PipelineModel.load(f"{path}/part-{i}") for i in range(described["parts"])])


def without_summary(model: Model) -> Model:
    """A copy that tasks can receive: the same model without the summary of its training.

    A model is sent to the tasks with its summary, and the summary holds the session. A session
    that has counted rows with an ``Observation``, as ``materialize`` does on a cluster, cannot be sent.
    """
    if isinstance(model, PipelineModel):
        return PipelineModel(stages=[without_summary(s) for s in model.stages])
    if not isinstance(model, HasTrainingSummary) or not model.hasSummary:
        return model
    bare = model.copy()
    # No public call takes a summary away.
    bare._java_obj.setSummary(SparkSession.active().sparkContext._jvm.scala.Option.empty())
    return bare


def with_probability(model: Model | AveragedModel, rows: DataFrame, column: str = "score") -> DataFrame:
    """Add the positive-class probability; no other column is left behind."""
    if isinstance(model, AveragedModel):
        return model.score(rows, column)
    scored = without_summary(model).transform(rows)
    return scored.select(*rows.columns, vector_to_array("probability")[1].alias(column))


def scored_table(model: Model | AveragedModel, rows: DataFrame, id_column: str = "userId") -> DataFrame:
    """``(id, label, score)`` for the evaluation operators."""
    return with_probability(model, rows, "score").select(
        F.col(id_column).alias("id"), F.col(LABEL_COLUMN).alias("label"), "score"
    )


def _soft_targets(rows: DataFrame, vector: str) -> DataFrame:
    """Each row twice, weighted towards smoothed targets (Platt, 1999)."""
    positives = rows.agg(F.count_if(F.col(LABEL_COLUMN) == 1)).scalar()
    negatives = rows.agg(F.count_if(F.col(LABEL_COLUMN) == 0)).scalar()
    target = F.when(F.col(LABEL_COLUMN) == 1, (positives + 1) / (positives + 2)).otherwise(1 / (negatives + 2))
    halves = F.array(
        F.struct(F.lit(1.0).alias("target"), target.alias("part")),
        F.struct(F.lit(0.0).alias("target"), (1 - target).alias("part")),
    )
    return rows.select(vector, F.explode(halves).alias("half")).select(vector, "half.*")


def train_calibrated(
    train: DataFrame, estimator: Estimator, drawn: Mapping[str, float | int] | None = None, seed: int = 42, folds: int = 5
) -> AveragedModel:
    """Sigmoid calibration: per fold a classifier on the rest and a sigmoid on the fold.

    Folds share out each label; one whose other rows lack a class is left out.
    The sigmoid reads the margin of linear and boosted models and the probability of the others.
    """
    marked = materialize(with_folds(train, folds, seed), "folds")
    by_label = {(r["fold"], r[LABEL_COLUMN]): r["count"] for r in marked.groupBy("fold", LABEL_COLUMN).count().collect()}
    sizes: dict[int, int] = {}
    for (fold, _), n in by_label.items():
        sizes[fold] = sizes.get(fold, 0) + n
    total = sum(sizes.values())
    labels = {label for _, label in by_label}
    # A fold is left out if the others lack one of the classes: nothing can be fitted there.
    usable = [f for f in sizes if all(any(o != f and v == label for o, v in by_label) for label in labels)]
    if not usable:
        raise ValueError("every class needs rows in at least two folds")
    source = "raw" if isinstance(estimator, (LogisticRegression, GBTClassifier)) else "probability"

    def calibrated(fold: int) -> PipelineModel:
        name = f"fold{fold}"
        parameters = spark_parameters(estimator, drawn or {}, total - sizes[fold])
        base = _renamed(estimator.copy(parameters), name).fit(marked.where(F.col("fold") != fold))
        positive = _positive(name, source)
        held_out = positive.transform(without_summary(base).transform(marked.where(F.col("fold") == fold)))
        sigmoid = LogisticRegression(
            featuresCol=f"positive_{name}", labelCol="target", weightCol="part", standardization=False
        ).fit(_soft_targets(held_out.select(LABEL_COLUMN, f"positive_{name}"), f"positive_{name}"))
        return PipelineModel(stages=[base, positive, sigmoid])

    with ThreadPool(PARALLEL_FOLDS) as pool:
        parts = pool.map(calibrated, sorted(usable))
    return AveragedModel(parts)
