"""Per-user contributions of features to a prediction."""

from __future__ import annotations

import json
import random
from collections.abc import Mapping, Sequence

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.operators.training import AveragedModel, with_probability

def linear_contributions(
    rows: DataFrame, coefficients: Mapping[str, float], means: Mapping[str, float], id_column: str = "userId"
) -> DataFrame:
    """Closed form on the logit: w_j (x_j - mean_j) per user and feature; no shuffle."""
    entries = [
        F.struct(F.lit(name).alias("feature"), ((F.col(name) - F.lit(float(means[name]))) * F.lit(float(w))).alias("value"))
        for name, w in coefficients.items()
    ]
    return rows.select(id_column, F.explode(F.array(*entries)).alias("entry")).select(id_column, "entry.*")


def column_means(rows: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Mean per column: one number each comes to the driver."""
    return rows.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()


def background(rows: DataFrame, vector: str = "scaled_features") -> list[float]:
    """The mean of every vector slot over all rows: what a feature is replaced by when it is unknown."""
    return rows.agg(Summarizer.mean(F.col(vector)).alias("mean")).first()["mean"].toArray().tolist()


def sampled_shapley(
    rows: DataFrame,
    model: Model | AveragedModel,
    names: Sequence[str],
    base: Sequence[float],
    permutations: int = 10,
    seed: int = 42,
    vector: str = "scaled_features",
    id_column: str = "userId",
) -> DataFrame:
    """Permutation-sampled Shapley values of the positive probability: (id, feature, value, base_value).

    ``base`` holds the slot values of an unknown user (see ``background``). Along each of the
    drawn feature orders the base is replaced by the user's own values, one feature at a time;
    the change of the probability at a step belongs to the feature replaced there. Every user
    takes ``permutations * (features + 1)`` rows of one job: explode, predict, and a sum that is
    combined before its shuffle. Users are dealt evenly over all cores before that. The values of a user add up to f(user) minus ``base_value``.
    """
    generator = random.Random(seed)
    n = len(names)
    orders = []
    for _ in range(permutations):
        position = list(range(n))
        generator.shuffle(position)
        # Where each feature stands in the order, and which feature stands at each place of it.
        orders.append({"position": position, "feature": sorted(range(n), key=position.__getitem__)})
    # Constants in the plan: (2 x features x permutations) and (features) numbers.
    order_table = F.from_json(F.lit(json.dumps(orders)), "array<struct<position: array<int>, feature: array<int>>>")
    unknown = F.from_json(F.lit(json.dumps([float(b) for b in base])), "array<double>")
    # Dealt out before they multiply: stored users are few bytes, and so come in few partitions.
    users = rows.select(id_column, vector_to_array(vector).alias("x")).repartition(_tasks(rows.sparkSession))
    steps = (
        users.withColumn("base", unknown)
        .withColumn("order", F.explode(order_table))
        .withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(n))))
    )
    replaced = F.transform(
        "order.position", lambda place, i: F.when(place < F.col("step"), F.col("x")[i]).otherwise(F.col("base")[i])
    )
    hybrids = steps.select(id_column, "step", "order.feature", array_to_vector(replaced).alias(vector))
    predicted = with_probability(model, hybrids, "probability_of_step")
    # A step's probability counts for the feature just replaced and against the next one.
    gained = F.struct(F.get("feature", F.col("step") - 1).alias("slot"), F.lit(1.0).alias("sign"))
    next_one = F.struct(F.get("feature", F.col("step")).alias("slot"), F.lit(-1.0).alias("sign"))
    shares = predicted.select(
        id_column, "probability_of_step", F.explode(F.array(gained, next_one)).alias("share")
    ).where(F.col("share.slot").isNotNull())
    summed = shares.groupBy(id_column, "share.slot").agg(
        (F.sum(F.col("share.sign") * F.col("probability_of_step")) / permutations).alias("value")
    )
    feature = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("slot") + 1)
    values = summed.select(id_column, feature.alias("feature"), "value")
    return values.withColumn("base_value", F.lit(base_value(rows.sparkSession, model, base, vector)))


def _tasks(spark: SparkSession) -> int:
    """Partitions for rows that multiply in their task: a few per core, no fewer than a shuffle has."""
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def base_value(spark: SparkSession, model: Model | AveragedModel, base: Sequence[float], vector: str = "scaled_features") -> float:
    """The positive probability of an unknown user."""
    one = spark.createDataFrame([(Vectors.dense([float(b) for b in base]),)], [vector])
    return float(with_probability(model, one, "f").first()["f"])


def contribution_map(contributions: DataFrame, id_column: str = "userId", also: Sequence[str] = ()) -> DataFrame:
    """One map feature -> value per user (at most one entry per feature), and what all its rows share."""
    entries = F.collect_list(F.struct("feature", "value"))
    shared = [F.max(c).alias(c) for c in also]
    return contributions.groupBy(id_column).agg(F.map_from_entries(F.array_sort(entries)).alias("contributions"), *shared)


def importance(contributions: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature."""
    return contributions.groupBy("feature").agg(F.avg(F.abs("value")).alias("importance"))


def signed_contributions(contributions: DataFrame, user: str | None = None, id_column: str = "userId") -> DataFrame:
    """Contributions with their direction, of one user or of all."""
    rows = contributions if user is None else contributions.where(F.col(id_column) == user)
    return rows.withColumn("direction", F.when(F.col("value") >= 0, "up").otherwise("down"))
