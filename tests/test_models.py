"""Split, encoding, training, explanation and scoring on the derived users."""

from __future__ import annotations

import itertools
import re

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Observation
from pyspark.sql import functions as F

from churnspark import schema
from churnspark.operators import encoding, evaluation, explanation, split, training
from churnspark.plans import scoring
from churnspark.plans.experiment import run_experiment
from churnspark.plans.feature_table import feature_table
from churnspark.runtime import materialize
from churnspark.sources.derived_log import event_log
from churnspark.sources.events_io import write_metrics

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def features(spark):
    return feature_table(event_log(spark, SF))


@pytest.fixture(scope="module")
def encoder(features):
    return encoding.fit_encoder(split.split(features)[0], handle_invalid="keep")


@pytest.fixture(scope="module")
def train(features, encoder):
    return materialize(training.weighted_rows(encoding.encode(split.split(features)[0], encoder)), "train")


@pytest.fixture(scope="module")
def test(features, encoder):
    return materialize(encoding.encode(split.split(features)[1], encoder), "test")


@pytest.fixture(scope="module")
def tree(train):
    return training.train_classifier(train, training.classifiers()["decision_tree"], {"maxDepth": 3})


def test_column_roles(features):
    assert len(features.columns) == 37
    assert len(schema.feature_columns(features)) == 35
    assert schema.categorical_columns(features) == ["gender", "level", "platform", "browser"]
    assert len(schema.numeric_columns(features)) == 31
    assert not {"userId", "churn"} & set(schema.numeric_columns(features))


def test_split_is_stable_and_exact_split_keeps_shares(features):
    hashed = {r.userId: r.is_train for r in split.with_split(features).collect()}
    again = {r.userId: r.is_train for r in split.with_split(features.repartition(7)).collect()}
    assert hashed == again
    exact = split.with_split(features, exact=True)
    for row in exact.groupBy("churn").agg(F.count_if("is_train").alias("train"), F.count("*").alias("n")).collect():
        assert abs(row.train - 0.8 * row.n) <= 0.5
    train_rows, test_rows = split.split(features, exact=True)
    assert train_rows.count() + test_rows.count() == features.count()


def test_split_works_for_three_labels(spark):
    rows = spark.range(300).select(F.col("id").cast("string").alias("userId"), (F.col("id") % 3).alias("churn"))
    counts = split.with_split(rows, 0.5, exact=True).where("is_train").groupBy("churn").count().collect()
    assert {r.churn: r["count"] for r in counts} == {0: 50, 1: 50, 2: 50}


def test_class_weights_and_ratios(spark):
    rows = spark.createDataFrame([(str(i), int(i < 3)) for i in range(12)], "userId string, churn int")
    got = {r.churn: r for r in split.class_weights(rows).collect()}
    assert (got[0].weight, got[1].weight) == (12 / 18, 2.0)
    assert got[0].ratio_of_weights == pytest.approx(got[0].weight / got[1].weight)
    assert got[1].balanced_ratio == 3.0
    assert split.with_class_weight(rows).agg(F.sum("weight")).first()[0] == pytest.approx(12.0)


def test_unseen_category_fails_or_is_kept(spark, features):
    known = features.where("platform = 'Windows' OR platform IS NULL")
    unseen = features.where("platform = 'Linux'")
    strict = encoding.fit_encoder(known)
    with pytest.raises(Exception, match="(?i)unseen"):
        encoding.encode(unseen, strict).select("scaled_features").collect()
    kept = encoding.encode(unseen, encoding.fit_encoder(known, handle_invalid="keep"))
    assert kept.count() == unseen.count()


def test_names_scaling_and_pipeline_round_trip(features, tmp_path):
    constant = features.withColumn("num_help", F.lit(4).cast("long"))
    fitted = encoding.fit_encoder(constant)
    encoded = encoding.encode(constant, fitted)
    names = encoding.vector_names(encoded)
    assert names[:3] == ["num_sessions", "num_unique_artists", "num_nextsong"]
    assert names[31:] == [
        "gender_vec", "level_vec", *[f"platform_vec_{i}" for i in range(4)], *[f"browser_vec_{i}" for i in range(3)],
    ]
    matrix = encoding.model_matrix(encoded)
    row = matrix.agg(F.avg("tenure"), F.stddev_samp("tenure"), F.max(F.abs("num_help"))).first()
    assert tuple(row) == (pytest.approx(0.0, abs=1e-9), pytest.approx(1.0), 0.0)
    fitted.write().overwrite().save(str(tmp_path / "encoder"))
    loaded = encoding.encode(constant, PipelineModel.load(str(tmp_path / "encoder")))
    assert encoding.model_matrix(loaded).exceptAll(matrix).count() == 0


def test_parameter_draws():
    space = training.SEARCH_SPACES["gradient_boosting"]
    draws = training.draw_parameters(space, 50, seed=7)
    assert draws == training.draw_parameters(space, 50, seed=7)
    assert draws != training.draw_parameters(space, 50, seed=8)
    for d in draws:
        assert isinstance(d["maxDepth"], int)
        assert 1 <= d["maxDepth"] <= 20
        assert d["maxIter"] % 10 == 0
        assert 0.01 <= d["stepSize"] <= 1.0
    logistic = training.classifiers()["logistic_regression"]
    translated = training.spark_parameters(logistic, {"C": 4.0}, n_rows=100)
    assert {p.name: v for p, v in translated.items()} == {"regParam": 1 / 400}


def test_every_classifier_trains_and_scores(train, test):
    small = {"random_forest": {"numTrees": 5, "maxDepth": 3}, "gradient_boosting": {"maxIter": 3, "maxDepth": 2}}
    small["gradient_boosting_unweighted"] = small["gradient_boosting"]
    for name, estimator in training.classifiers().items():
        model = training.train_classifier(train, estimator, small.get(name, {}))
        scored = training.scored_table(model, test)
        low, high, n = scored.agg(F.min("score"), F.max("score"), F.count("*")).first()
        assert 0.0 <= low <= high <= 1.0
        assert n == test.count()
        assert scored.columns == ["id", "label", "score"]


def test_random_search_is_seeded(train):
    estimator = training.classifiers()["decision_tree"]
    space = {"maxDepth": ("quniform", 1, 4, 1)}
    first = training.random_search(train, estimator, space, trials=2, seed=5)
    assert first == training.random_search(train, estimator, space, trials=2, seed=5)
    assert 1 <= first[0]["maxDepth"] <= 4
    assert 0.0 <= first[1] <= 1.0


def test_model_round_trip(tree, test, tmp_path):
    tree.write().overwrite().save(str(tmp_path / "tree"))
    loaded = type(tree).load(str(tmp_path / "tree"))
    before = training.scored_table(tree, test)
    assert training.scored_table(loaded, test).exceptAll(before).count() == 0


def test_calibrated_model_round_trip(train, test, tmp_path):
    estimator = training.classifiers()["decision_tree"]
    model = training.train_calibrated(train, estimator, {"maxDepth": 2}, folds=3)
    scored = training.scored_table(model, test)
    assert scored.columns == ["id", "label", "score"]
    low, high = scored.agg(F.min("score"), F.max("score")).first()
    assert 0.0 < low <= high < 1.0
    model.save(str(tmp_path / "calibrated"))
    loaded = training.AveragedModel.load(str(tmp_path / "calibrated"))
    assert training.scored_table(loaded, test).exceptAll(scored).count() == 0


def test_experiment_compares_models(train, test, tmp_path):
    plain = train.drop("weight")
    estimators = {n: e for n, e in training.classifiers().items() if n in ("logistic_regression", "decision_tree")}
    spaces = {
        "logistic_regression": {"C": ("uniform", 0.01, 10.0)}, "decision_tree": {"maxDepth": ("quniform", 1, 3, 1)},
        "stacking": {"C": ("uniform", 0.01, 10.0)},
    }
    result = run_experiment(plain, test, estimators, spaces, trials=1)
    models = {"logistic_regression", "decision_tree", "stacking", "calibrated_logistic_regression", "calibrated_decision_tree"}
    assert set(result.models) == models
    assert set(result.parameters) == {"logistic_regression", "decision_tree", "stacking"}
    metrics = result.metrics.collect()
    assert len(metrics) == 12 * len(models)
    assert all(0.0 <= r.value <= 1.0 for r in metrics if r.metric != "log_loss")
    assert {r.model for r in result.pr_curves.select("model").distinct().collect()} == models
    assert {r.model for r in result.roc_curves.select("model").distinct().collect()} == models
    write_metrics(result.metrics, str(tmp_path / "metrics"))
    assert test.sparkSession.read.json(str(tmp_path / "metrics")).count() == len(metrics)
    result.models["stacking"].write().overwrite().save(str(tmp_path / "stacking"))
    loaded = PipelineModel.load(str(tmp_path / "stacking"))
    expected = training.scored_table(result.models["stacking"], test)
    assert training.scored_table(loaded, test).exceptAll(expected).count() == 0


def test_sampled_shapley_adds_up(tree, train, test):
    names = encoding.vector_names(test)
    unknown = explanation.background(train, training.VECTOR)
    assert len(unknown) == len(names)
    values = explanation.sampled_shapley(test, tree, names, unknown, permutations=6, seed=1)
    sums = {r.userId: r.s for r in values.groupBy("userId").agg(F.sum("value").alias("s")).collect()}
    base = values.first().base_value
    assert base == pytest.approx(explanation.base_value(test.sparkSession, tree, unknown))
    for row in training.with_probability(tree, test).select("userId", "score").collect():
        assert sums[row.userId] == pytest.approx(row.score - base, abs=1e-9)
    again = explanation.sampled_shapley(test.repartition(3), tree, names, unknown, permutations=6, seed=1)
    assert {(r.userId, r.feature, round(r.value, 9)) for r in again.collect()} == {
        (r.userId, r.feature, round(r.value, 9)) for r in values.collect()
    }


def test_sampled_shapley_deals_out_few_partitions(tree, train, test, capsys):
    """Users that lie in one partition are spread over the cores before their rows multiply."""
    names = encoding.vector_names(test)
    unknown = explanation.background(train, training.VECTOR)
    together = test.coalesce(1)
    explanation.sampled_shapley(together, tree, names, unknown, permutations=2, seed=1).explain()
    plan = capsys.readouterr().out
    dealt = re.search(r"RoundRobinPartitioning\((\d+)\)", plan)
    assert dealt and int(dealt[1]) >= 4 * test.sparkSession.sparkContext.defaultParallelism
    assert plan.rindex("Generate") < dealt.start()


def test_sampled_shapley_near_the_exact_values(spark):
    """Three features, one background row: compare with the average over all orders."""
    from pyspark.ml.classification import LogisticRegression

    rows = spark.createDataFrame(
        [(str(i), float(i % 2), float(i % 3), float(i % 5), int(i % 2 and i % 3 > 0)) for i in range(60)],
        "userId string, a double, b double, c double, churn int",
    ).withColumn("scaled_features", array_to_vector(F.array("a", "b", "c")))
    model = LogisticRegression(featuresCol="scaled_features", labelCol="churn", regParam=0.1).fit(rows)
    one = rows.where("userId = '5'")
    x, base = [1.0, 2.0, 0.0], [0.0, 1.0, 3.0]

    def probability(v):
        frame = spark.createDataFrame([(v,)], "x array<double>").select(array_to_vector("x").alias("scaled_features"))
        return training.with_probability(model, frame).first()["score"]

    exact = [0.0, 0.0, 0.0]
    for order in itertools.permutations(range(3)):
        current = list(base)
        for j in order:
            before = probability(current)
            current[j] = x[j]
            exact[j] += (probability(current) - before) / 6
    got = explanation.sampled_shapley(one, model, ["a", "b", "c"], base, permutations=400, seed=2)
    values = {r.feature: r.value for r in got.collect()}
    assert [values["a"], values["b"], values["c"]] == pytest.approx(exact, abs=0.02)


def test_score_users_shape_and_logit(spark, features, encoder, train, tree):
    log = event_log(spark, SF)
    logistic = training.train_classifier(train, training.classifiers()["logistic_regression"], {"C": 0.5})
    scored = scoring.score_users(log, encoder, logistic)
    assert [f.dataType for f in scored.schema] == [f.dataType for f in schema.SCORED_USERS]
    rows = scored.collect()
    assert len(rows) == features.count()
    for r in rows:
        logit = logistic.intercept + sum(r.contributions.values())
        assert r.churn_probability == pytest.approx(1 / (1 + 2.718281828459045**-logit), abs=1e-6)
    ranked = scoring.ranking(scored).collect()
    assert [r.churn_probability for r in ranked] == sorted((r.churn_probability for r in rows), reverse=True)
    # Trees are explained exactly: no base of an unknown user is asked for.
    for r in scoring.score_users(log, encoder, tree).collect():
        assert r.units == "probability"
        assert r.base_value + sum(r.contributions.values()) == pytest.approx(r.churn_probability, abs=1e-9)


def test_importance_and_direction(spark):
    values = spark.createDataFrame([("u", "a", -2.0), ("v", "a", 4.0), ("u", "b", 0.0)], "userId string, feature string, value double")
    assert {r.feature: r.importance for r in explanation.importance(values).collect()} == {"a": 3.0, "b": 0.0}
    assert {(r.feature, r.direction) for r in explanation.signed_contributions(values, "u").collect()} == {("a", "down"), ("b", "up")}
    assert explanation.contribution_map(values.where("userId = 'u'")).first().contributions == {"a": -2.0, "b": 0.0}


def test_fbeta_without_predictions(spark):
    rows = spark.createDataFrame([("u", 1, 0), ("v", 0, 0)], "id string, label int, prediction int")
    assert evaluation.f_beta(rows).first().f_beta == 0.0


def test_search_with_a_single_positive_row(spark):
    rows = spark.createDataFrame(
        [(str(i), [float(i), float(i % 3)], int(i == 0), 1.0) for i in range(30)],
        "userId string, x array<double>, churn int, weight double",
    ).withColumn(training.VECTOR, array_to_vector("x"))
    space = {"maxDepth": ("quniform", 1, 3, 1)}
    drawn, score = training.random_search(rows, training.classifiers()["decision_tree"], space, trials=2)
    assert 1 <= drawn["maxDepth"] <= 3 and 0.0 <= score <= 1.0
    model = training.train_calibrated(rows, training.classifiers()["decision_tree"], {"maxDepth": 2}, folds=3)
    assert training.scored_table(model, rows).count() == 30


def test_models_are_sent_to_tasks_without_their_summaries(spark):
    """A session that has counted rows with an ``Observation`` (``materialize`` on a cluster) cannot be sent."""
    session = spark.newSession()
    rows = session.createDataFrame(
        [(str(i), [float(i), float(i % 3)], int(i % 4 == 0), 1.0) for i in range(40)],
        "userId string, x array<double>, churn int, weight double",
    ).withColumn(training.VECTOR, array_to_vector("x"))
    counted = Observation()
    assert len(rows.observe(counted, F.count(F.lit(1)).alias("rows")).collect()) == counted.get["rows"]
    bases = {
        "logistic_regression": training.classifiers()["logistic_regression"].copy({LogisticRegression.maxIter: 5}),
        "random_forest": training.classifiers()["random_forest"].copy({RandomForestClassifier.numTrees: 2}),
    }
    models = [training.train_classifier(rows, estimator) for estimator in bases.values()]
    models.append(training.train_stacking(rows, bases, training.out_of_fold(rows, bases, folds=2)))
    models.append(training.train_calibrated(rows, bases["logistic_regression"], folds=2))
    assert models[0].hasSummary
    for model in models:
        assert training.scored_table(model, rows).where("score between 0 and 1").count() == 40
    assert len(training.fold_scores(rows, bases["logistic_regression"], folds=2)([{"C": 1.0}])) == 1


def test_folds_share_out_every_label(spark):
    from churnspark.operators.split import with_folds

    rows = spark.createDataFrame([(str(i), int(i % 10 == 0)) for i in range(100)], "userId string, churn int")
    sizes = {(r.churn, r.fold): r["count"] for r in with_folds(rows, 3).groupBy("churn", "fold").count().collect()}
    assert len(sizes) == 6
    assert all(sizes[(0, f)] == 30 for f in range(3)) and sorted(sizes[(1, f)] for f in range(3)) == [3, 3, 4]


def test_everything_is_training_at_a_share_of_one(spark):
    from churnspark.operators.split import split

    rows = spark.range(5000).select(F.col("id").cast("string").alias("userId"), F.lit(1).alias("churn"))
    train, rest = split(rows, 1.0)
    assert train.count() == 5000 and rest.count() == 0


def test_rounding_leaves_large_values_alone(spark):
    from churnspark.workloads.queries import rounded

    values = [1e13, 3.5e15, -2e14, float("inf"), float("-inf"), 1.2345678, None]
    got = [r[0] for r in rounded(spark.createDataFrame([(v,) for v in values], "x double")).collect()]
    assert got == [*values[:5], 1.234568, None]
    assert str(rounded(spark.createDataFrame([(float("nan"),)], "x double")).first()[0]) == "nan"


def test_missing_numbers_stop_the_encoder_or_become_zero(spark, features):
    gaps = features.withColumn("tenure", F.lit(None).cast("double"))
    fitted = encoding.fit_encoder(gaps, handle_invalid="keep", missing_numbers="zero")
    assert encoding.encode(gaps, fitted, missing_numbers="zero").where("scaled_features is null").count() == 0
    with pytest.raises(Exception, match="null|NULL|Null"):
        encoding.fit_encoder(gaps, handle_invalid="keep")
