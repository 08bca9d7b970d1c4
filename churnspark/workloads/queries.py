"""Named queries over the derived log; each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnspark.functions import agents
from churnspark.operators import (
    cleaning,
    encoding,
    evaluation,
    explanation,
    features,
    hist_boosting,
    kernel_explanation,
    profile,
    split,
    statistics,
    training,
    tree_explanation,
)
from churnspark.plans import scoring
from churnspark.plans.experiment import run_experiment
from churnspark.plans.preprocess import clean_log, preprocess
from churnspark.runtime import materialize, new_path
from churnspark.schema import EVENT_LOG, numeric_columns
from churnspark.sources import events_io
from churnspark.sources.derived_log import event_log
from churnspark.workloads.fixtures import document_scores, event_scores, sampled_agents, user_scores, with_gaps

Query = Callable[[SparkSession, str], DataFrame]


def _round_scaled(value: Column, digits: int) -> Column:
    """Scale, round half away from zero, scale back: binary rounding as most SQL engines do it.

    Spark's ``round`` works on the shortest decimal text of a double and so differs where
    that text ends in a 5. Values whose scaled size a double cannot tell from its neighbours
    (2^53 and more), NaN and infinity stay as they are.
    """
    scale = float(10**digits)
    near = F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / scale
    return F.when(F.abs(value) * scale < 2.0**53, near).otherwise(value)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles for comparison: sums differ in their last bits between plans."""
    return df.select(
        *[_round_scaled(F.col(c), digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_log(event_log(spark, sf_dir))


def _stored_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature columns of the cleaned log, written once for jobs that scan it several times."""
    return materialize(features.feature_inputs(_clean(spark, sf_dir)), "clean-log")


def _on_log(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(operator(event_log(spark, sf_dir)))


def _on_clean(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(operator(_clean(spark, sf_dir)))


def _on_stored(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(operator(_stored_clean(spark, sf_dir)))


# --- sources and sinks ---------------------------------------------------------------


def _scan_json(with_schema: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = new_path(spark, "log-json")
        event_log(spark, sf_dir).write.json(path)
        read = events_io.read_events(spark, path, EVENT_LOG if with_schema else None)
        return rounded(read.select(*EVENT_LOG.names))

    return run


def _sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "preprocessed")
    events_io.write_table(preprocess(event_log(spark, sf_dir)), path)
    return rounded(events_io.read_table(spark, path))


def _base_queries() -> dict[str, Query]:
    return {
        "scan_json": _scan_json(False),
        "scan_json_schema": _scan_json(True),
        "sink_parquet": _sink_parquet,
        "clean_events": _on_log(cleaning.drop_incomplete_users),
        "listening_flag": _on_clean(lambda log: log.select("userId", "ts", "page", "song", "Listening")),
        "content_clean": _on_clean(
            lambda log: cleaning.drop_partial_songs(log).select("userId", "ts", "page", "artist", "song", "Listening")
        ),
        "rows_with_missing": _on_log(
            lambda log: cleaning.rows_with_missing(log).select(
                "userId", "ts", "page", "artist", "firstName", "length", "registration", "userAgent"
            )
        ),
        "churn_label": _on_log(lambda log: cleaning.with_churn_label(log).select("userId", "ts", "page", "churn")),
        "preprocess": _on_log(preprocess),
        "agent_platform_browser": _on_clean(
            lambda log: log.select("userId", "ts", "userAgent", "platform", "browser")
        ),
        "location_parts": _on_clean(
            lambda log: cleaning.with_location_parts(log.select("location").distinct())
        ),
        "state_region": _on_clean(
            lambda log: cleaning.with_region(cleaning.with_location_parts(log)).select("userId", "ts", "State", "Region")
        ),
        "user_base_features": _on_stored(features.user_base_features),
        "page_counts": _on_clean(features.page_counts),
        "songs_per_session": _on_clean(features.songs_per_session),
        "session_gaps": _on_stored(features.session_gaps),
        "action_proportions": _on_stored(features.action_proportions),
        "listening_time": _on_clean(features.listening_time),
        "artists_per_session": _on_stored(features.artists_per_session),
        "user_features": _on_stored(features.user_features),
    }


# --- exploration ------------------------------------------------------------------------


def _placed(log: DataFrame, column: str) -> DataFrame:
    """The cleaned log with agent text, city, state or region, whichever is asked for."""
    if column == "Agent":
        return log.withColumn("Agent", F.concat("platform", F.lit("/"), "browser"))
    if column in ("City", "State"):
        return cleaning.with_location_parts(log)
    return cleaning.with_region(cleaning.with_location_parts(log)) if column == "Region" else log


def _with_flag(log: DataFrame) -> DataFrame:
    return log.withColumn("churn", cleaning.churn_event())


def _distribution(column: str) -> Query:
    return _on_clean(lambda log: profile.user_distribution(_placed(log, column), column))


def _crosstab(column: str) -> Callable[[DataFrame], DataFrame]:
    return lambda log: profile.crosstab(_with_flag(_placed(log, column)), column)


def _chi2(column: str) -> Query:
    return _on_clean(
        lambda log: statistics.chi_squared(_crosstab(column)(log), "churn", "value").select("n", "dof", "chi2")
    )


def _chi2_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five attributes from one stored table with a row per user."""
    log = _with_flag(_placed(_clean(spark, sf_dir), "Region"))
    users = materialize(cleaned_users(log), "users")
    tests = [
        statistics.chi_squared(users.groupBy("churn", F.col(c).alias("value")).agg(F.count("*").alias("n")), "churn", "value")
        .select(F.lit(c).alias("attribute"), "*")
        for c in CROSSED
    ]
    return rounded(reduce(DataFrame.unionByName, tests))


def _sketch_rank_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per kind of event and share: whether the sketch of the values keeps its error bound, measured exactly."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_type", "value")
    errors = profile.sketch_rank_errors(events, ["event_type"], "value", [0.05, 0.25, 0.5, 0.75, 0.95], size=200)
    return errors.select("event_type", "share", (F.col("error") <= F.col("bound")).alias("within_bound"))


def _agent_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Platform, browser and version of the agents of all events, from their tokens."""
    sampled = sampled_agents(spark, sf_dir)
    # Each distinct agent is parsed once.
    known = sampled.groupBy("sample", "userAgent").agg(F.count("*").alias("n"))
    parsed = known.withColumn("tokens", agents.agent_tokens(F.col("userAgent")))
    parsed = parsed.withColumn("platform", agents.platform_of(F.col("tokens"))).withColumn("browser", agents.browser_of(F.col("tokens")))
    return parsed.select("sample", "platform", "browser", agents.version_of(F.col("tokens"), F.col("browser")).alias("version"), "n")


def cleaned_users(log: DataFrame) -> DataFrame:
    """The last value of every crossed attribute and the label of each user, in one pass over the log."""
    return features.attribute_by_time(log, CROSSED, "last", highest=("churn",))


def _multi_device(log: DataFrame) -> DataFrame:
    attributes = {"agent": ["platform", "browser"], "platform": ["platform"], "browser": ["browser"]}
    parts = [
        profile.multi_value_summary(log, columns).select(F.lit(name).alias("attribute"), "*")
        for name, columns in attributes.items()
    ]
    return reduce(DataFrame.unionByName, parts)


CROSSED = ("gender", "level", "platform", "browser", "Region")
DISTRIBUTED = ("gender", "level", "Agent", "platform", "browser", "State", "City", "Region")


def _profile_queries() -> dict[str, Query]:
    found = {
        "missing_profile": _on_log(profile.missing_profile),
        "null_profile": _on_clean(lambda log: profile.null_profile(log, EVENT_LOG.names)),
        "cleaning_report": _on_log(profile.cleaning_report),
        "user_attribute": _on_clean(lambda log: profile.user_attribute(log, "level", "last")),
        "dist_churn": _on_clean(lambda log: profile.user_distribution(_with_flag(log), "churn", "max")),
        "page_distribution": _on_clean(lambda log: profile.distribution(log, "page")),
        "distinct_pages": _on_clean(profile.distinct_pages),
        "distinct_locations": _on_clean(lambda log: profile.distinct_values(log, "location")),
        "multi_device_summary": _on_stored(_multi_device),
        "churn_by_hour": _on_log(profile.churn_events_by_hour),
        "churn_by_weekday": _on_log(profile.churn_events_by_weekday),
        "user_page_counts": _on_clean(profile.user_page_counts),
        "page_count_stats": _on_clean(
            lambda log: profile.describe_by(profile.user_page_counts(log), ["page", "churn"], "n")
        ),
        "page_count_stats_sketch": _on_clean(
            lambda log: profile.describe_by_sketch(profile.user_page_counts(log), ["page", "churn"], "n")
        ),
        "sketch_rank_error": _sketch_rank_error,
        "agent_grammar": _agent_grammar,
        "chi2_tests": _chi2_tests,
        "expected_counts": _on_clean(
            lambda log: statistics.expected_counts(_crosstab("platform")(log), "churn", "value")
        ),
    }
    found.update({f"dist_{c.lower()}": _distribution(c) for c in DISTRIBUTED})
    found.update({f"crosstab_{c.lower()}": _on_clean(_crosstab(c)) for c in CROSSED})
    found.update({f"chi2_{c.lower()}": _chi2(c) for c in CROSSED})
    return found


# --- statistics over features ----------------------------------------------------------


def _stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table, rounded (so that equal values tie on every engine) and stored."""
    return materialize(rounded(features.user_features(_stored_clean(spark, sf_dir))), "features")


def _on_features(operator: Callable[[DataFrame, list[str]], DataFrame], digits: int = 6) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = _stored_features(spark, sf_dir)
        return rounded(operator(table, numeric_columns(table)), digits)

    return run


STATISTICS: dict[str, Callable[[DataFrame, list[str]], DataFrame]] = {
    "feature_histogram": profile.feature_histogram,
    "feature_histogram_auto": profile.feature_histogram_auto,
    "feature_boxplot": profile.feature_boxplot,
    "mann_whitney": lambda t, columns: statistics.mann_whitney(t, columns).select("feature", "n0", "n1", "u", "z"),
    "mann_whitney_tests": statistics.mann_whitney,
    "feature_correlation": lambda t, columns: statistics.feature_correlation(t, ["churn", *columns]),
}


def _mann_whitney_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: values of clicks against those of purchases, by the exact law where it applies."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").where(F.col("event_type").isin("click", "purchase"))
    values = events.select("user_id", "value", (F.col("event_type") == "purchase").cast("int").alias("kind"))
    return rounded(statistics.rank_tests(values, ["user_id"], label="kind", method="auto").drop("z"))


def _statistics_queries() -> dict[str, Query]:
    def on_gaps(operator: Callable[[DataFrame, list[str]], DataFrame]) -> Query:
        return _on_features(lambda t, columns: operator(with_gaps(t), columns))

    return {
        "mann_whitney_exact": _mann_whitney_exact,
        **{name: _on_features(operator) for name, operator in STATISTICS.items()},
        **{f"{name}_gaps": on_gaps(operator) for name, operator in STATISTICS.items()},
    }


# --- split, encode, train, explain -----------------------------------------------------

SEED = 42


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All users through an encoder fitted on the training users."""
    table = _stored_features(spark, sf_dir)
    train, _ = split.split(table, seed=SEED)
    return encoding.encode(table, encoding.fit_encoder(train))


def _on_encoded(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(operator(_encoded(spark, sf_dir)))


def _sink_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "matrix")
    events_io.write_table(encoding.model_matrix(_encoded(spark, sf_dir)), path, compression="gzip", single_file=True)
    return rounded(events_io.read_table(spark, path))


def _contributions(table: DataFrame, columns: list[str]) -> DataFrame:
    weights = {c: (i * 7 % 11 - 5) / 10 for i, c in enumerate(columns)}
    train, _ = split.split(table, seed=SEED)
    return explanation.linear_contributions(table, weights, explanation.column_means(train, columns))


def _dummies(encoded: DataFrame) -> DataFrame:
    matrix = encoding.model_matrix(encoded, vector="features")
    return matrix.select("userId", *[c for c in matrix.columns if "_vec" in c])


def _model_queries() -> dict[str, Query]:
    return {
        "stratified_split": _on_features(
            lambda t, _: split.with_split(t, seed=SEED).select("userId", "churn", "is_train")
        ),
        "stratified_split_exact": _on_features(
            lambda t, _: split.with_split(t, seed=SEED, exact=True).select("userId", "churn", "is_train")
        ),
        "string_index": _on_encoded(
            lambda e: e.select("userId", "gender_index", "level_index", "platform_index", "browser_index")
        ),
        "one_hot": _on_encoded(_dummies),
        "scaled_features": _on_encoded(lambda e: encoding.long_matrix(encoding.model_matrix(e))),
        "model_matrix": _on_encoded(encoding.model_matrix),
        "sink_parquet_gzip": _sink_gzip,
        "class_weights": _on_features(lambda t, _: split.class_weights(split.split(t, seed=SEED)[0])),
        # Inputs have 6 decimals and weights 1: rounding at 6 would meet many exact halves.
        "linear_contributions": _on_features(_contributions, digits=9),
        "shap_summary": _on_features(lambda t, columns: explanation.importance(_contributions(t, columns)), digits=9),
        "user_contributions": _on_features(
            lambda t, columns: explanation.signed_contributions(_contributions(t, columns)), digits=9
        ),
        "tree_contributions": _on_features(lambda t, _: _tree_contributions(t), digits=9),
        "model_tree_contributions": _model_tree_contributions,
        "kernel_contributions": _on_features(lambda t, _: _kernel_contributions(t), digits=9),
        "hist_boosting_scores": _hist_boosting_scores,
        "saved_scores": _saved_scores,
        "ranked_users": _ranked_users,
        "sampled_shapley": _sampled_shapley,
        "score_users": _score_users,
        "ranking": _ranking,
        "classifier_scores": _classifier_scores,
        "stacked_scores": _stacked_scores,
        "calibrated_scores": _calibrated_scores,
        "experiment_metrics": _experiment_metrics,
    }


def _fitted(spark: SparkSession, sf_dir: str, kind: str):
    """(features, encoder, encoded training rows, model of one kind) for the scoring queries."""
    table = _stored_features(spark, sf_dir)
    train, _ = split.split(table, seed=SEED)
    fitted = encoding.fit_encoder(train, handle_invalid="keep")
    encoded = materialize(training.weighted_rows(encoding.encode(train, fitted)), "train")
    return table, fitted, encoded, training.train_classifier(encoded, training.classifiers(SEED)[kind])


def _near(left: Column, right: Column) -> Column:
    """Equal up to the last bits of sums."""
    return F.abs(left - right) <= 1e-9 * (1 + F.abs(left))


def _sampled_shapley(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: whether all numbers have a value, and whether the values add up to the probability."""
    table, fitted, train, model = _fitted(spark, sf_dir, "decision_tree")
    encoded = encoding.encode(table, fitted)
    base = explanation.background(train, training.VECTOR)
    values = scoring.contributions_of(encoded, model, base, seed=SEED)
    summed = values.groupBy("userId").agg(
        F.countDistinct("feature").alias("features"), F.sum("value").alias("total"), F.max("base_value").alias("base")
    )
    scored = training.with_probability(model, encoded, "score").select("userId", "score")
    checked = _near(F.col("total") + F.col("base"), F.col("score")).alias("adds_up")
    numeric = F.lit(len(numeric_columns(table)))
    return summed.join(scored, "userId").select("userId", (F.col("features") >= numeric).alias("all_numbers"), checked)


# A tree of given splits: (feature, threshold, tree for smaller and equal values, tree for larger ones).
EXPLAINED = ["num_error", "num_nextsong", "num_roll_advert"]
TREE = (
    "num_error", 12,
    ("num_nextsong", 24, None, ("num_roll_advert", 1, None, None)),
    ("num_nextsong", 30, ("num_error", 16, None, ("num_nextsong", 20, None, None)), None),
)


def _as_rows(explained: DataFrame) -> DataFrame:
    """One row per user and feature from the map of contributions."""
    return explained.select("userId", F.explode("contributions").alias("feature", "value"))


def _numbers(columns: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def _tree_contributions(table: DataFrame) -> DataFrame:
    """Exact contributions to the label share of a fixed tree, whose shares are those of the training users."""
    train, _ = split.split(table, seed=SEED)
    paths = tree_explanation.fixed_tree(train, TREE, EXPLAINED)
    return _as_rows(tree_explanation.tree_contributions(table, paths, EXPLAINED, _numbers(EXPLAINED)))


def _model_tree_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per kind of tree model and user: units, and whether the contributions add up to the prediction."""
    train, test = _train_and_test(spark, sf_dir)
    names = encoding.vector_names(train)
    parts = []
    for kind, drawn in TREE_KINDS.items():
        model = training.train_classifier(train, training.classifiers(SEED)[kind], drawn)
        scored = training.with_probability(model, test, "score")
        explained = tree_explanation.model_contributions(scored, model, names, keep=("userId", "score"))
        total = F.aggregate(F.map_values("contributions"), F.col("base_value"), lambda a, v: a + v)
        told = F.when(F.col("units") == "log_odds", 1 / (1 + F.exp(-total))).otherwise(total)
        parts.append(explained.select(F.lit(kind).alias("model"), "userId", "units", _near(told, F.col("score")).alias("adds_up")))
    return reduce(DataFrame.unionByName, parts)


def _rule(rows: DataFrame) -> DataFrame:
    """A prediction that is not linear in its three features."""
    linear = 0.03 * F.col("x")[0] - 0.02 * F.col("x")[1] + 0.5 * (F.col("x")[2] % 3) - 0.2
    return rows.withColumn("prediction", 1 / (1 + F.exp(-linear)))


def _kernel_contributions(table: DataFrame) -> DataFrame:
    """Contributions to a fixed rule, all coalitions, against 20 training users as background."""
    train, _ = split.split(table, seed=SEED)
    values = _numbers(EXPLAINED)
    background = kernel_explanation.background_rows(train, values, most=20)
    return _as_rows(kernel_explanation.kernel_contributions(table, _rule, EXPLAINED, values, background))


def _hist_boosting_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of all users by histogram boosting on the training users; some numbers are missing."""
    table = with_gaps(_stored_features(spark, sf_dir))
    columns = numeric_columns(table)
    train, _ = split.split(table, seed=SEED)
    model = hist_boosting.train_boosting(train, columns, rounds=10, depth=3)
    scores = hist_boosting.boosting_scores(table, model, ["userId", "churn"])
    return scores.withColumn("in_range", F.col("score").between(0.0, 1.0))


def _saved_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: whether encoder and model give the same probability after they were saved and loaded."""
    table, fitted, _, model = _fitted(spark, sf_dir, "logistic_regression")
    encoder_path, model_path = new_path(spark, "encoder"), new_path(spark, "classifier")
    fitted.write().save(encoder_path)
    model.write().save(model_path)
    before = training.scored_table(model, encoding.encode(table, fitted))
    loaded = LogisticRegressionModel.load(model_path)
    after = training.scored_table(loaded, encoding.encode(table, PipelineModel.load(encoder_path)))
    both = before.join(after.select("id", F.col("score").alias("again")), "id")
    return both.select(F.col("id").alias("userId"), "label", (F.col("score") == F.col("again")).alias("same"))


def _ranked_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by falling score of a fixed rule, with their places."""
    scored = user_scores(features.user_features(_stored_clean(spark, sf_dir)))
    return rounded(scoring.ranked(scored, "id", "score"))


def _scored_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, fitted, _, model = _fitted(spark, sf_dir, "logistic_regression")
    return scoring.score_users(event_log(spark, sf_dir), fitted, model)


def _score_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: units, range of the probability, and whether the map adds up to the log odds."""
    scored = _scored_users(spark, sf_dir)
    total = F.aggregate(F.map_values("contributions"), F.lit(0.0), lambda a, v: a + v) + F.col("base_value")
    back = 1 / (1 + F.exp(-total))
    return scored.select(
        "userId", "units", F.col("churn_probability").between(0.0, 1.0).alias("in_range"),
        _near(back, F.col("churn_probability")).alias("adds_up"),
    )


def _ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of the ranking once, and whether the one before it has no lower probability."""
    ranked = scoring.ranking(_scored_users(spark, sf_dir))
    return _places(materialize(ranked.withColumn("row", F.monotonically_increasing_id()), "ranked"))


def _places(placed: DataFrame) -> DataFrame:
    """``place`` and ``ordered`` of rows whose ``row`` has the range of the sort in its upper bits.

    Places are counted inside each range; only one row per range is looked at together.
    """
    placed = placed.select("churn_probability", "row", F.shiftright("row", 33).alias("part"))
    ends = placed.groupBy("part").agg(F.count("*").alias("n"), F.max_by("churn_probability", "row").alias("last"))
    ranges = Window.orderBy("part")  # one row per range of the sort
    ends = ends.select(
        "part", (F.sum("n").over(ranges) - F.col("n")).alias("offset"), F.lag("last").over(ranges).alias("border")
    )
    order = Window.partitionBy("part").orderBy("row")
    inside = placed.withColumn("at", F.row_number().over(order)).withColumn("before", F.lag("churn_probability").over(order))
    before = F.when(F.col("at") == 1, F.col("border")).otherwise(F.col("before"))
    return inside.join(ends, "part").select(
        (F.col("offset") + F.col("at")).cast("long").alias("place"),
        F.coalesce(before >= F.col("churn_probability"), F.lit(True)).alias("ordered"),
    )


# Tree models whose contributions are checked.
TREE_KINDS = {
    "decision_tree": {"maxDepth": 6},
    "random_forest": {"numTrees": 20, "maxDepth": 5},
    "gradient_boosting": {"maxIter": 5, "maxDepth": 3, "stepSize": 0.3},
}

# Bounds of the search in the queries: models small enough that all kinds, their folds and their
# calibrated twins fit within minutes. ``TRIALS`` draws are made per kind, all in one round. The README
# has what fits in ``training.SEARCH_SPACES`` take.
TRIALS = 4
SMALL_SPACES = {
    "logistic_regression": {"C": ("uniform", 0.01, 10.0)},
    "random_forest": {"numTrees": ("quniform", 5, 20, 5), "maxDepth": ("quniform", 2, 4, 1)},
    "decision_tree": {"maxDepth": ("quniform", 1, 5, 1)},
    "gradient_boosting": {
        "maxIter": ("quniform", 2, 4, 1), "maxDepth": ("quniform", 2, 3, 1), "stepSize": ("uniform", 0.01, 1.0)
    },
    "gradient_boosting_unweighted": {
        "maxIter": ("quniform", 2, 4, 1), "maxDepth": ("quniform", 2, 3, 1), "stepSize": ("uniform", 0.01, 1.0)
    },
    "stacking": {"C": ("uniform", 0.01, 10.0)},
}


def _train_and_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Encoded, weighted training rows and encoded test rows."""
    train, test = split.split(_stored_features(spark, sf_dir), seed=SEED)
    fitted = encoding.fit_encoder(train, handle_invalid="keep")
    weighted = training.weighted_rows(encoding.encode(train, fitted))
    return materialize(weighted, "train"), materialize(encoding.encode(test, fitted), "test")


def _drawn() -> dict:
    """One draw of the small spaces per base classifier."""
    return {n: training.draw_parameters(SMALL_SPACES[n], 1, SEED)[0] for n in training.classifiers(SEED)}


def _checked(name: str, scored: DataFrame) -> DataFrame:
    """Which rows a model has scored, their labels, and whether the scores are probabilities."""
    return scored.select(F.lit(name).alias("model"), "id", "label", F.col("score").between(0.0, 1.0).alias("in_range"))


def _classifier_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _train_and_test(spark, sf_dir)
    drawn = _drawn()
    parts = [
        _checked(name, training.scored_table(training.train_classifier(train, estimator, drawn[name]), test))
        for name, estimator in training.classifiers(SEED).items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _stacked_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All kinds stacked over five folds, and the out-of-fold rows that the meta-learner saw."""
    train, test = _train_and_test(spark, sf_dir)
    drawn, rows = _drawn(), train.count()
    bases = {n: e.copy(training.spark_parameters(e, drawn[n], rows)) for n, e in training.classifiers(SEED).items()}
    held_out = materialize(training.out_of_fold(train, bases, SEED), "out-of-fold")
    scored = _checked("stacking", training.scored_table(training.train_stacking(train, bases, held_out), test))
    slots = vector_to_array("stacked")
    inside = F.forall(slots, lambda p: p.between(0.0, 1.0)) & (F.size(slots) == len(bases))
    seen = held_out.select(
        F.lit("out_of_fold").alias("model"), F.col("userId").alias("id"), F.col("churn").alias("label"),
        inside.alias("in_range"),
    )
    return scored.unionByName(seen)


def _calibrated_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _train_and_test(spark, sf_dir)
    drawn = _drawn()
    parts = [
        _checked(name, training.scored_table(training.train_calibrated(train, estimator, drawn[name], SEED), test))
        for name, estimator in training.classifiers(SEED).items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _experiment(spark: SparkSession, sf_dir: str):
    """Search, fit and evaluate all kinds, their stack and their calibrated twins."""
    train, test = _train_and_test(spark, sf_dir)
    return run_experiment(train.drop(training.WEIGHT), test, spaces=SMALL_SPACES, trials=TRIALS, seed=SEED)


def _experiment_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per model and metric: whether the value lies in the range of the metric."""
    metrics = _experiment(spark, sf_dir).metrics
    bounded = F.col("value").between(0.0, 1.0) | ((F.col("metric") == "log_loss") & (F.col("value") >= 0))
    return metrics.select("model", "metric", F.coalesce(bounded, F.lit(False)).alias("in_range"))


# --- evaluation ---------------------------------------------------------------------------


def _at_best(scored: DataFrame) -> DataFrame:
    threshold = evaluation.best_threshold(scored).select("threshold").scalar()
    return evaluation.confusion_matrix(evaluation.decide(scored, threshold))


EVALUATIONS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "pr_curve": evaluation.pr_curve,
    "roc_curve": evaluation.roc_curve,
    "roc_curve_corners": evaluation.roc_corners,
    "auc": evaluation.areas,
    "best_threshold": evaluation.best_threshold,
    "classification_metrics": evaluation.classification_metrics,
    "metrics_long": lambda scored: evaluation.metrics_long(evaluation.evaluation_summary(scored), "rule"),
    "log_loss": evaluation.log_loss,
    "fbeta": lambda scored: evaluation.f_beta(evaluation.decide(scored, 0.5)),
    "confusion_matrix": _at_best,
    "calibration_curve": evaluation.calibration_curve,
    "score_histogram": evaluation.score_histogram,
}


def _metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All metrics of the user scores, written as JSON and read back."""
    scored = materialize(user_scores(features.user_features(_stored_clean(spark, sf_dir))), "scored")
    path = new_path(spark, "metrics")
    events_io.write_metrics(evaluation.metrics_long(evaluation.evaluation_summary(scored), "rule"), path)
    return rounded(spark.read.schema("model string, metric string, value double").json(path))


def _evaluation_queries() -> dict[str, Query]:
    def on_users(operator: Callable[[DataFrame], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            table = features.user_features(_stored_clean(spark, sf_dir))
            return rounded(operator(materialize(user_scores(table), "scored")))

        return run

    def on_documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
        return lambda spark, sf_dir: rounded(operator(document_scores(spark, sf_dir)))

    def on_events(operator: Callable[[DataFrame], DataFrame]) -> Query:
        return lambda spark, sf_dir: rounded(operator(event_scores(spark, sf_dir)))

    return {
        **{name: on_users(operator) for name, operator in EVALUATIONS.items()},
        **{f"{name}_documents": on_documents(operator) for name, operator in EVALUATIONS.items()},
        **{f"{name}_events": on_events(operator) for name, operator in EVALUATIONS.items()},
        "left_out_events": on_events(evaluation.left_out),
        "metrics_json": _metrics_json,
    }


def queries() -> dict[str, Query]:
    return {
        **_base_queries(), **_profile_queries(), **_statistics_queries(), **_model_queries(), **_evaluation_queries(),
    }
