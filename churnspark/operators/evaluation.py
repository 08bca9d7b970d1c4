"""Evaluation of scored tables ``(id, label, score)`` with labels 0 and 1."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.operators.running import running_sums

LOG_LOSS_CLIP = 2.0**-52  # fixed value: machine epsilon of a double


def usable(scored: DataFrame) -> DataFrame:
    """Rows that can be evaluated: a score that is no null or NaN, and a label.

    Every operator here leaves the others out; ``left_out`` counts them.
    """
    return scored.where(F.col("score").isNotNull() & ~F.isnan("score") & F.col("label").isNotNull())


def left_out(scored: DataFrame) -> DataFrame:
    """One row: all rows, and those without score or without label, which evaluation leaves out."""
    no_score = F.col("score").isNull() | F.isnan("score")
    return scored.agg(
        F.count("*").alias("rows"),
        F.count_if(no_score).alias("without_score"),
        F.count_if(F.col("label").isNull()).alias("without_label"),
        F.count_if(no_score | F.col("label").isNull()).alias("left_out"),
    )


def _safe(numerator: Column, denominator: Column, empty: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(empty))


def _f_beta(tp: Column, predicted: Column, positives: Column, beta: float) -> Column:
    """F-beta from counts; 0 when nothing is predicted or nothing is positive."""
    weight = beta * beta
    return _safe((1 + weight) * tp, weight * positives + predicted)


def score_counts(scored: DataFrame) -> DataFrame:
    """One row per distinct score with the counts at it and above it.

    ``tp`` and ``predicted`` count rows with score >= threshold; ``tp_above`` and
    ``predicted_above`` those strictly above, which is the next point of every curve.
    """
    counted = usable(scored).groupBy("score").agg(
        F.sum(F.col("label").cast("long")).alias("pos"), F.count("*").alias("n")
    )
    ranked = running_sums(counted, [], "score", ["pos", "n"])
    return ranked.select(
        F.col("score").alias("threshold"),
        "pos",
        "n",
        F.col("pos_total").alias("positives"),
        F.col("n_total").alias("rows"),
        (F.col("pos_total") - F.col("pos_before")).alias("tp"),
        (F.col("n_total") - F.col("n_before")).alias("predicted"),
        (F.col("pos_total") - F.col("pos_before") - F.col("pos")).alias("tp_above"),
        (F.col("n_total") - F.col("n_before") - F.col("n")).alias("predicted_above"),
    )


def _precision(tp: Column, predicted: Column) -> Column:
    """Precision; 1 where nothing is predicted (the end point of the curve)."""
    return _safe(tp, predicted, 1.0)


def _recall(tp: Column) -> Column:
    """Recall; 1 where there are no positives at all."""
    return _safe(tp, F.col("positives"), 1.0)


def _extra_point(scored: DataFrame, empty: str, **values: float) -> DataFrame:
    """A curve point that belongs to no score: ``empty`` is null."""
    return scored.sparkSession.range(1).select(
        F.lit(None).cast("double").alias(empty), *[F.lit(v).alias(k) for k, v in values.items()]
    )


def pr_curve(scored: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Precision and recall per threshold, plus the end point (precision 1, recall 0)."""
    points = (counts or score_counts(scored)).select(
        "threshold",
        _precision(F.col("tp"), F.col("predicted")).alias("precision"),
        _recall(F.col("tp")).alias("recall"),
    )
    return points.unionByName(_extra_point(scored, "threshold", precision=1.0, recall=0.0))


def roc_curve(scored: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """False and true positive rates per threshold, plus the start point (0, 0)."""
    negatives = F.col("rows") - F.col("positives")
    points = (counts or score_counts(scored)).select(
        "threshold",
        F.try_divide(F.col("predicted") - F.col("tp"), negatives).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("positives")).alias("tpr"),
    )
    return points.unionByName(_extra_point(scored, "threshold", fpr=0.0, tpr=0.0))


def roc_corners(scored: DataFrame) -> DataFrame:
    """``roc_curve`` without points that lie on the line between their neighbours; the area is the same.

    A point goes if the step to it and the step from it have the same direction, which is decided on
    counts. The neighbour of a chunk's border comes with the chunk, so nothing is sorted as a whole.
    """
    counted = usable(scored).groupBy("score").agg(F.sum(F.col("label").cast("long")).alias("pos"), F.count("*").alias("n"))
    ranked = running_sums(counted, [], "score", ["pos", "n"], previous=["pos", "n"])
    exact = "decimal(38,0)"

    def times(a: Column, b: Column) -> Column:
        return a.cast("decimal(19,0)") * b.cast("decimal(19,0)")

    negatives, negatives_after = F.col("n") - F.col("pos"), F.col("n_previous") - F.col("pos_previous")
    turns = times(F.col("pos"), negatives_after).cast(exact) != times(F.col("pos_previous"), negatives).cast(exact)
    tp = F.col("pos_total") - F.col("pos_before")
    predicted = F.col("n_total") - F.col("n_before")
    points = ranked.where(F.col("n_previous").isNull() | turns).select(
        F.col("score").alias("threshold"),
        F.try_divide(predicted - tp, F.col("n_total") - F.col("pos_total")).alias("fpr"),
        F.try_divide(tp, F.col("pos_total")).alias("tpr"),
    )
    return points.unionByName(_extra_point(scored, "threshold", fpr=0.0, tpr=0.0))


def _pr_strip() -> Column:
    """Trapezoid between a threshold and the next higher one."""
    tp, above = F.col("tp"), F.col("tp_above")
    width = F.try_divide(tp - above, F.col("positives"))
    # Past the highest score the curve ends at recall 0, precision 1.
    height = _precision(tp, F.col("predicted")) + _precision(above, F.col("predicted_above"))
    return width * height / 2


def _roc_strip() -> Column:
    false_here = F.col("predicted") - F.col("tp")
    false_above = F.col("predicted_above") - F.col("tp_above")
    width = F.try_divide(false_here - false_above, F.col("rows") - F.col("positives"))
    return width * F.try_divide(F.col("tp") + F.col("tp_above"), F.col("positives")) / 2


def _area_columns() -> list[Column]:
    return [F.sum(_pr_strip()).alias("pr_auc"), F.sum(_roc_strip()).alias("roc_auc")]


def areas(scored: DataFrame) -> DataFrame:
    """Areas under the precision-recall and ROC curves by trapezoids."""
    return score_counts(scored).agg(*_area_columns())


def _best(columns: Sequence[Column], beta: float) -> Column:
    """Values at the threshold with the highest F-beta; the lowest threshold wins ties."""
    f = _f_beta(F.col("tp"), F.col("predicted"), F.col("positives"), beta)
    return F.max_by(F.struct(*columns), F.struct(f, -F.col("threshold")))


def best_threshold(scored: DataFrame, beta: float = 2.0) -> DataFrame:
    """The threshold with the highest F-beta, with its precision and recall."""
    values = [
        F.col("threshold").alias("threshold"),
        _f_beta(F.col("tp"), F.col("predicted"), F.col("positives"), beta).alias("f_beta"),
        _precision(F.col("tp"), F.col("predicted")).alias("precision"),
        _recall(F.col("tp")).alias("recall"),
    ]
    return score_counts(scored).agg(_best(values, beta).alias("best")).select("best.*")


def _log_loss() -> Column:
    """Mean log loss over score counts, probabilities clipped away from 0 and 1."""
    p = F.least(F.greatest(F.col("threshold"), F.lit(LOG_LOSS_CLIP)), F.lit(1 - LOG_LOSS_CLIP))
    loss = F.col("pos") * F.log(p) + (F.col("n") - F.col("pos")) * F.log(1 - p)
    return -F.sum(loss) / F.sum("n")


def _brier() -> Column:
    s = F.col("threshold")
    return F.sum(F.col("pos") * (s - 1) * (s - 1) + (F.col("n") - F.col("pos")) * s * s) / F.sum("n")


def evaluation_summary(
    scored: DataFrame, beta: float = 2.0, inclusive: bool = False, counts: DataFrame | None = None
) -> DataFrame:
    """All metrics of a scored table in one row and one aggregate over distinct scores.

    The decision at the best threshold is strict (score > threshold) unless
    ``inclusive``; its counts are those "above" the threshold row. ``counts`` are stored
    ``score_counts`` that the curves may share.
    """
    suffix = "" if inclusive else "_above"
    at_best = [
        F.col("threshold"),
        F.col(f"tp{suffix}").alias("tp"),
        F.col(f"predicted{suffix}").alias("predicted"),
        F.col("positives"),
        F.col("rows"),
    ]
    row = (
        (counts or score_counts(scored))
        .agg(_best(at_best, beta).alias("best"), _brier().alias("brier_score"), _log_loss().alias("log_loss"), *_area_columns())
        .select("best.*", "brier_score", "log_loss", "pr_auc", "roc_auc")
    )
    tp, predicted, positives, rows = (F.col(c) for c in ("tp", "predicted", "positives", "rows"))
    negatives, unpredicted = rows - positives, rows - predicted
    tn = negatives - (predicted - tp)
    precision, recall, f1 = _safe(tp, predicted), _safe(tp, positives), _f_beta(tp, predicted, positives, 1.0)
    precision0, recall0, f1_0 = _safe(tn, unpredicted), _safe(tn, negatives), _f_beta(tn, unpredicted, negatives, 1.0)

    def weighted(one: Column, zero: Column) -> Column:
        return (one * positives + zero * negatives) / rows

    return row.select(
        "threshold",
        F.try_divide(tp + tn, rows).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        weighted(precision, precision0).alias("precision_weighted"),
        weighted(recall, recall0).alias("recall_weighted"),
        weighted(f1, f1_0).alias("f1_weighted"),
        "brier_score",
        "log_loss",
        "pr_auc",
        "roc_auc",
    )


CLASSIFICATION_METRICS = (
    "accuracy", "f1_weighted", "precision_weighted", "recall_weighted", "f1", "precision", "recall", "threshold",
    "brier_score",
)


def classification_metrics(scored: DataFrame, beta: float = 2.0, inclusive: bool = False) -> DataFrame:
    return evaluation_summary(scored, beta, inclusive).select(*CLASSIFICATION_METRICS)


def metrics_long(summary: DataFrame, model: str) -> DataFrame:
    """One row per metric: (model, metric, value)."""
    named = summary.select(F.lit(model).alias("model"), "*")
    return named.unpivot("model", summary.columns, "metric", "value")


def log_loss(scored: DataFrame) -> DataFrame:
    p = F.least(F.greatest(F.col("score"), F.lit(LOG_LOSS_CLIP)), F.lit(1 - LOG_LOSS_CLIP))
    label = F.col("label")
    return usable(scored).agg((-F.avg(label * F.log(p) + (1 - label) * F.log(1 - p))).alias("log_loss"))


def decide(scored: DataFrame, threshold: float | Column, inclusive: bool = False) -> DataFrame:
    """Add ``prediction`` 0 or 1 (score > threshold, or >= when ``inclusive``)."""
    limit = F.lit(threshold)
    hit = F.col("score") >= limit if inclusive else F.col("score") > limit
    return usable(scored).withColumn("prediction", F.when(hit, 1).otherwise(0))


def f_beta(decided: DataFrame, beta: float = 2.0) -> DataFrame:
    """F-beta of 0/1 predictions."""
    counts = decided.agg(
        F.count_if((F.col("label") == 1) & (F.col("prediction") == 1)).alias("tp"),
        F.count_if(F.col("prediction") == 1).alias("predicted"),
        F.count_if(F.col("label") == 1).alias("positives"),
    )
    return counts.select(_f_beta(F.col("tp"), F.col("predicted"), F.col("positives"), beta).alias("f_beta"))


def confusion_matrix(decided: DataFrame) -> DataFrame:
    """Counts per label and prediction (all four cells) and their share within the label."""
    cells = [(label, prediction) for label in (0, 1) for prediction in (0, 1)]
    row = decided.agg(
        *[
            F.count_if((F.col("label") == a) & (F.col("prediction") == b)).alias(f"n{a}{b}")
            for a, b in cells
        ]
    )
    entries = [
        F.struct(
            F.lit(a).alias("label"),
            F.lit(b).alias("prediction"),
            F.col(f"n{a}{b}").alias("n"),
            _safe(F.col(f"n{a}{b}"), F.col(f"n{a}0") + F.col(f"n{a}1")).alias("share"),
        )
        for a, b in cells
    ]
    return row.select(F.explode(F.array(*entries)).alias("cell")).select("cell.*")


def calibration_curve(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Mean score and positive share per non-empty bin of equal width over [0, 1].

    A score on an inner edge belongs to the lower bin.
    """
    step = 1.0 / bins
    edges = F.array(*[F.lit(i * step) for i in range(1, bins)])
    index = F.size(F.filter(edges, lambda edge: edge < F.col("score")))
    return (
        usable(scored).groupBy(index.alias("bin"))
        .agg(F.avg("score").alias("mean_score"), F.avg("label").alias("positive_share"), F.count("*").alias("n"))
    )


def score_histogram(scored: DataFrame, bins: int = 20) -> DataFrame:
    """Counts per bin of equal width between the lowest and the highest score."""
    counted = usable(scored).groupBy("score").agg(F.count("*").alias("n"))
    low, high = (counted.agg(f("score")).scalar() for f in (F.min, F.max))
    width = (high - low) / bins
    position = F.coalesce(F.floor(F.try_divide(F.col("score") - low, width)), F.lit(0))
    binned = counted.groupBy(F.least(position, F.lit(bins - 1)).cast("int").alias("bin")).agg(F.sum("n").alias("n"))
    return binned
