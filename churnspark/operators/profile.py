"""Profiles and distributions of the log and of the feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.functions.columns import WEEKDAYS, any_of, is_missing, utc_hour, utc_weekday
from churnspark.operators.features import attribute_by_time
from churnspark.operators.running import quantile_aggregates, quantile_columns, running_sums
from churnspark.runtime import materialize
from churnspark.schema import CANCEL_PAGES, CHURN_PAGES, REQUIRED_USER_COLUMNS

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
AGGREGATES = {
    "max": F.max, "min": F.min, "sum": F.sum, "avg": F.avg, "mean": F.avg, "count": F.count, "stddev": F.stddev_samp,
}


def _unpivot_one_row(row: DataFrame, names: Sequence[str], values: dict[str, dict[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into one row per name, with the given value columns."""
    entries = [F.struct(F.lit(n).alias("column"), *[v[n].alias(k) for k, v in values.items()]) for n in names]
    return row.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")


def missing_profile(log: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that are null, blank or NaN, per column, in one pass."""
    types = dict(log.dtypes)
    names = list(columns or log.columns)
    row = log.agg(*[F.count_if(is_missing(c, types[c])).alias(c) for c in names])
    return _unpivot_one_row(row, names, {"n_missing": {c: F.col(c) for c in names}})


def null_profile(log: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and null fraction per column, in one pass."""
    names = list(columns or log.columns)
    row = log.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in names])
    nulls = {c: F.col("_rows") - F.col(c) for c in names}
    return _unpivot_one_row(
        row, names, {"n_null": nulls, "null_fraction": {c: F.try_divide(nulls[c], F.col("_rows")) for c in names}}
    )


def cleaning_report(log: DataFrame, required: Sequence[str] = REQUIRED_USER_COLUMNS) -> DataFrame:
    """Row counts before and after cleaning, in one pass."""
    types = dict(log.dtypes)
    incomplete = any_of([F.col(c).isNull() for c in required])
    any_missing = any_of([is_missing(c, types[c]) for c in log.columns])
    blank_user = is_missing("userId", types["userId"])
    return log.agg(
        F.count("*").alias("n_rows"),
        F.count_if(any_missing).alias("n_rows_with_missing"),
        F.count_if(~incomplete).alias("n_kept"),
        F.count_if(incomplete).alias("n_dropped"),
        F.count_if(~incomplete & blank_user).alias("n_kept_missing_user"),
    )


def user_attribute(log: DataFrame, column: str, func: str, key: str = "userId") -> DataFrame:
    """One value of ``column`` per user by function name.

    ``first`` and ``last`` go by event time; the rest are plain aggregates.
    """
    if func in ("first", "last"):
        return attribute_by_time(log, [column], pick=func, key=key)
    return log.groupBy(key).agg(AGGREGATES[func](column).alias(column))


def distribution(rows: DataFrame, column: str) -> DataFrame:
    """Count and percent (one decimal) per value, most frequent first."""
    # Stored, because the total is a second look at the counts.
    counted = materialize(rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")), "counts")
    total = counted.agg(F.sum("n").alias("total")).scalar()
    percent = F.round(F.col("n") * 100 / total, 1).alias("percent")
    return counted.select("value", "n", percent).orderBy(F.desc("n"), "value")


def user_distribution(log: DataFrame, column: str, func: str = "last") -> DataFrame:
    """Distribution of a user attribute over users."""
    return distribution(user_attribute(log, column, func), column)


def distinct_pages(log: DataFrame) -> DataFrame:
    """Pages by listening flag."""
    return log.select("Listening", "page").distinct()


def distinct_values(log: DataFrame, column: str) -> DataFrame:
    return log.select(column).distinct()


def multi_value_summary(log: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many different values of the columns (null is one) users have, summarised."""
    values = log.select("userId", F.struct(*columns).alias("value") if len(columns) > 1 else F.col(columns[0]).alias("value"))
    per_user = values.distinct().groupBy("userId").agg(F.count("*").alias("n"))
    return per_user.agg(
        F.count("*").alias("users"),
        F.avg("n").alias("mean"),
        F.stddev_samp("n").alias("stddev"),
        F.min("n").alias("min"),
        F.max("n").alias("max"),
    )


def crosstab(log: DataFrame, column: str, label: str = "churn", label_func: str = "max") -> DataFrame:
    """Users by label (their highest, or last) and last value of an attribute, long form."""
    if label_func == "max":
        users = attribute_by_time(log, [column], pick="last", highest=[label])
    elif label_func == "last":
        users = attribute_by_time(log, [label, column], pick="last")
    else:
        raise ValueError(f"label_func must be max or last, not {label_func}")
    return users.groupBy(label, F.col(column).alias("value")).agg(F.count("*").alias("n"))


def churn_events_by_hour(log: DataFrame, pages: Sequence[str] = CHURN_PAGES) -> DataFrame:
    """Churn events per hour of day (UTC), all 24 hours."""
    counted = (
        log.where(F.col("page").isin(list(pages))).groupBy(utc_hour(F.col("ts")).alias("hour")).agg(F.count("*").alias("n"))
    )
    hours = log.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    return hours.join(counted, "hour", "left_outer").fillna(0, ["n"]).orderBy("hour")


def churn_events_by_weekday(log: DataFrame, pages: Sequence[str] = CHURN_PAGES) -> DataFrame:
    """Churn events per weekday (UTC), Mon to Sun."""
    counted = (
        log.where(F.col("page").isin(list(pages)))
        .groupBy(utc_weekday(F.col("ts")).alias("weekday"))
        .agg(F.count("*").alias("n"))
    )
    days = log.sparkSession.range(7).select(
        (F.col("id") + 1).cast("int").alias("position"),
        F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), (F.col("id") + 1).cast("int")).alias("weekday"),
    )
    return days.join(counted, "weekday", "left_outer").fillna(0, ["n"]).select("position", "weekday", "n").orderBy("position")


def user_page_counts(log: DataFrame, label: str = "churn", without: Sequence[str] = CANCEL_PAGES) -> DataFrame:
    """Events per user, page and label, without the cancel pages.

    The label of a user is joined to counts, not to events, when the log does not carry it.
    """
    kept = ~F.col("page").isin(list(without))
    if label in log.columns:
        return log.where(kept).groupBy("userId", "page", label).agg(F.count("*").alias("n"))
    counts = log.groupBy("userId", "page").agg(F.count("*").alias("n"))
    churned = (
        log.where(F.col("page").isin(list(CHURN_PAGES))).select("userId").distinct().withColumn(label, F.lit(1))
    )
    labelled = counts.where(kept).join(churned, "userId", "left_outer")
    return labelled.withColumn(label, F.coalesce(label, F.lit(0))).select("userId", "page", label, "n")


def describe_by(rows: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """count, mean, std, min, exact quartiles and max of ``value`` per group.

    Equal values are counted first; everything else comes from the counts.
    """
    counts = (
        rows.where(F.col(value).isNotNull())
        .groupBy(*groups, F.col(value).cast("double").alias("v"))
        .agg(F.count("*").alias("n"))
        .withColumn("weighted", F.col("n") * F.col("v"))
    )
    ranked = running_sums(counts, groups, "v", ["n", "weighted"])
    distance = F.col("v") - F.col("weighted_total") / F.col("n_total")
    described = ranked.groupBy(*groups).agg(
        F.sum("n").alias("count"),
        F.max(F.col("weighted_total") / F.col("n_total")).alias("mean"),
        F.sum(F.col("n") * distance * distance).alias("squares"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        *quantile_aggregates("v", QUARTILES),
    )
    std = F.when(F.col("count") > 1, F.sqrt(F.col("squares") / (F.col("count") - 1))).alias("std")
    return described.select(*groups, "count", "mean", std, "min", *quantile_columns(QUARTILES), "max")


def describe_by_sketch(rows: DataFrame, groups: Sequence[str], value: str, size: int = 4096) -> DataFrame:
    """As ``describe_by``, with quartiles from one mergeable sketch per group.

    Only sketches of about ``size`` numbers are shuffled, not the distinct values. A quartile is the
    least value whose share of rows at or below it reaches the quarter; it is exact for groups of up
    to ``size`` rows, beyond with the rank error of ``sketch_error_bound``.
    """
    known = rows.where(F.col(value).isNotNull()).withColumn("v", F.col(value).cast("double"))
    sketched = known.groupBy(*groups).agg(
        F.count("*").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"),
        F.max("v").alias("max"), F.kll_sketch_agg_double("v", F.lit(size)).alias("sketch"),
    )
    quartiles = [F.kll_sketch_get_quantile_double("sketch", F.lit(share)).alias(name) for name, share in QUARTILES.items()]
    return sketched.select(*groups, "count", "mean", "std", "min", *quartiles, "max")


def sketch_error_bound(size: int) -> float:
    """The normalised rank error that a sketch of this size keeps with 99 % confidence (2.296 / size^0.9021)."""
    return 2.296 / size**0.9021


def sketch_rank_errors(rows: DataFrame, groups: Sequence[str], value: str, shares: Sequence[float], size: int = 200) -> DataFrame:
    """(groups, share, error, bound): how far the sketch's quantiles are from their rank, measured exactly.

    The error is the distance of ``share`` from the ranks that the value covers among all rows.
    """
    known = rows.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("v"))
    sketches = known.groupBy(*groups).agg(F.kll_sketch_agg_double("v", F.lit(size)).alias("sketch"))
    entries = [
        F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(s))).alias("v")) for s in shares
    ]
    picked = materialize(sketches.select(*groups, F.explode(F.array(*entries)).alias("e")).select(*groups, "e.*"), "quantiles")
    counted = known.groupBy(*groups, "v").agg(F.count("*").alias("n"))
    ranked = running_sums(counted, groups, "v", ["n"])
    low, high = F.col("n_before") / F.col("n_total"), (F.col("n_before") + F.col("n")) / F.col("n_total")
    error = F.greatest(low - F.col("share"), F.col("share") - high, F.lit(0.0))
    return picked.join(ranked, [*groups, "v"]).select(
        *groups, "share", error.alias("error"), F.lit(sketch_error_bound(size)).alias("bound")
    )


def long_features(features: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per user and numeric feature: keep columns, ``feature``, ``value``; null and NaN are left out."""
    numbers = features.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return numbers.unpivot(list(keep), list(columns), "feature", "value").where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def _histogram(values: DataFrame, ranges: DataFrame, label: str) -> DataFrame:
    """Counts and density per feature, class and bin; ``ranges``: feature, low, width, bins (few rows)."""
    counted = values.groupBy("feature", label, "value").agg(F.count("*").alias("n"))
    sizes = values.groupBy("feature", label).agg(F.count("*").alias("n_class"))
    position = F.floor(F.try_divide(F.col("value") - F.col("low"), F.col("width")))
    binned = (
        # One row per listed column, so it may be broadcast.
        counted.join(F.broadcast(ranges), "feature")
        .withColumn("bin", F.least(F.coalesce(position, F.lit(0)), F.col("bins") - 1).cast("int"))
        .groupBy("feature", label, "bin", "low", "width", "bins")
        .agg(F.sum("n").alias("n"))
    )
    return binned.join(sizes, ["feature", label]).select(
        "feature",
        label,
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
        "n",
        F.try_divide(F.col("n"), F.col("n_class") * F.col("width")).alias("density"),
        "bins",
    )


def feature_histogram(features: DataFrame, columns: Sequence[str], label: str = "churn", bins: int = 20) -> DataFrame:
    """Equal-width bins per feature with count and density within each class.

    The range of a feature covers both classes; empty bins are left out.
    """
    values = long_features(features, columns, [label])
    ranges = values.groupBy("feature").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    ranges = ranges.select("feature", "low", ((F.col("high") - F.col("low")) / bins).alias("width"), F.lit(bins).alias("bins"))
    return _histogram(values, ranges, label).drop("bins")


def automatic_bins(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, low, width, bins): as many bins as the data ask for.

    The width is the lesser one of 2 IQR / n^(1/3) (left out where the quartiles are equal) and
    range / (log2 n + 1), stretched so that whole bins cover the range. Quartiles are exact.
    """
    values = long_features(features, columns, [])
    counted = values.groupBy("feature", "value").agg(F.count("*").alias("n"))
    ranked = running_sums(counted, ["feature"], "value", ["n"])
    spread = ranked.groupBy("feature").agg(
        F.max("n_total").alias("total"), F.min("value").alias("low"), F.max("value").alias("high"),
        *quantile_aggregates("value", QUARTILES),
    ).select("feature", "total", "low", "high", *quantile_columns(QUARTILES))
    span = F.col("high") - F.col("low")
    by_quartiles = 2 * (F.col("q3") - F.col("q1")) / F.pow(F.col("total").cast("double"), F.lit(1 / 3))
    by_size = span / (F.log2(F.col("total").cast("double")) + 1)
    wanted = F.when(by_quartiles > 0, F.least(by_quartiles, by_size)).otherwise(by_size)
    bins = F.greatest(F.coalesce(F.ceil(F.try_divide(span, wanted)), F.lit(1)), F.lit(1))
    return spread.select("feature", "low", (span / bins).alias("width"), bins.alias("bins"))


def feature_histogram_auto(features: DataFrame, columns: Sequence[str], label: str = "churn") -> DataFrame:
    """``feature_histogram`` with ``automatic_bins``, and their number per feature."""
    ranges = materialize(automatic_bins(features, columns), "bins")
    return _histogram(long_features(features, columns, [label]), ranges, label)


def feature_boxplot(features: DataFrame, columns: Sequence[str], label: str = "churn") -> DataFrame:
    """Quartiles, whiskers (extremes within 1.5 IQR) and outlier count per feature and class."""
    groups = ["feature", label]
    counts = long_features(features, columns, [label]).groupBy(*groups, "value").agg(F.count("*").alias("n"))
    ranked = running_sums(counts, groups, "value", ["n"])
    # One row per feature and class; stored, so that Spark joins it by its known size.
    boxes = materialize(
        ranked.groupBy(*groups).agg(*quantile_aggregates("value", QUARTILES)).select(*groups, *quantile_columns(QUARTILES)),
        "boxes",
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        ranked.select(*groups, "value", "n")
        .join(boxes, groups)
        .groupBy(*groups, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("n_outliers"),
        )
    )
