"""Row filters, flags and labels on the event log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.functions.columns import (
    BROWSER_RULES,
    PLATFORM_RULES,
    Rules,
    any_of,
    city,
    first_match,
    is_missing,
    state,
)
from churnspark.functions.regions import region_table
from churnspark.runtime import materialize
from churnspark.schema import CHURN_PAGES, REQUIRED_USER_COLUMNS


def drop_incomplete_users(
    log: DataFrame, required: Sequence[str] = REQUIRED_USER_COLUMNS, blank_is_null: bool = False
) -> DataFrame:
    """Drop events that lack any of the user columns; blanks count only on request."""
    kept = log.dropna("any", subset=list(required))
    if blank_is_null:
        types = dict(log.dtypes)
        texts = [c for c in required if types[c] == "string"]
        kept = kept.where(~any_of([F.col(c) == "" for c in texts]))
    return kept


def with_listening_flag(log: DataFrame) -> DataFrame:
    return log.withColumn("Listening", F.when(F.col("song").isNotNull(), 1).otherwise(0))


def drop_partial_songs(log: DataFrame) -> DataFrame:
    """Drop listening events without artist or song."""
    partial = (F.col("Listening") == 1) & (F.col("artist").isNull() | F.col("song").isNull())
    return log.where(~partial)


def rows_with_missing(log: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows where any of the columns is null, blank or NaN."""
    types = dict(log.dtypes)
    return log.where(any_of([is_missing(c, types[c]) for c in columns or log.columns]))


def churn_event(pages: Sequence[str] = CHURN_PAGES):
    """1 on events of a churn page, else 0."""
    return F.when(F.col("page").isin(list(pages)), 1).otherwise(0)


def with_churn_label(log: DataFrame, pages: Sequence[str] = CHURN_PAGES) -> DataFrame:
    """Every event gets 1 if its user has any churn event, else 0.

    A window over all events of a user would gather a hot user in one task. The
    churned users are stored first (one row each, combined in the scan), so Spark
    joins them back on a known size: below its threshold they are broadcast and the
    log is not shuffled, above it the log is, with oversized partitions split.
    """
    churned = materialize(
        log.where(F.col("page").isin(list(pages)))
        .select(F.col("userId").alias("churned_user"))
        .distinct()
        .withColumn("user_churned", F.lit(1)),
        "churned",
    )
    return (
        log.join(churned, F.col("userId").eqNullSafe(F.col("churned_user")), "left_outer")
        .withColumn("churn", F.coalesce("user_churned", F.lit(0)))
        .drop("churned_user", "user_churned")
    )


def with_agent(
    log: DataFrame, platforms: Rules = PLATFORM_RULES, browsers: Rules = BROWSER_RULES
) -> DataFrame:
    """Add ``platform`` and ``browser``; both null unless both are recognised."""
    # Two steps, so that each rule runs once per row.
    found = log.withColumns(
        {
            "found_platform": first_match(F.col("userAgent"), platforms),
            "found_browser": first_match(F.col("userAgent"), browsers),
        }
    )
    known = F.col("found_platform").isNotNull() & F.col("found_browser").isNotNull()
    return found.withColumns(
        {
            "platform": F.when(known, F.col("found_platform")),
            "browser": F.when(known, F.col("found_browser")),
        }
    ).drop("found_platform", "found_browser")


def with_location_parts(log: DataFrame) -> DataFrame:
    return log.withColumns({"City": city(F.col("location")), "State": state(F.col("location"))})


def with_region(log: DataFrame, unknown: str = "unknown") -> DataFrame:
    """Add the region of ``State``; the lookup has 51 fixed rows, so it is broadcast."""
    lookup = F.broadcast(region_table(log.sparkSession))
    matched = log.join(lookup, F.upper(F.trim("State")) == F.col("region_state"), "left_outer")
    return matched.withColumn("Region", F.coalesce("region_name", F.lit(unknown))).drop(
        "region_state", "region_name"
    )
