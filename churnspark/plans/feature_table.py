"""From the raw log to the stored feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from churnspark.operators.features import feature_inputs, user_features
from churnspark.plans.preprocess import clean_log
from churnspark.runtime import materialize


def feature_table(
    log: DataFrame, keep_songless: bool = False, blank_is_null: bool = False, store_input: bool = False
) -> DataFrame:
    """Clean a raw log and build the stored feature table.

    The job scans the log twice with pruned columns. ``store_input`` first writes the twelve
    columns that it needs: for a log that is costly to read twice, such as raw JSON.
    """
    cleaned = feature_inputs(clean_log(log, blank_is_null=blank_is_null))
    if store_input:
        cleaned = materialize(cleaned, "clean-log")
    return materialize(user_features(cleaned, keep_songless=keep_songless), "features")
