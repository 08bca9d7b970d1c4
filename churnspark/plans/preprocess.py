"""From the raw log to the cleaned, labelled and enriched log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from churnspark.operators.cleaning import (
    drop_incomplete_users,
    drop_partial_songs,
    with_agent,
    with_churn_label,
    with_listening_flag,
)
from churnspark.schema import CHURN_PAGES


def clean_log(log: DataFrame, blank_is_null: bool = False, drop_partial: bool = False) -> DataFrame:
    """Everything of ``preprocess`` that looks at one event only: no shuffle at all."""
    kept = log.transform(drop_incomplete_users, blank_is_null=blank_is_null).transform(with_listening_flag)
    if drop_partial:
        kept = kept.transform(drop_partial_songs)
    return kept.transform(with_agent)


def preprocess(
    log: DataFrame,
    churn_pages: Sequence[str] = CHURN_PAGES,
    blank_is_null: bool = False,
    drop_partial: bool = False,
) -> DataFrame:
    """Clean, flag, parse agents and put the churn label on every event.

    The source is scanned twice: once for the churned users, which are stored while the plan
    is built, once for the events. Store a raw JSON log first.
    """
    cleaned = clean_log(log, blank_is_null=blank_is_null, drop_partial=drop_partial)
    return cleaned.transform(with_churn_label, pages=churn_pages)
