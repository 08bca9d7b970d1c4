"""Column names, types and roles shared by all jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

EVENT_LOG = T.StructType(
    [
        T.StructField("artist", T.StringType()),
        T.StructField("auth", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("userId", T.StringType()),
        T.StructField("sessionId", T.LongType()),
        T.StructField("page", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("status", T.LongType()),
        T.StructField("level", T.StringType()),
        T.StructField("itemInSession", T.LongType()),
        T.StructField("location", T.StringType()),
        T.StructField("userAgent", T.StringType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("firstName", T.StringType()),
        T.StructField("song", T.StringType()),
        T.StructField("registration", T.LongType()),
        T.StructField("length", T.DoubleType()),
    ]
)

SCORED_USERS = T.StructType(
    [
        T.StructField("userId", T.StringType()),
        T.StructField("churn_probability", T.DoubleType()),
        T.StructField("contributions", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("units", T.StringType()),
        T.StructField("base_value", T.DoubleType()),
    ]
)

# The columns whose nulls make an event unusable.
REQUIRED_USER_COLUMNS = (
    "userId", "firstName", "lastName", "location", "userAgent", "registration", "gender",
)

# The pages that mean a user left, and those kept out of page counts.
CHURN_PAGES = ("Cancellation Confirmation",)
CANCEL_PAGES = ("Cancel", "Cancellation Confirmation")

# The pages counted per user, in the order of the feature table.
COUNTED_PAGES = (
    "NextSong", "Thumbs Up", "Thumbs Down", "Add to Playlist", "Add Friend", "Error",
    "Help", "Submit Upgrade", "Submit Downgrade", "Roll Advert", "Logout", "Downgrade",
    "Upgrade", "Settings", "About", "Save Settings",
)

ID_COLUMN = "userId"
LABEL_COLUMN = "churn"
CATEGORICAL_COLUMNS = ("gender", "level", "platform", "browser")


def page_column(page: str) -> str:
    """Name of the count column of a page: ``Thumbs Up`` -> ``num_thumbs_up``."""
    return "num_" + page.lower().replace(" ", "_")


def feature_columns(features: DataFrame) -> list[str]:
    """All model inputs: everything but the user and the label."""
    return [c for c in features.columns if c not in (ID_COLUMN, LABEL_COLUMN)]


def categorical_columns(features: DataFrame) -> list[str]:
    return [c for c in CATEGORICAL_COLUMNS if c in features.columns]


def numeric_columns(features: DataFrame) -> list[str]:
    return [c for c in feature_columns(features) if c not in CATEGORICAL_COLUMNS]
