"""One row of features per user.

No step gathers all events, or all sessions, of one user in one task:

* events are first aggregated per (user, session, attributes), or per (user, session,
  artist), with partial sums in the scan stage; these are the only two shuffles of
  events, sessions and first attributes follow from the small first table;
* the gaps between sessions are taken inside (user, hour) groups, and the borders
  between hours on one row per (user, hour);
* user attributes are grouped by value before the earliest or latest is picked.

All event-level aggregates keep only numbers in their buffers, so Spark runs them
as hash aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.operators.cleaning import churn_event
from churnspark.runtime import materialize
from churnspark.schema import CHURN_PAGES, COUNTED_PAGES, LABEL_COLUMN, page_column

SONG_PAGE = "NextSong"
FIRST_ATTRIBUTES = ("gender", "level", "platform", "browser", "registration")
MS_PER_HOUR = 3_600_000
MS_PER_DAY = 86_400_000
INPUT_COLUMNS = (
    "userId", "sessionId", "ts", "itemInSession", "page", "artist", "length",
    "gender", "level", "platform", "browser", "registration",
)
PROPORTIONS = {
    "prop_thumbs_up": "num_thumbs_up",
    "prop_add_to_playlist": "num_add_to_playlist",
    "prop_thumbs_down": "num_thumbs_down",
    "unique_artist_ratio": "num_unique_artists",
}


def _square(value: Column) -> Column:
    """Exact square of a long (ms of a gap, songs of a session)."""
    exact = value.cast("decimal(19,0)")
    return (exact * exact).cast("decimal(38,0)")


def _sample_stddev(n: Column, total: Column, total_of_squares: Column) -> Column:
    """Sample deviation from exact integer sums; null below two values."""
    exact = total.cast("decimal(19,0)")
    spread = n.cast("decimal(19,0)") * total_of_squares.cast("decimal(38,0)") - exact * exact
    return F.when(n > 1, F.sqrt(spread.cast("double") / (n.cast("double") * (n - 1))))


def feature_inputs(log: DataFrame) -> DataFrame:
    """The columns of a cleaned log that features need: what to store between jobs."""
    return log.select(*INPUT_COLUMNS, *[c for c in (LABEL_COLUMN,) if c in log.columns])


def attribute_by_time(
    log: DataFrame, columns: Sequence[str], pick: str = "first", key: str = "userId", highest: Sequence[str] = ()
) -> DataFrame:
    """The columns of a user's first or last event (by ``ts``, then ``itemInSession``).

    Events are grouped by the values themselves, so that the buffers hold one number
    (an order key) and a hot user shrinks to a few rows before any shuffle. The maxima
    of the ``highest`` columns come along in the same pass.
    """
    best = {"first": F.min, "last": F.max}[pick]
    maxima = [F.max(c).alias(c) for c in highest]
    by_value = log.groupBy(key, *columns).agg(best(_order_key()).alias("seen"), *maxima)
    return _picked(by_value, columns, pick, key, highest)


def _order_key() -> Column:
    """Time, then place in the session, as one number."""
    order = F.col("ts").cast("decimal(19,0)") * F.lit(10**18).cast("decimal(19,0)") + F.coalesce(
        "itemInSession", F.lit(0)
    ).cast("decimal(18,0)")
    return order.cast("decimal(38,0)")


def _picked(
    by_value: DataFrame, columns: Sequence[str], pick: str = "first", key: str = "userId", highest: Sequence[str] = ()
) -> DataFrame:
    """Per user the values seen first or last, from rows per (user, values, ...) with ``seen``."""
    best = {"first": F.min, "last": F.max}[pick]
    chosen = by_value.groupBy(key).agg(
        best(F.struct("seen", *columns)).alias("at"), *[F.max(c).alias(c) for c in highest]
    )
    return chosen.select(key, *[F.col(f"at.{c}").alias(c) for c in columns], *highest)


def session_slices(log: DataFrame, attributes: Sequence[str] = FIRST_ATTRIBUTES) -> DataFrame:
    """One row per (user, session, attribute values), stored: times, label, page counts, listening time.

    The order key ``seen`` of the first event comes along, so that this one pass over the
    events serves both the sessions and the first attributes of a user.
    """
    grouped = log.groupBy("userId", "sessionId", *attributes).agg(
        F.min(_order_key()).alias("seen"), *_session_aggregates(log)
    )
    return materialize(grouped, "slices")


def sessions_of(slices: DataFrame) -> DataFrame:
    """``session_table`` from slices."""
    counts = [page_column(p) for p in COUNTED_PAGES]
    return slices.groupBy("userId", "sessionId").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.max("churn").alias("churn"),
        *[F.sum(c).alias(c) for c in counts],
        F.sum("listened").alias("listened"),
    )


def _session_aggregates(log: DataFrame) -> list[Column]:
    page = F.col("page")
    label = F.col(LABEL_COLUMN) if LABEL_COLUMN in log.columns else churn_event(CHURN_PAGES)
    return [
        F.min("ts").alias("start"),
        F.max("ts").alias("end"),
        F.max(label).alias("churn"),
        *[F.count_if(page == p).alias(page_column(p)) for p in COUNTED_PAGES],
        F.sum(F.when(page == SONG_PAGE, F.col("length"))).alias("listened"),
    ]


def session_table(log: DataFrame) -> DataFrame:
    """One row per (user, session): start, end, label, page counts, listening time."""
    return log.groupBy("userId", "sessionId").agg(*_session_aggregates(log))


def activity_per_user(sessions: DataFrame) -> DataFrame:
    """Roll sessions up to users: sums, squares and gap totals, all mergeable.

    Gaps: their sum over a user telescopes, only the sum of squares needs neighbours.
    Sessions with equal starts have no gap between them, so they are merged first; the
    distinct starts (in ms) of one user and hour are at most 3.6 million rows for the
    ``lag`` of that hour. Between hours ``lag`` runs on one row per hour of the log.
    """
    counts = [page_column(p) for p in COUNTED_PAGES]
    songs = F.col(page_column(SONG_PAGE))
    merged = sessions.groupBy("userId", "start").agg(
        F.max("end").alias("end"),
        F.max("churn").alias("churn"),
        F.count("*").alias("n_groups"),
        F.count("sessionId").alias("num_sessions"),
        *[F.sum(c).alias(c) for c in counts],
        F.count_if(songs > 0).alias("song_sessions"),
        F.sum(_square(songs)).alias("song_squares"),
        F.sum("listened").alias("listened"),
        F.count("listened").alias("listened_sessions"),
    )
    summed = ["n_groups", "num_sessions", *counts, "song_sessions", "song_squares", "listened", "listened_sessions"]
    in_hour = Window.partitionBy("userId", "hour").orderBy("start")
    with_gaps = merged.withColumn("hour", F.floor(F.col("start") / MS_PER_HOUR)).withColumn(
        "gap", F.col("start") - F.lag("start").over(in_hour)
    )
    hours = with_gaps.groupBy("userId", "hour").agg(
        F.min("start").alias("first_start"),
        F.max("start").alias("last_start"),
        F.max("end").alias("end"),
        F.max("churn").alias("churn"),
        F.sum(_square(F.col("gap"))).alias("gap_squares"),
        *[F.sum(c).alias(c) for c in summed],
    )
    by_hour = Window.partitionBy("userId").orderBy("hour")
    border = F.col("first_start") - F.lag("last_start").over(by_hour)
    zero = F.lit(0).cast("decimal(38,0)")
    hours = hours.withColumn("border_square", F.coalesce(_square(border), zero))
    return hours.groupBy("userId").agg(
        F.min("first_start").alias("first_start"),
        F.max("last_start").alias("last_start"),
        F.max("end").alias("last_ts"),
        F.max("churn").alias("churn"),
        F.sum(F.coalesce("gap_squares", zero) + F.col("border_square")).cast("decimal(38,0)").alias("gap_squares"),
        *[F.sum(c).alias(c) for c in summed],
    )


def artists_per_user(log: DataFrame) -> DataFrame:
    """Distinct artists of a user, and distinct (session, artist) pairs among songs."""
    seen = (
        log.where(F.col("artist").isNotNull())
        .groupBy("userId", "sessionId", "artist")
        .agg(F.max(F.when(F.col("page") == SONG_PAGE, 1).otherwise(0)).alias("played"))
    )
    per_artist = seen.groupBy("userId", "artist").agg(F.sum("played").alias("played_sessions"))
    return per_artist.groupBy("userId").agg(
        F.count("*").alias("num_unique_artists"), F.sum("played_sessions").alias("session_artists")
    )


# --- columns over the joined user row ------------------------------------------------


def _base_columns() -> list[Column]:
    tenure_ms = F.col("last_ts") - F.col("registration")
    return [
        "num_sessions",
        "num_unique_artists",
        *[page_column(p) for p in COUNTED_PAGES],
        ((F.col("last_ts") / 1000 - F.col("registration") / 1000) / 86400).alias("tenure"),
        F.try_divide("num_roll_advert", "num_sessions").alias("num_ads_per_session"),
        F.try_divide(F.col("num_unique_artists"), tenure_ms / MS_PER_DAY + 1e-6).alias("avg_unique_artists_per_day"),
    ]


def _song_columns() -> dict[str, Column]:
    songs = F.col(page_column(SONG_PAGE))
    deviation = _sample_stddev(F.col("song_sessions"), songs, F.col("song_squares"))
    return {
        "avg_songs_per_session": F.try_divide(songs, F.col("song_sessions")),
        "stddev_songs_per_session": F.coalesce(deviation, F.lit(0.0)),
    }


def _gap_columns() -> dict[str, Column]:
    """Gaps in hours; the first session of a user counts from the registration."""
    first_gap = F.col("first_start") - F.col("registration")
    n_gaps = F.col("n_groups") - F.when(F.col("registration").isNull(), 1).otherwise(0)
    total = F.col("last_start") - F.coalesce("registration", "first_start")
    squares = F.col("gap_squares") + F.coalesce(_square(first_gap), F.lit(0).cast("decimal(38,0)"))
    deviation = _sample_stddev(n_gaps, total, squares)
    return {
        "avg_time_between_sessions": F.try_divide(F.try_divide(total, n_gaps), F.lit(MS_PER_HOUR)),
        "stddev_time_between_sessions": F.coalesce(deviation / MS_PER_HOUR, F.lit(0.0)),
    }


def _proportion_columns() -> dict[str, Column]:
    songs = F.col(page_column(SONG_PAGE))
    return {name: F.try_divide(F.col(c), songs) for name, c in PROPORTIONS.items()}


def _listening_column() -> Column:
    return F.try_divide("listened", "listened_sessions")


def _artists_column() -> Column:
    return F.try_divide("session_artists", "song_sessions")


def _only_listeners(users: DataFrame, keep_songless: bool) -> DataFrame:
    return users if keep_songless else users.where(F.col("song_sessions") > 0)


def _user_rows(log: DataFrame) -> DataFrame:
    """Activity, first attributes and artists joined per user (one row on each side)."""
    slices = session_slices(log)
    activity = activity_per_user(sessions_of(slices))
    attributes = _picked(slices, FIRST_ATTRIBUTES)
    return (
        activity.join(attributes, "userId")
        .join(artists_per_user(log), "userId", "left_outer")
        .fillna(0, ["num_unique_artists", "session_artists"])
    )


# --- feature groups ---------------------------------------------------------------------


def user_base_features(log: DataFrame) -> DataFrame:
    """Attributes, label, counts and tenure of every user."""
    return _user_rows(log).select("userId", "gender", "level", "platform", "browser", "churn", *_base_columns())


def page_counts(log: DataFrame) -> DataFrame:
    """The page counts of every user."""
    counts = [F.count_if(F.col("page") == p).alias(page_column(p)) for p in COUNTED_PAGES]
    return log.groupBy("userId").agg(*counts)


def songs_per_session(log: DataFrame) -> DataFrame:
    users = activity_per_user(session_table(log)).where(F.col("song_sessions") > 0)
    return users.withColumns(_song_columns()).select("userId", *_song_columns())


def session_gaps(log: DataFrame) -> DataFrame:
    slices = session_slices(log, ["registration"])
    users = activity_per_user(sessions_of(slices)).join(_picked(slices, ["registration"]), "userId")
    return users.withColumns(_gap_columns()).select("userId", *_gap_columns())


def listening_time(log: DataFrame) -> DataFrame:
    users = activity_per_user(session_table(log)).where(F.col("song_sessions") > 0)
    return users.select("userId", _listening_column().alias("avg_listening_time_per_session"))


def artists_per_session(log: DataFrame) -> DataFrame:
    users = activity_per_user(session_table(log)).where(F.col("song_sessions") > 0)
    joined = users.join(artists_per_user(log), "userId", "left_outer").fillna(0, ["session_artists"])
    return joined.select("userId", _artists_column().alias("avg_artists_per_session"))


def action_proportions(log: DataFrame, keep_songless: bool = True) -> DataFrame:
    """Counts per played song; null for users who never played one."""
    counted = page_counts(log).join(artists_per_user(log), "userId", "left_outer").fillna(0, ["num_unique_artists"])
    if not keep_songless:
        counted = counted.where(F.col(page_column(SONG_PAGE)) > 0)
    return counted.withColumns(_proportion_columns()).select("userId", *PROPORTIONS)


def user_features(log: DataFrame, keep_songless: bool = False) -> DataFrame:
    """The full feature table: user, label, 4 categorical and 31 numeric features.

    ``log`` is a cleaned log with ``platform`` and ``browser``; the label is taken from
    ``churn`` if present and from the churn pages otherwise. Users without a song are
    dropped, or kept with zeros on request.
    """
    users = _only_listeners(_user_rows(log), keep_songless)
    derived = {
        **_song_columns(),
        **_gap_columns(),
        **_proportion_columns(),
        "avg_listening_time_per_session": _listening_column(),
        "avg_artists_per_session": _artists_column(),
    }
    table = users.select(
        "userId", "gender", "level", "platform", "browser", "churn",
        *_base_columns(),
        *[
            derived[c].alias(c)
            for c in (
                "avg_songs_per_session", "avg_time_between_sessions",
                "prop_thumbs_up", "prop_add_to_playlist", "prop_thumbs_down", "unique_artist_ratio",
                "avg_listening_time_per_session", "avg_artists_per_session",
                "stddev_songs_per_session", "stddev_time_between_sessions",
            )
        ],
    )
    if keep_songless:
        song_based = [
            "avg_songs_per_session", "stddev_songs_per_session", "avg_listening_time_per_session",
            "avg_artists_per_session", *PROPORTIONS,
        ]
        table = table.fillna(0.0, song_based)
    return table
