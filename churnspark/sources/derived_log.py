"""An event log derived from the ``events`` and ``customer`` tables (FIXTURES.md, part 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the derived log.
HOUR_US = 3_600_000_000
SESSION_GAP_US = 24 * HOUR_US
STATES = ("CA", "TX", "NY-NJ", "IL", "WA", "FL", "AZ", "ZZ")
AGENTS = (
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64; rv:121.0) Gecko/20100101 Firefox/121.0",
    "Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.1 Safari/605.1.15",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_1 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.1 Mobile/15E148 Safari/604.1",
)
REGISTRATION_START_MS = 1_701_388_800_000  # 2023-12-01 00:00 UTC
DAY_MS = 86_400_000
# Upper bounds (exclusive) of ``k`` per page; the last page of a kind takes the rest.
PURCHASE_PAGES = ((60, "NextSong"), (75, "Submit Upgrade"), (85, "Upgrade"), (95, "Downgrade"), (None, "Submit Downgrade"))
SONG_PAGES = ((None, "NextSong"),)
ERROR_PAGES = ((3, "Cancellation Confirmation"), (None, "Error"))
CLICK_PAGES = (
    (25, "Thumbs Up"), (35, "Thumbs Down"), (60, "Add to Playlist"), (70, "Add Friend"),
    (80, "Roll Advert"), (85, "Settings"), (88, "Help"), (91, "About"), (95, "Save Settings"), (None, "Logout"),
)


def _page_list(bounds: tuple, song_page: str) -> Column:
    """Constant array with the page of every ``k`` from 0 to 99."""
    pages, lower = [], 0
    for upper, page in bounds:
        upper = 100 if upper is None else upper
        pages += [song_page if page == "NextSong" else page] * (upper - lower)
        lower = upper
    return F.split(F.lit("|".join(pages)), r"\|")


def _page(song_page: str) -> Column:
    return (
        F.when(F.col("event_type") == "purchase", _page_list(PURCHASE_PAGES, song_page))
        .when(F.col("event_type") == "error", _page_list(ERROR_PAGES, song_page))
        .when(F.col("event_type") == "click", _page_list(CLICK_PAGES, song_page))
        .otherwise(_page_list(SONG_PAGES, song_page))
    )


def _pick(values: tuple[str, ...], key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def _raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # ``ts`` has no time zone; shift it so that it reads as UTC in any session.
    us = F.expr("unix_micros(from_utc_timestamp(cast(ts as timestamp), current_timezone()))")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        us.alias("us"),
    )


def _with_sessions(events: DataFrame) -> DataFrame:
    """Number sessions (gaps over 24 h) and items without a per-user event window.

    Two events of the same clock hour can never be 24 h apart, so session borders fall
    between hours only. Events are counted per (user, second), seconds are numbered
    within their hour (at most 3600 rows) and hours within their user (the hours of the
    log); the only window over events is one user's single second.
    """
    clock = {"hour": F.expr(f"us div {HOUR_US}"), "second": F.expr("us div 1000000")}
    events = events.withColumns(clock)
    seconds = events.groupBy("user_id", "hour", "second").agg(
        F.min("us").alias("first_us"), F.max("us").alias("last_us"), F.count("*").alias("n")
    )
    hours = seconds.groupBy("user_id", "hour").agg(
        F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"), F.sum("n").alias("n")
    )
    by_user = Window.partitionBy("user_id").orderBy("hour")
    gap = F.col("first_us") - F.lag("last_us").over(by_user)
    hours = hours.withColumn("starts", F.when(gap <= SESSION_GAP_US, 0).otherwise(1)).withColumn(
        "sessionId", F.sum("starts").over(by_user)
    )
    before = (Window.unboundedPreceding, -1)
    in_session = Window.partitionBy("user_id", "sessionId").orderBy("hour").rowsBetween(*before)
    in_hour = Window.partitionBy("user_id", "hour").orderBy("second").rowsBetween(*before)
    in_second = Window.partitionBy("user_id", "hour", "second").orderBy("us", "event_id")

    def count_over(window) -> Column:
        return F.coalesce(F.sum("n").over(window), F.lit(0))

    hours = hours.select("user_id", "hour", "sessionId", count_over(in_session).alias("before_hour"))
    seconds = seconds.select("user_id", "hour", "second", count_over(in_hour).alias("before_second"))
    offsets = seconds.join(hours, ["user_id", "hour"])
    # An outer join on unique keys: Catalyst drops it where no session or item is asked for.
    return events.join(offsets, ["user_id", "hour", "second"], "left_outer").withColumn(
        "itemInSession",
        (F.col("before_hour") + F.col("before_second") + F.row_number().over(in_second)).cast("long"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw event log (schema ``EVENT_LOG``), logged-out rows included."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("user_id"), "c_name"
    )
    uid, event_id, k = F.col("user_id"), F.col("event_id"), F.col("k")
    pages = F.when(uid % 13 == 0, _page("Home")).otherwise(_page("NextSong"))
    events = _with_sessions(_raw_events(spark, sf_dir)).withColumn("page", F.element_at(pages, k + 1))
    song = F.col("page") == "NextSong"
    known = event_id % 50 != 0
    return events.join(customers, "user_id", "left").select(
        F.when(song & (event_id % 101 != 0), F.concat(F.lit("artist_"), k)).alias("artist"),
        F.lit("Logged In").alias("auth"),
        F.when(uid % 2 == 0, "F").otherwise("M").alias("gender"),
        F.expr("us div 1000").alias("ts"),
        uid.cast("string").alias("userId"),
        "sessionId",
        "page",
        F.lit("PUT").alias("method"),
        F.lit(200).cast("long").alias("status"),
        F.when((uid + F.col("sessionId")) % 3 == 0, "free").otherwise("paid").alias("level"),
        "itemInSession",
        F.concat(F.lit("City"), uid, F.lit(", "), _pick(STATES, uid)).alias("location"),
        F.when(uid % 11 == 0, "-").otherwise(_pick(AGENTS, uid)).alias("userAgent"),
        F.when(known, F.substring_index("c_name", "#", -1)).alias("lastName"),
        F.when(known, F.substring_index("c_name", "#", 1)).alias("firstName"),
        F.when(song, F.concat(F.lit("song_"), k * 7 + uid % 5)).alias("song"),
        (F.lit(REGISTRATION_START_MS) + uid % 45 * DAY_MS).alias("registration"),
        F.when(song, F.col("value")).alias("length"),
    )
