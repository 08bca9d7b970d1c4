"""Hand-made logs for the decisions on nulls, order and unknown values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from churnspark.operators import cleaning, features, profile
from churnspark.plans.preprocess import clean_log, preprocess
from churnspark.sources.events_io import read_events
from churnspark.schema import EVENT_LOG

HOUR = 3_600_000


def by_user(df):
    return {r["userId"]: r.asDict() for r in df.collect()}


def with_agent_columns(log):
    return log.withColumns({"platform": F.lit("Linux"), "browser": F.lit("Firefox")})


def test_blank_user_survives_unless_asked(make_log):
    log = make_log({"userId": ""}, {"userId": None}, {"userId": "a"}, {"firstName": None})
    assert {r.userId for r in cleaning.drop_incomplete_users(log).collect()} == {"", "a"}
    assert {r.userId for r in cleaning.drop_incomplete_users(log, blank_is_null=True).collect()} == {"a"}


def test_churn_label_reaches_all_events_of_a_user(make_log):
    log = make_log(
        {"userId": "a", "page": "Cancellation Confirmation"}, {"userId": "a"}, {"userId": "b"},
        {"userId": None, "page": "Cancellation Confirmation"}, {"userId": None},
    )
    labels = cleaning.with_churn_label(log).groupBy("userId").agg(F.collect_set("churn").alias("s"), F.count("*").alias("n"))
    assert {r.userId: (r.s, r.n) for r in labels.collect()} == {"a": ([1], 2), "b": ([0], 1), None: ([1], 2)}


def test_churn_pages_are_a_parameter(make_log):
    log = make_log({"userId": "a", "page": "Downgrade"}, {"userId": "a"}, {"userId": "b"})
    labelled = preprocess(log, churn_pages=["Downgrade"])
    assert {(r.userId, r.churn) for r in labelled.collect()} == {("a", 1), ("b", 0)}


@pytest.mark.parametrize(
    ("agent", "platform", "browser"),
    [
        ("Mozilla/5.0 (Windows NT 6.1) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/36.0 Safari/537.36", "Windows", "Chrome"),
        ("Mozilla/5.0 (iPad; CPU OS 7_1 like Mac OS X) AppleWebKit/537.51 Version/7.0 Mobile Safari/9537.53", "iOS", "Safari"),
        ("Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:31.0) Gecko/20100101 Firefox/31.0", "Linux", "Firefox"),
        ("Mozilla/5.0 (Windows NT 6.1; Trident/7.0; rv:11.0) like Gecko", "Windows", "Microsoft Internet Explorer"),
        ("Mozilla/5.0 (Linux; Android 14) AppleWebKit/537.36 Chrome/120.0 Mobile Safari/537.36", "Android", "Chrome"),
        ("Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 Chrome/120.0 Safari/537.36 Edg/120.0", "Windows", "Microsoft Edge"),
        ("SomeTool (Windows)", None, None),
        ("Firefox/3", None, None),
        ("-", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_agent_needs_both_parts(make_log, agent, platform, browser):
    row = cleaning.with_agent(make_log({"userAgent": agent})).first()
    assert (row.platform, row.browser) == (platform, browser)


@pytest.mark.parametrize(
    ("location", "city", "state", "region"),
    [
        ("Newark, NY-NJ-PA", "Newark", "NY", "Northeast"),
        ("Austin, tx", "Austin", "tx", "South"),
        ("Nowhere, ZZ", "Nowhere", "ZZ", "unknown"),
        ("Nocomma", "Nocomma", None, "unknown"),
        (None, None, None, "unknown"),
    ],
)
def test_location_parts_and_region(make_log, location, city, state, region):
    row = cleaning.with_region(cleaning.with_location_parts(make_log({"location": location}))).first()
    assert (row.City, row.State, row.Region) == (city, state, region)


def test_partial_songs_and_missing_rows(make_log):
    log = make_log(
        {"song": "s", "artist": None}, {"song": "s", "artist": "a"}, {"song": None, "artist": None},
        {"song": "", "artist": "a", "length": float("nan")},
    )
    flagged = cleaning.with_listening_flag(log)
    assert sorted(r.Listening for r in flagged.collect()) == [0, 1, 1, 1]
    assert cleaning.drop_partial_songs(flagged).count() == 3
    assert cleaning.rows_with_missing(log, ["song", "artist", "length"]).count() == 4
    counts = {r.column: r.n_missing for r in profile.missing_profile(log, ["song", "artist", "length", "ts"]).collect()}
    assert counts == {"song": 2, "artist": 2, "length": 4, "ts": 0}
    nulls = {r.column: (r.n_null, r.null_fraction) for r in profile.null_profile(log, ["song", "length"]).collect()}
    assert nulls == {"song": (1, 0.25), "length": (3, 0.75)}


def test_first_and_last_attributes_follow_time_then_item(make_log):
    log = make_log(
        {"ts": 5, "level": "paid"}, {"ts": 1, "itemInSession": 2, "level": "paid"},
        {"ts": 1, "itemInSession": 1, "level": "free"}, {"ts": 9, "itemInSession": 7, "level": None},
    )
    for partitions in (1, 7):
        spread = log.repartition(partitions)
        assert features.attribute_by_time(spread, ["level"]).first().level == "free"
        assert features.attribute_by_time(spread, ["level"], pick="last").first().level is None


def test_gaps_count_from_registration_and_may_be_negative(make_log):
    log = with_agent_columns(
        make_log(
            {"userId": "one", "ts": 10 * HOUR, "registration": 4 * HOUR},
            {"userId": "late", "ts": 1 * HOUR, "registration": 3 * HOUR},
            {"userId": "many", "sessionId": 1, "ts": 2 * HOUR, "registration": 0},
            {"userId": "many", "sessionId": 2, "ts": 3 * HOUR, "registration": 0},
            {"userId": "many", "sessionId": 3, "ts": 3 * HOUR, "registration": 0},
            {"userId": "many", "sessionId": 4, "ts": 3 * HOUR + HOUR // 2, "registration": 0},
            {"userId": "many", "sessionId": 5, "ts": 9 * HOUR, "registration": 0},
        )
    )
    users = by_user(features.user_features(log))
    assert users["one"]["avg_time_between_sessions"] == 6.0
    assert users["one"]["stddev_time_between_sessions"] == 0.0
    assert users["late"]["avg_time_between_sessions"] == -2.0
    assert users["late"]["tenure"] == pytest.approx(-2 / 24)
    assert users["late"]["avg_unique_artists_per_day"] == 0.0
    gaps = [2, 1, 0, 0.5, 5.5]
    mean = sum(gaps) / 5
    assert users["many"]["avg_time_between_sessions"] == pytest.approx(mean)
    assert users["many"]["stddev_time_between_sessions"] == pytest.approx((sum((g - mean) ** 2 for g in gaps) / 4) ** 0.5)


def test_songless_users_are_dropped_or_kept(make_log):
    log = with_agent_columns(
        make_log({"userId": "songless", "page": "Home"}, {"userId": "listener", "artist": "a", "length": 2.0})
    )
    assert set(by_user(features.user_features(log))) == {"listener"}
    kept = by_user(features.user_features(log, keep_songless=True))
    assert set(kept) == {"songless", "listener"}
    assert kept["songless"]["avg_songs_per_session"] == 0.0
    assert kept["songless"]["prop_thumbs_up"] == 0.0
    assert kept["listener"]["unique_artist_ratio"] == 1.0


def test_null_session_is_a_group_but_not_counted(make_log):
    log = with_agent_columns(
        make_log({"sessionId": None, "ts": HOUR, "artist": "a"}, {"sessionId": 1, "ts": 3 * HOUR, "artist": "a"})
    )
    row = features.user_features(log).first()
    assert row.num_sessions == 1
    assert row.avg_songs_per_session == 1.0
    assert row.avg_time_between_sessions == 1.5
    assert row.avg_artists_per_session == 1.0


def test_session_without_lengths_is_skipped_in_listening_time(make_log):
    log = with_agent_columns(
        make_log(
            {"sessionId": 1, "length": None}, {"sessionId": 2, "length": 4.0}, {"sessionId": 2, "length": 2.0, "ts": 5},
        )
    )
    assert features.user_features(log).first().avg_listening_time_per_session == 6.0


def test_results_do_not_depend_on_partitioning(spark):
    from churnspark.sources.derived_log import event_log

    log = clean_log(event_log(spark, "/root/testdata/sf0.001")).cache()
    results = []
    for partitions in (1, 7):
        rows = features.user_features(log.repartition(partitions)).orderBy("userId").collect()
        results.append([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows])
    log.unpersist()
    assert results[0] == results[1]


def test_corrupt_lines_are_kept_on_request(spark, tmp_path):
    (tmp_path / "log.json").write_text('{"userId": "a", "ts": 5, "song": "s"}\n{broken\n')
    rows = read_events(spark, str(tmp_path), EVENT_LOG, keep_corrupt=True).select("userId", "song", "_corrupt_record").collect()
    assert {(r.userId, r.song, r._corrupt_record) for r in rows} == {("a", "s", None), (None, None, "{broken")}


def test_crosstab_by_last_label(make_log):
    log = make_log(
        {"userId": "a", "ts": 1, "gender": "F"}, {"userId": "a", "ts": 2, "gender": "M"}, {"userId": "b", "gender": "F"}
    ).withColumn("churn", F.when(F.col("ts") == 1, 1).otherwise(0))
    assert {tuple(r) for r in profile.crosstab(log, "gender").collect()} == {(1, "M", 1), (0, "F", 1)}
    assert {tuple(r) for r in profile.crosstab(log, "gender", label_func="last").collect()} == {(0, "M", 1), (0, "F", 1)}


def test_user_attribute_by_function_name(make_log):
    log = make_log({"ts": 3}, {"ts": 5})
    assert profile.user_attribute(log, "ts", "max").first().ts == 5
    assert profile.user_attribute(log, "ts", "avg").first().ts == 4.0


def test_user_page_counts_label_churned_users(make_log):
    log = make_log({"userId": "a", "page": "Cancel"}, {"userId": "a", "page": "Cancellation Confirmation"},
                   {"userId": "a", "page": "Home"}, {"userId": "b", "page": "Home"})
    expected = {("a", "Home", 1, 1), ("b", "Home", 0, 1)}
    assert {tuple(r) for r in profile.user_page_counts(log).collect()} == expected
    labelled = cleaning.with_churn_label(log)
    assert {tuple(r) for r in profile.user_page_counts(labelled).collect()} == expected
