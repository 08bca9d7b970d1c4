"""The plans are the ones meant to run at scale, and a hot user changes nothing."""

from __future__ import annotations

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from churnspark.operators import cleaning, features, profile, split
from churnspark.plans.preprocess import clean_log
from churnspark.runtime import check_rows, intermediates, materialize, shared_folder
from churnspark.schema import EVENT_LOG
from tools.check_oracles import compare, connect


@pytest.fixture
def stored_log(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([], EVENT_LOG).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def plain_plans(spark):
    """Planned exchanges only: no run-time re-planning, no broadcasts."""
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaning_does_not_shuffle_or_leave_the_jvm(stored_log):
    plan = plan_of(clean_log(stored_log))
    assert "Exchange" not in plan
    assert "Python" not in plan


def test_feature_job_exchanges_and_aggregates(stored_log, plain_plans, monkeypatch):
    stored = []

    def keep(df, label):
        stored.append(df)
        return materialize(df, label)

    monkeypatch.setattr(features, "materialize", keep)
    plan = plan_of(features.user_features(clean_log(stored_log)))
    slices = plan_of(stored[0])
    assert len(stored) == 1 and "Python" not in plan + slices
    # Two scans and two shuffles of events: slices, and artists; all else runs on the stored slices.
    assert slices.count("Exchange hashpartitioning") == 1 and slices.count("FileScan") == 1
    assert len(re.findall(r"FileScan parquet \[[^\]]*artist", plan)) == 1
    assert plan.count("FileScan") == 3
    # Event-level aggregates hold numbers only; sorting is left to one row per user and value.
    assert "SortAggregate" not in slices
    for keys in re.findall(r"SortAggregate\(key=\[([^\]]*)\]", plan):
        assert re.fullmatch(r"userId#\d+", keys)
    # No window gathers the events or sessions of a user.
    for partition in re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", plan):
        assert "hour" in partition or partition.startswith("userId")
    assert "CartesianProduct" not in plan
    assert "NestedLoop" not in plan


def test_feature_scan_reads_only_its_columns(spark, stored_log, tmp_path):
    path = str(tmp_path / "clean")
    clean_log(stored_log).write.parquet(path)
    plan = plan_of(features.user_features(spark.read.parquet(path)))
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert "userAgent" not in schema
        assert "location" not in schema


def test_filters_reach_the_scan(stored_log):
    plan = plan_of(profile.churn_events_by_hour(stored_log))
    assert "EqualTo(page,Cancellation Confirmation)" in plan


def test_split_needs_no_shuffle(stored_log):
    assert "Exchange" not in plan_of(split.with_split(stored_log, label="level"))


def test_label_join_broadcasts_small_and_shuffles_large(spark, stored_log):
    small = plan_of(cleaning.with_churn_label(stored_log))
    assert "BroadcastHashJoin" in small
    assert "hashpartitioning" not in small
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan_of(cleaning.with_churn_label(stored_log))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_materialized_tables_live_in_the_shared_folder_and_end_with_their_block(spark):
    with intermediates(spark) as outer:
        kept = materialize(spark.range(2), "kept")
        with intermediates(spark) as inner:
            stored = materialize(spark.range(3).withColumn("x", F.lit("a")), "probe")
            path = stored.inputFiles()[0].removeprefix("file://")
            assert shared_folder(spark).removeprefix("file:") in path
            assert stored.count() == 3 and len(inner) == 1 and len(outer) == 1
        assert not os.path.exists(path)
        assert kept.count() == 2


def test_no_private_folder_on_a_cluster(spark, monkeypatch):
    from churnspark import runtime

    monkeypatch.setattr(runtime, "_one_machine", lambda spark: False)
    context = spark.sparkContext
    monkeypatch.setattr(type(context), "getCheckpointDir", lambda self: None)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(spark)
    with pytest.raises(RuntimeError, match="not shared"):
        check_rows("file:/x", 3, 2)


def test_row_counts_are_checked_where_folders_may_be_private(spark, monkeypatch):
    from churnspark import runtime

    folder = shared_folder(spark)
    monkeypatch.setattr(runtime, "_may_be_private", lambda spark, path: True)
    monkeypatch.setattr(runtime, "shared_folder", lambda spark: folder)
    assert materialize(spark.range(5), "checked").count() == 5
    assert materialize(spark.range(0), "checked").count() == 0


HOT_QUERIES = [
    "preprocess", "churn_label", "user_features", "session_gaps", "dist_level", "crosstab_level", "user_page_counts",
    "page_count_stats", "mann_whitney", "classification_metrics", "stratified_split_exact",
]


@pytest.fixture(scope="module")
def hot_tables(tmp_path_factory):
    """One user holds a third of all events, a second one all events of one hour."""
    folder = tmp_path_factory.mktemp("hot")
    source = "/root/testdata/sf0.01"
    duckdb.execute(
        f"""COPY (SELECT event_id,
                 CASE WHEN event_id % 10 = 1 THEN TIMESTAMP '2024-01-10 10:00:00' + INTERVAL 1 MICROSECOND * event_id ELSE ts END AS ts,
                 CASE WHEN event_id % 3 = 0 THEN 7 WHEN event_id % 10 = 1 THEN 8 ELSE user_id END AS user_id,
                 event_type, value, props
            FROM '{source}/events.parquet') TO '{folder}/events.parquet' (FORMAT parquet)"""
    )
    duckdb.execute(f"COPY (SELECT * FROM '{source}/customer.parquet') TO '{folder}/customer.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", HOT_QUERIES)
def test_hot_users_get_right_results(spark, hot_tables, name):
    ok, text = compare(spark, connect(hot_tables), name, hot_tables, entry.oracle_sql()[name])
    assert ok, text


def test_places_of_a_ranking_across_ranges(spark):
    from churnspark.workloads.queries import _places

    # Ranges 0, 2 and 5 of a sort; the first row of range 5 is higher than the last of range 2.
    rows = [(0.9, 0), (0.8, 1), (0.8, 2 << 33), (0.3, (2 << 33) + 1), (0.4, 5 << 33), (0.1, (5 << 33) + 1)]
    got = _places(spark.createDataFrame(rows, "churn_probability double, row bigint").repartition(3)).collect()
    assert sorted(map(tuple, got)) == [(i, i != 5) for i in range(1, 7)]
