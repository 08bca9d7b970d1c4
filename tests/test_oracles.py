"""Every query with SQL: same rows, types and values on DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tools.check_oracles import compare, connect

SMALL = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
# This one takes minutes: tools/check_oracles.py runs it, and test_models.py runs a smaller experiment.
SLOW = {"experiment_metrics"}
# These name their dummy columns after the categories that occur, so they need enough users.
NEEDS_USERS = {"one_hot", "model_matrix", "sink_parquet_gzip", "string_index", "scaled_features"}


@pytest.fixture(scope="module")
def connections():
    return {sf_dir: connect(sf_dir) for sf_dir in (SMALL, LARGER)}


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SLOW))
def test_query_matches_sql(spark, connections, name):
    sf_dir = LARGER if name in NEEDS_USERS else SMALL
    ok, text = compare(spark, connections[sf_dir], name, sf_dir, entry.oracle_sql()[name])
    assert ok, text


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows_and_columns(spark):
    flagship = entry.entry(spark)
    assert len(flagship.columns) == 37
    assert flagship.count() == 13


@pytest.mark.parametrize(
    ("sf", "rows", "users", "sessions", "cancels"),
    [("0.001", 980, 15, 111, 6), ("0.01", 9800, 150, 1209, 53), ("0.1", 98000, 1500, 11935, 573)],
)
def test_derived_log_has_the_expected_size(spark, sf, rows, users, sessions, cancels):
    from pyspark.sql import functions as F

    from churnspark.plans.preprocess import clean_log
    from churnspark.sources.derived_log import event_log

    found = clean_log(event_log(spark, f"/root/testdata/sf{sf}")).agg(
        F.count("*"), F.count_distinct("userId"), F.count_distinct("userId", "sessionId"),
        F.count_if(F.col("page") == "Cancellation Confirmation"),
    )
    assert tuple(found.first()) == (rows, users, sessions, cancels)
