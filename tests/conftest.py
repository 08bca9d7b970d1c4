from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from churnspark.runtime import build_session  # noqa: E402
from churnspark.schema import EVENT_LOG  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DEFAULTS = {
    "artist": None, "auth": "Logged In", "gender": "F", "ts": 0, "userId": "u", "sessionId": 1, "page": "NextSong",
    "method": "PUT", "status": 200, "level": "free", "itemInSession": 1, "location": "Austin, TX", "userAgent": "-",
    "lastName": "L", "firstName": "F", "song": None, "registration": 0, "length": None,
}


@pytest.fixture
def make_log(spark):
    """Event log from dicts that name only the columns that matter."""

    def make(*rows: dict):
        return spark.createDataFrame([tuple({**DEFAULTS, **r}[c] for c in EVENT_LOG.names) for r in rows], EVENT_LOG)

    return make
