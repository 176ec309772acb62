import datetime
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loadglass import schema  # noqa: E402
from loadglass.operators.cleaning import clean_log  # noqa: E402
from loadglass.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    active = session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    active.sparkContext.setLogLevel("ERROR")
    yield active
    active.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture
def make_raw(spark):
    """A raw log from (timestamp, service, endpoint, ms, status, error) tuples."""

    def make(rows, first_id=0):
        rows = [
            (first_id + number, datetime.datetime.fromisoformat(row[0]), *row[1:])
            if row[0]
            else (first_id + number, None, *row[1:])
            for number, row in enumerate(rows)
        ]
        return spark.createDataFrame(rows, schema.with_event_id(schema.RAW_LOG))

    return make


@pytest.fixture
def make_clean(make_raw):
    return lambda rows: clean_log(make_raw(rows))
