from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from loglathe.operators.normalize import NormalizeOptions, to_raw_events  # noqa: E402
from loglathe.session import configure_session  # noqa: E402

CLOCK = "2026-02-01T00:00:00Z"
OPTIONS = NormalizeOptions(assumed_year=2026, normalized_at=CLOCK)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("loglathe-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    configure_session(session)
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A new folder per test; scratch folders are left to the system."""
    return tempfile.mkdtemp(prefix="loglathe-test-", dir="/tmp")


@pytest.fixture(scope="session")
def raw_of(spark):
    """Raw events from texts, in the given order."""
    def build(texts, source="test.log"):
        rows = [(source, i, i, text) for i, text in enumerate(texts, start=1)]
        lines = spark.createDataFrame(
            rows, "source_name string, line_no bigint, seq bigint, raw_text string")
        return to_raw_events(lines, CLOCK)

    return build
