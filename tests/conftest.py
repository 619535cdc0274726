import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallycast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, "tests", **{"spark.checkpoint.dir": folder})
    yield session
    session.stop()


@pytest.fixture
def make_events(spark):
    """Events from ``(key, time text)`` rows in arrival order."""

    def make(rows):
        data = [(i, key, ts) for i, (key, ts) in enumerate(rows)]
        df = spark.createDataFrame(data, "arrival bigint, key string, ts string")
        return df.withColumn("ts", df.ts.cast("timestamp_ntz"))

    return make
